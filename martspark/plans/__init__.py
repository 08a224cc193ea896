"""Composed jobs: dimensions, facts, driver-table derivations, query catalog."""
