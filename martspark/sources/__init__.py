"""Sources and sinks: feed readers, seeds, rate payloads, versioned store."""
