"""The entry registers the warehouse queries whatever state the training-data package is in."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r} or name.split('.')[0] in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
print(len([q for q in e.queries() if not q.startswith('op') and q != 'pipeline']),
      len([q for q in e.queries() if q.startswith('op')]))
"""


@pytest.mark.parametrize("names", [["martspark.llm"], ["corpus_pipeline"], ["ahocorasick"], ["xxhash"]])
def test_entry_without_a_module(names):
    from martspark.plans.registry import QUERIES
    out = subprocess.run([sys.executable, "-B", "-c", BLOCK.format(names=names)], cwd=ROOT, capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == [str(len(QUERIES)), "0"]
    assert "not registered" in out.stderr
