"""The entry registers the core queries whatever the training-data part lacks."""

import importlib.util
import subprocess
import sys

import pytest

HIDE = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name in HIDDEN:
            raise ModuleNotFoundError(f"No module named '{name}'", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
from courtline.registry import QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
print(sum(k not in QUERIES for k in entry.queries()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("hidden", [("courtline.llm", "corpus_pipeline"), ("xxhash",), ("public_tokenizers",)])
def test_core_queries_stand_alone(hidden):
    code = HIDE.replace("HIDDEN", repr(hidden))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == ["0", "False"]
    here = importlib.util.find_spec("courtline.llm") is not None  # the whole part may be absent, which is no fault
    assert ("not all registered" in run.stderr) == (here and hidden[0] != "courtline.llm")
