"""The entry works without the corpus operators, and without a library that only they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CORE = ("epochloom.llm", "corpus_pipeline")


def names(*blocked: str) -> set[str]:
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(*sorted(entry.queries()))
assert set(entry.oracle_sql()) <= set(entry.queries())
"""
    return set(subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True).stdout.split())


@pytest.mark.parametrize("blocked", [CORE, ("xxhash", "public_tokenizers"), ("regex", "duckdb", "public_tokenizers")])
def test_core_queries_stay(blocked):
    found = names(*blocked)
    assert {"band_power", "interval_label", "stream_window_epochs"} <= found and "pipeline" not in found
    assert not any(name.startswith("op") for name in found)
