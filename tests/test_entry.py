"""The entry module without the training-data operators, and without a library that only they need."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from roster.plans.queries import QUERIES

TOP = os.path.dirname(os.path.abspath(entry.__file__))


@pytest.mark.parametrize("missing", ["roster.llm", "corpus_pipeline", "xxhash"])
def test_other_queries_stay(missing, tmp_path):
    code = f"""
import sys
sys.path.insert(0, {TOP!r})
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
print("QUERIES", sorted(entry.queries()) == {sorted(QUERIES)!r}, len(entry.oracle_sql()) == {len(QUERIES)})
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "QUERIES True True" in said.stdout, said.stderr[-2000:]
