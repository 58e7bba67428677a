"""The registry works from a copy that lacks the training-data operators, with and without their pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import sys
sys.path.insert(0, {copy!r})
import __spark_entry__ as entry
names = set(entry.queries())
assert "q_top_activities" in names and set(entry.oracle_sql()) <= names
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
from check import compare, connect, session
print(compare(session("2"), connect({data!r}), {data!r}, "q_count_by_size_filter"))
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_core_queries_without_training_data_operators(tmp_path, pipeline):
    copy, data = str(tmp_path / "copy"), "/root/testdata/sf0.001"
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=left_out)
    done = subprocess.run(
        [sys.executable, "-c", RUN.format(copy=copy, data=data)],
        cwd=copy,
        env={**os.environ, "PYTHONPATH": copy},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.strip().endswith("ok 1 rows"), done.stdout
