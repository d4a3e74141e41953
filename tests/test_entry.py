"""The driver contract on a copy of the repository without the optional training-data package."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from voltline.workloads import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(*sorted(q)); print(*sorted(o))"


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
@pytest.mark.parametrize("leftover", [False, True])
def test_entry_without_the_optional_package(tmp_path, gone, leftover):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", *gone))
    assert not (copy / "voltline/llm").exists() and not (copy / "tests/llm").exists()
    if leftover:  # a folder that holds no code
        (copy / "voltline/llm/__pycache__").mkdir(parents=True)
    env = os.environ | {"PYTHONPATH": str(copy)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=env, capture_output=True, text=True, check=True)
    queries, oracles = (line.split() for line in done.stdout.splitlines())
    assert queries == sorted(QUERIES) and oracles == sorted(ORACLES)
