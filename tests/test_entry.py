"""The entry file stands without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

from workload.queries import QUERIES

PARTS = ("stoplens/llm", "tests/llm")


@pytest.mark.parametrize("with_pipeline_file", [True, False])
def test_entry_without_optional_parts(tmp_path, with_pipeline_file):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json"))
    for part in PARTS:
        if (copy / part).exists():
            shutil.rmtree(copy / part)
    if not with_pipeline_file and (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    names, with_sql = (line.split() for line in run.stdout.splitlines())
    assert names == with_sql == sorted(QUERIES)
