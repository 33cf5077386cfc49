import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_every_oracle_has_a_query_and_the_flagship_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_works_on_a_copy_without_the_optional_parts(tmp_path, also):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *also))
    assert not (copy / "sparktree/llm").exists() and not (copy / "tests/llm").exists() and (copy / "corpus_pipeline.py").exists() == (not also)
    code = "import __spark_entry__ as e\nq = e.queries()\nassert q and set(e.oracle_sql()) <= set(q) and not [k for k in q if k.startswith('op') or k == 'pipeline']"
    env = {**os.environ, "PYTHONPATH": str(copy)}
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
    subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, check=True, env=env, capture_output=True)


def test_nothing_else_imports_the_optional_parts():
    for p in (ROOT / "sparktree").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p
