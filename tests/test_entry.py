"""The entry file in a tree without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e, waymeter.registry as r; assert set(r.QUERIES) == set(e.queries()) == set(e.oracle_sql()); print('IMPORTED', len(e.queries()))"


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_entry_imports_without_the_llm_folders(tmp_path, pipeline_too):
    tree = tmp_path / "tree"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *(["corpus_pipeline.py"] if pipeline_too else []))
    shutil.copytree(ROOT, tree, ignore=left_out)
    assert (tree / "corpus_pipeline.py").exists() != pipeline_too
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tree, env=env, capture_output=True, text=True, timeout=120)
    assert "IMPORTED" in run.stdout, run.stderr[-2000:]
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=tree, env=env, capture_output=True, text=True, timeout=120)
    assert collected.returncode == 0, collected.stdout[-2000:]
