"""The driver's contract, with the training-data subpackage and without it."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

LISTING = "import __spark_entry__ as e; import bench; q = e.queries(); print(len(q), 'region_tree' in q, any(n.startswith('op') or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))"


def test_queries_without_the_training_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for folder in ("fieldtally/llm", "tests/llm"):
        shutil.rmtree(copy / folder, ignore_errors=True)
    environment = {**os.environ, "PYTHONPATH": ""}
    shown = subprocess.run([sys.executable, "-c", LISTING], cwd=copy, env=environment, capture_output=True, text=True, check=True).stdout.split()
    assert int(shown[0]) >= 30 and shown[1:] == ["True", "False", "True"]
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert subprocess.run([sys.executable, "-c", LISTING], cwd=copy, env=environment, capture_output=True, text=True, check=True).stdout.split() == shown
