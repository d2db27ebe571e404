"""The entry point with and without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))"


@pytest.mark.parametrize("leftovers", [False, True])
@pytest.mark.parametrize("pipeline", [False, True])
def test_the_rest_imports_without_the_folder(tmp_path, pipeline, leftovers):
    copy = tmp_path / "copy"
    left_out = [".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])]
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(*left_out))
    if leftovers:
        (copy / "tidewater/llm/__pycache__").mkdir(parents=True)
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, check=True, timeout=120)
    total, own, known = done.stdout.split()
    assert int(total) > 100 and own == "0" and known == "True"
    if pipeline and leftovers:
        found = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=copy, capture_output=True, text=True, timeout=300)
        assert found.returncode == 0, found.stdout[-2000:]
