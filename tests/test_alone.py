"""The library without its optional subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
SCRIPT = """
import __spark_entry__ as entry
from recurra.plans.oracles import ORACLES
from recurra.plans.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
"""


@pytest.mark.parametrize("left", [["corpus_pipeline.py"], []])
def test_entry_point_in_a_copy_without_the_text_operators(tmp_path, left):
    shutil.copytree(REPO / "recurra", tmp_path / "recurra", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(REPO / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(name for name in left if (REPO / name).exists())]:
        shutil.copy(REPO / name, tmp_path / name)
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, check=True, timeout=120)
    listed = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120,
    )
    assert listed.returncode == 0, listed.stdout[-2000:]
