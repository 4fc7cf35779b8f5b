"""The entry file works with and without the training-data subpackage and its pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), *[n for n in q if n[:2] == 'op' or n == 'pipeline'])"


@pytest.mark.parametrize("without", [("millrace/llm", "tests/llm"), ("millrace/llm", "tests/llm", "corpus_pipeline.py")])
def test_queries_without_the_subpackage(tmp_path, without):
    copy = tmp_path / "copy"
    left_out = {REPO / p for p in without}
    shutil.copytree(REPO, copy, ignore=lambda at, names: [n for n in names if Path(at, n) in left_out or n in (".git", "__pycache__")])
    done = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, check=True)
    n, with_sql, *named = done.stdout.split()
    assert int(n) > 300 and int(with_sql) > 250 and named == []
