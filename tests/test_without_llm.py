"""The library without its training-data subpackage: what is left imports and answers."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
CODE = """
import importlib.util
import __spark_entry__ as e
assert importlib.util.find_spec("logfreight.llm") is None
assert not [n for n in e.queries() if n.startswith("op") or n == "pipeline"]
assert set(e.oracle_sql()) <= set(e.queries())
from logfreight.session import local_session
spark = local_session(2, 2)
print("rows", e.queries()["log_size"](spark, {folder!r}).count())
"""


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_entry_without_subpackage(tmp_path, folder, also):
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *also)
    shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)
    out = subprocess.run(
        [sys.executable, "-c", CODE.format(folder=folder)], cwd=tmp_path / "repo", capture_output=True, text=True
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows" in out.stdout
