"""The entry module works with and without the training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_operators(scratch):
    copy = os.path.join(scratch, "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache", ".hypothesis"))
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "assert set(q) == set(s) and len(q) == 41, len(q)")
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True,
                   env={**os.environ, "PYTHONPATH": copy})


def test_nothing_else_imports_the_training_data_operators():
    for folder in ("demandlens", "oracle", "tools"):
        for at, _, names in os.walk(os.path.join(ROOT, folder)):
            if "llm" in at.split(os.sep):
                continue
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(at, name), encoding="utf-8") as fh:
                        assert "demandlens.llm" not in fh.read(), name
