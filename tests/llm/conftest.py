from __future__ import annotations

import os
import sys

import pyarrow.parquet as pq
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def pages():
    return pq.read_table(f"{SF}/pages.parquet").to_pylist()


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def frame(spark):
    """Documents from ``(doc_id, text, lang, source)`` rows, some of them left out."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if len(r) > 1 and r[1] else 0) for r in rows]
        return spark.createDataFrame(full, DOC)
    return make
