"""The corpus pipeline: every stage on its own input against a brute-force version."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from demandlens.llm import bpe
from demandlens.llm._common import written

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage, and the last one's result."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in cp.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), "stage"))
    return [d.collect() for d in docs], docs


def test_stage_columns(stages):
    _, frames = stages
    for f in frames[:-1]:
        assert f.columns == COLUMNS


def test_quality_stage(stages):
    rows, _ = stages
    kept = {r.doc_id for r in rows[1]}
    for r in rows[0]:
        if brute.quality(r.text)[-1]:
            assert r.doc_id not in kept
    assert len(kept) > 0.8 * len(rows[0])


def test_near_dedup_stage(stages):
    rows, _ = stages
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in rows[1]]
    assert sorted(r.doc_id for r in rows[2]) == sorted(set(brute.components(fps)))


def test_pii_stage(stages):
    rows, _ = stages
    before = {r.doc_id: r for r in rows[2]}
    assert len(rows[3]) == len(rows[2])
    for r in rows[3]:
        old = before[r.doc_id].text
        spans = brute.base_spans(old)
        if not spans:
            assert r.text == old
        for _, s, e in spans:
            assert old[s:e] not in r.text
        assert r.n_chars == len(r.text)


def test_mixing_stage(stages):
    rows, _ = stages
    want = brute.targets([(r.doc_id, r.source, r.text) for r in rows[3]])
    size = {r.doc_id: len(brute.words(r.text)) for r in rows[3]}
    taken = Counter()
    for r in rows[4]:
        taken[r.source] += size[r.doc_id]
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= 0.02 * target + 60
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 2


def test_bpe_stage(stages):
    import tiktoken
    path, pattern = bpe.default_vocabulary()
    encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path),
                                special_tokens={})
    rows, _ = stages
    text = {r.doc_id: r.text for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    for r in rows[5]:
        assert list(r.ids) == encoder.encode_ordinary(text[r.doc_id])
        assert r.decoded_sha256 == brute.sha(text[r.doc_id])


def test_run_is_the_stages_in_order(spark, stages):
    rows, _ = stages
    got = cp.run(spark, SF)
    assert Counter((r.doc_id, r.n_tokens) for r in got.select("doc_id", "n_tokens").collect()) == Counter(
        (r.doc_id, r.n_tokens) for r in rows[5])


def test_stages_take_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "word " * 30, "en", None, 1),
            (3, "one two three four five six seven eight nine ten eleven", None, "a", 5),
            (3, "one two three four five six seven eight nine ten eleven", None, "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for data in (docs, docs.limit(0)):
        d = data.withColumn("copies", F.lit(7)).withColumn("fp", F.lit("x"))
        for k, (_, stage) in enumerate(cp.STAGES):
            d = stage(spark, d, SF)
            if k < 4:
                assert d.columns == [*COLUMNS, "copies", "fp"]
        d.collect()
