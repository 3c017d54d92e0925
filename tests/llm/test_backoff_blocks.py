"""The n-grams of a block, and scores over several blocks and ranges."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from occulink.llm import backoff


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_block_grams(order):
    rng = np.random.default_rng(order)
    texts = [list(rng.integers(1, 5, n)) for n in (7, 0, 1, 2, 0, 30, 3)]
    words = np.array([w for t in texts for w in t], np.uint64)
    g = backoff.block_grams(np.array([len(t) for t in texts]), words, order)
    assert (np.diff(g.keys.astype(object)) > 0).all()
    for k in range(1, order + 1):
        grams, contexts, ends = [], [], Counter()
        for t in texts:
            padded = [0] * k + t
            mine = [tuple(padded[i + 1 : i + 1 + k]) for i in range(len(t))]
            grams += mine
            contexts += [tuple(padded[i : i + k]) for i in range(len(t))]
            ends.update(mine[-1:])
        times, asked = Counter(grams), Counter(contexts)
        assert [g.times[c] for c in g.at[k]] == [times[x] for x in grams]
        if k < order:  # a context's count: its n-gram's less the texts that end with it
            assert [g.times[c] - g.ends[c] for c in g.before[k]] == [asked[x] for x in contexts]
            assert [g.ends[c] for c in g.at[k]] == [ends[x] for x in grams]


def test_packed_round_trip():
    for x in (np.zeros(0, np.uint64), np.array([0, 1, 255, 2**63, 2**64 - 1], np.uint64), np.arange(9)):
        assert (backoff._unpacked(backoff._packed(x)) == x.astype(np.uint64)).all()


def test_blocks_and_ranges_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, rng.integers(0, 60)) % 50)) for i in range(200)]
    rows += [(None, None), (7, ""), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    key = lambda r: str(tuple(r))
    whole = sorted((r for r in backoff.backoff_scores(docs).collect()), key=key)
    monkeypatch.setattr(backoff, "RANGE_WORDS", 400)
    # workers import the module afresh, so blocks are made small by small batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        parts = sorted((r for r in backoff.backoff_scores(docs).collect()), key=key)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(whole) == len(rows)
    for a, b in zip(whole, parts, strict=True):
        assert (a.doc_id, a.n_words) == (b.doc_id, b.n_words) and a.log_score == pytest.approx(b.log_score, abs=2e-6)
