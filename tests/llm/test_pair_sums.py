"""Scores of the factorisation machine against the explicit sum over all pairs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from occulink.llm import fm
from occulink.llm.words import split_words

TEXTS = ["good words here", "", None, " \n ", "Bad, bad words.\nnone here!", "good good GOOD (words) and more words", "unknown", "long text " * 4000 + "good"]


@pytest.mark.parametrize("with_statistics", [True, False])
def test_score_equals_double_sum(with_statistics):
    rng = np.random.default_rng(3)
    hashes = np.unique(fm.term_hashes(split_words(pa.array(["good bad words here text long absent"]), lower=False)))
    s = fm.Settings(statistics=with_statistics, bins=4, rank=3)
    stats = fm.statistics(pa.array([t or "" for t in TEXTS]), split_words(pa.array(TEXTS), lower=False))
    edges = np.quantile(stats, [0.25, 0.5, 0.75], axis=0).T if with_statistics else np.zeros((0, 0))
    slots = len(hashes) + s.bins * len(edges)
    m = fm.Model(s, hashes, rng.normal(size=len(hashes)), edges, 0.1, rng.normal(0, 0.3, slots), rng.normal(0, 0.3, (slots, s.rank)), 1)
    got = fm.score(m, pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        x = {}
        for word in (text or "").split():
            h = int(fm.term_hashes(split_words(pa.array([word]), lower=False))[0])
            if h in hashes:
                k = int(np.flatnonzero(hashes == h)[0])
                x[k] = m.scale[k]
        for k, e in enumerate(edges):
            x[len(hashes) + s.bins * k + int((e < stats[i, k]).sum())] = 1.0
        z = m.bias + sum(m.weights[a] * x[a] for a in x)
        z += sum(float(m.factors[a] @ m.factors[b]) * x[a] * x[b] for a in x for b in x if a < b)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
