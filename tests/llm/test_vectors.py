"""Vector searches against brute force, with odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from occulink.llm import onebit, topk

SCHEMA = "vec_id long, embedding array<float>, row long, score double, dim int"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(np.float32(x)) for x in v] for v in rng.normal(size=(400, 24))]
    vectors[7] = vectors[100]  # ties
    vectors[8] = [0.0] * 24
    rows = [(i, v, None, 1.0, 2) for i, v in enumerate(vectors)]
    odd = [(500, None), (600, []), (700, [1.0, None] * 12), (800, [math.nan] * 24), (850, [math.inf] * 24), (None, vectors[3])]
    return [*rows, *((i, v, 1, None, None) for i, v in odd)], vectors


def test_top_k_is_exact(spark, table):
    rows, vectors = table
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()
    z = np.floor(1024 * np.array(vectors)).astype(np.int64)
    want = []
    for q in range(0, 400, 100):
        s = z @ z[q]
        order = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:10]
        want += [(q, k + 1, int(i), int(s[i])) for k, i in enumerate(order)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_neighbours_reach_the_recall(spark, table):
    rows, vectors = table
    got = onebit.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    x = np.array(vectors)
    length = np.linalg.norm(x, axis=1)
    length[8] = 1
    found = total = 0
    for q in range(0, 400, 50):
        s = (x @ x[q]) / (length * length[q])
        best = [int(i) for i in np.lexsort((np.arange(400), -s)) if i not in (q, 8)][:5]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5] and all(abs(r.score - s[r.vec_id]) < 1e-9 for r in mine)
        found += len(set(best) & {r.vec_id for r in mine})
        total += 5
    assert found >= 0.9 * total


def test_empty_tables_and_few_candidates(spark):
    for search in (topk.top_k, onebit.nearest):
        assert search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
        two = spark.createDataFrame([(0, [1.0, 2.0], 1, 1.0, 1), (1, [2.0, 1.0], 1, 1.0, 1)], SCHEMA)
        assert [(r.query_id, r.vec_id) for r in search(two, F.col("vec_id") == 0).collect()] == [(0, 1)]
