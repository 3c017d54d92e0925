"""Top-k with components whose scaled products leave 64-bit sums of small ones."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from occulink.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def test_large_components_are_exact(spark):
    vectors = [[3e5, -2.5, 1.0], [4e5, 1.0, 2.0], [2.7e5, 1e3, 0.5], [-1e6, 7.0, 1.0], [1e6, -1e6, 1e6], [0.1, 0.2, 0.3], [2e6, 2e6, -2e6]]
    z = [[math.floor(1024 * x) for x in v] for v in vectors]
    got = topk.top_k(spark.createDataFrame(list(enumerate(vectors)), SCHEMA), F.lit(True), k=6).collect()
    want = []
    for q, a in enumerate(z):
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in enumerate(z) if i != q)
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("other", [1e17, 8e6])  # the component, then the score
def test_beyond_64_bits_is_an_error(spark, other):
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [8e6]), (1, [other])], SCHEMA), F.col("vec_id") == 0).collect()
