"""Centroid clustering against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from occulink.llm import centroids
from occulink.llm.centroids import centroid_clusters, nearest

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int, row long, id string"


def brute_force(rows, k, rounds, dim, scale=256, seed=2):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    c = [z for _, z in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(z, m, strict=True)), j) for j, m in enumerate(c)) for _, z in kept]

    for _ in range(rounds):
        mine = assign()
        for j in range(len(c)):
            own = [z for (_, z), (_, a) in zip(kept, mine, strict=True) if a == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    mine = assign()
    own = Counter()
    for d, j in mine:
        own[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return Counter((i, j, d, own[j], sum(own.values()), sha[j]) for (i, _), (d, j) in zip(kept, mine, strict=True))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(6, 24)) * 3
    vectors = [[float(x) for x in middles[i % 6] + rng.normal(size=24) * rng.choice([0.1, 1, 3])] for i in range(500)]
    rows = [(i, v, "x", 1, i, "y") for i, v in enumerate(vectors)]
    rows += [(3, vectors[3], None, None, None, None)] * 30  # copies under one id
    rows += [(600 + i, vectors[9], None, None, None, None) for i in range(200)]  # ties
    rows += [(900, None, "", 0, 0, ""), (901, [], "", 0, 0, ""), (902, vectors[0][:-1], "", 0, 0, ""), (903, [math.nan] * 24, "", 0, 0, ""), (904, [math.inf] * 24, "", 0, 0, ""), (905, [None, *vectors[0][1:]], "", 0, 0, "")]
    return rows + [(None, vectors[i], "", 0, 0, "") for i in (5, 6)]


def as_counter(df):
    return Counter(tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


def test_clusters_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for k, rounds in ((12, 5), (40, 2), (1, 1)):
        got = centroid_clusters(df, k=k, rounds=rounds, dim=24)
        assert dict(got.dtypes)["cluster"] == "int" and as_counter(got) == brute_force(rows, k, rounds, 24)


def test_small_blocks_and_large_components(spark, rows, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 7)
    few = rows[:60] + [(1000 + i, [float(3e6 * (i % 3)), *([1e6 + i] * 23)], "", 0, 0, "") for i in range(9)]
    got = centroid_clusters(spark.createDataFrame(few, SCHEMA), k=5, rounds=3, dim=24)
    assert as_counter(got) == brute_force(few, 5, 3, 24)


def test_filter_leaves_few_pairs_and_no_error():
    rng = np.random.default_rng(1)
    z = (rng.normal(size=(3000, 64)) * np.linspace(900, 1, 64)).astype(np.int64)
    c = z[rng.permutation(3000)[:40]]
    c[7] = c[3]  # a tie goes to the smaller number
    axes = centroids.Axes(z.mean(axis=0), np.linalg.eigh(np.cov(z.T.astype(float)))[1][:, ::-1])
    seen = []
    exact = centroids.distances
    centroids.distances = lambda a, b: seen.append(len(a)) or exact(a, b)
    try:
        best, least = nearest(z, *axes.project(z), c, *axes.project(c))
    finally:
        centroids.distances = exact
    d = ((z[:, None] - c) ** 2).sum(axis=2)
    assert (best == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert sum(seen) < 0.2 * d.size


def test_few_and_no_vectors(spark, rows):
    three = rows[:3]
    assert as_counter(centroid_clusters(spark.createDataFrame(three, SCHEMA), dim=24)) == brute_force(three, 40, 5, 24)
    assert centroid_clusters(spark.createDataFrame([], SCHEMA), dim=24).count() == 0
    assert centroid_clusters(spark.createDataFrame([(1, None, "", 0, 0, "")], SCHEMA), dim=24).count() == 0
