"""Exact centroid clustering of integer vectors with PCA-rotated filtering.

The vectors' principal axes are found once.  Every vector is stored with its
leading rotated coordinates and the norm of the rest.  For a centroid ``c``
rotated alike, the squared distance of the leading coordinates plus the squared
difference of the two rest norms is at most ``|x - c|**2``.  A round computes
these bounds in floating point, takes the exact distance to the centroid with
the least bound, and compares in integers all centroids whose bound, less the
rounding slack, does not exceed it.  So assignments, and with them the centroids
and distances, are exact whatever the axes are.

Vectors live in staged blocks.  A round is one scan of the blocks; a task adds
up its vectors by centroid, and the driver gets ``k`` rows of sums.
"""

from __future__ import annotations

import ast
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occulink.llm.common import stage
from occulink.llm.vectors import usable

#: Leading coordinates, and vectors that are handled at once.
LEADING, BLOCK = 48, 2048
#: With components of at most LIMIT, squared distances of 64 dimensions stay
#: below 2**62; larger ones are handled as Python integers.
LIMIT = 1 << 27
BLOCKS = "z binary, lead binary, rest binary, wide boolean, ids array<{}>"


def to_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``; as Python integers if one exceeds ``LIMIT``."""
    y = np.floor(x * scale)
    if not len(y) or np.abs(y).max() <= LIMIT:
        return y.astype(np.int64)
    return np.array([[int(v) for v in row] for row in y.tolist()], dtype=object)


def distances(z: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    d = z - c
    return (d * d).sum(axis=1)


def nearest(z: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number) and its
    squared distance."""
    norm = (lead**2).sum(axis=1) + rest**2
    c_norm = (c_lead**2).sum(axis=1) + c_rest**2
    bound = norm[:, None] + c_norm - 2 * (lead @ c_lead.T) - 2 * np.outer(rest, c_rest)
    bound -= (norm[:, None] + c_norm) * 1e-9 + 1e-3  # far above the rounding errors
    rows = np.arange(len(z))
    best = bound.argmin(axis=1)
    least = distances(z, centroids[best])
    if z.dtype == object or centroids.dtype == object:
        open_ = np.ones(bound.shape, bool)  # beyond what the slack covers
    else:
        open_ = bound <= least[:, None] * (1 + 1e-9)
    open_[rows, best] = False
    for j in range(len(centroids)):  # in ascending order of the centroids
        at = np.flatnonzero(open_[:, j])
        if not len(at):
            continue
        d = distances(z[at], centroids[j])
        better = (d < least[at]) | ((d == least[at]) & (j < best[at]))
        best[at[better]], least[at[better]] = j, d[better]
    return best, least


def _matrix(vec: pa.Array, dim: int) -> np.ndarray:
    return vec.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _moments(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Number, sums and products of a task's vectors."""
    n, total, square = 0, np.zeros(dim), np.zeros((dim, dim))
    for batch in batches:
        x = _matrix(batch.column(0), dim)
        n, total, square = n + len(x), total + x.sum(axis=0), square + x.T @ x
    if n:
        flat = np.concatenate([[n], total, square.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["i", "value"])


def principal_axes(vectors: DataFrame, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation (columns by descending variance) of all scaled vectors."""
    rows = vectors.mapInArrow(lambda b: _moments(b, dim), "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()  # dim**2 + dim + 1 rows
    flat = np.zeros(1 + dim + dim * dim)
    for r in rows:
        flat[r.i] = r.value
    n = max(flat[0], 1)
    mean = flat[1 : dim + 1] / n
    cov = flat[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean)
    if not np.isfinite(cov).all():  # huge components: any rotation gives right bounds
        return np.zeros(dim), np.eye(dim)
    return mean * scale, np.linalg.eigh(cov)[1][:, ::-1]


class Axes:
    """Leading rotated coordinates and rest norms."""

    def __init__(self, mean: np.ndarray, rotation: np.ndarray) -> None:
        self.mean, self.rotation = mean, rotation

    def project(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = (z.astype(np.float64) - self.mean) @ self.rotation
        return y[:, :LEADING], np.sqrt((y[:, LEADING:] ** 2).sum(axis=1))


def _encode(batches: Iterator[pa.RecordBatch], axes: Axes, dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Blocks of ``(vec, id)`` rows; integers as 32-bit ones, or as text if one
    exceeds ``LIMIT``."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            z = to_integers(_matrix(part.column(0), dim), scale)
            lead, rest = axes.project(z)
            wide = z.dtype == object
            ids = part.column(1)
            one = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids]))
            binary = [repr(z.tolist()).encode() if wide else z.astype(np.int32).tobytes(), lead.tobytes(), rest.tobytes()]
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in binary), pa.array([wide]), one], names=["z", "lead", "rest", "wide", "ids"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """Integers, leading coordinates, rest norms and ids of each block."""
    for batch in batches:
        for r in range(batch.num_rows):
            z, lead, rest, wide, ids = (batch.column(i)[r] for i in range(5))
            z = np.array(ast.literal_eval(z.as_py().decode()), dtype=object) if wide.as_py() else np.frombuffer(z.as_py(), np.int32).reshape(-1, dim).astype(np.int64)
            yield z, np.frombuffer(lead.as_py()).reshape(len(z), -1), np.frombuffer(rest.as_py()), ids.values


def _sums(blocks: DataFrame, axes: Axes, centroids: np.ndarray) -> list:
    """Exact component sums and counts by centroid, as decimal strings."""
    dim = centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projected = axes.project(centroids)
        total, count = [[0] * dim for _ in centroids], [0] * len(centroids)
        for z, lead, rest, _ in _blocks(batches, dim):
            best, _ = nearest(z, lead, rest, centroids, *projected)
            for j in np.unique(best):
                mine = z[best == j]
                total[j] = [a + int(b) for a, b in zip(total[j], mine.sum(axis=0), strict=True)]
                count[j] += len(mine)
        some = [j for j, n in enumerate(count) if n]
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(some, pa.int32()), "n": pa.array([count[j] for j in some], pa.int64()), "total": pa.array([[str(v) for v in total[j]] for j in some], pa.list_(pa.string()))})

    parts = blocks.mapInArrow(add, "cluster int, n long, total array<string>").select("cluster", "n", F.transform("total", lambda v: v.cast("decimal(38,0)")).alias("total"))
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dim)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect()  # at most k rows


def first_centroids(vectors: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The ``k`` vectors whose ``seed:id`` has the smallest sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select("vec", digest.alias("digest")).orderBy(F.asc_nulls_last("digest"), "vec").limit(k).collect()
    return to_integers(np.array([r.vec for r in rows]), scale)


def centroid_clusters(embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for
    each vector with ``dim`` finite components, as integers ``floor(scale * x)``.

    The centroids start as the ``k`` vectors (all, if fewer) of smallest sha256 of
    ``seed:id``; each of ``rounds`` rounds assigns every vector to the nearest one
    (ties: the smaller number) and moves every centroid that has vectors to the
    floor of their mean.  The vectors are then assigned once more.

    Vectors that are null, of another length, or hold nulls or non-finite numbers
    take no part.  Rows repeated under one id are rows of their own; equal ids and
    null ids (which come last) start in the order of their vectors.  Integers of
    any size are handled; a distance or a sum of distances beyond 64 bits raises
    an error, as do component sums beyond 38 digits.  An empty table gives no
    rows, and other columns are ignored.
    """
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec")
    kept = embeddings.where(usable(F.col(vec_col)) & (F.size(vec_col) == dim))
    vectors = kept.select(vec, F.col(id_col).alias("id"))
    id_type = vectors.schema["id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, seed, scale).reshape(-1, dim)
    axes = Axes(*principal_axes(vectors.select("vec"), dim, scale))
    blocks = stage(vectors.mapInArrow(lambda b: _encode(b, axes, dim, scale), BLOCKS.format(id_type)), "cluster-blocks")
    for _ in range(rounds):
        moved = [list(map(int, c)) for c in centroids]
        for r in _sums(blocks, axes, centroids):
            moved[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(dim)]
        largest = max((abs(v) for c in moved for v in c), default=0)
        centroids = np.array(moved, dtype=np.int64 if largest <= LIMIT else object).reshape(-1, dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projected = axes.project(centroids)
        for z, lead, rest, ids in _blocks(batches, dim):
            best, least = nearest(z, lead, rest, centroids, *projected)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best.astype(np.int32)), pa.array([int(d) for d in least], pa.int64())], names=["vec_id", "cluster", "distance"])

    assigned = stage(blocks.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long"), "cluster-assigned")
    digests = [(j, hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()) for j, c in enumerate(centroids)]
    names = embeddings.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))  # at most k rows
    whole = per.agg(F.sum("own").cast("long").alias("inertia"))
    per = per.join(F.broadcast(names), "cluster").crossJoin(F.broadcast(whole)).select("cluster", F.col("own").cast("long").alias("cluster_inertia"), "inertia", "centroid_sha256")
    return assigned.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
