"""Blocked scans of vector codes against blocks of queries, and exact reranking.

A scan has three steps.  Vectors are grouped into blocks of a bounded number of
rows, and a coder turns each block into one row of codes and correction values.
Blocks of queries meet blocks of codes; a task walks through the code blocks of
one query block and keeps, for every query, the vectors whose upper score bound
reaches the k-th largest lower bound seen so far.  The survivors are then read
exactly in order of their upper bounds: first the k best, whose k-th score
closes all vectors with a smaller upper bound, then the rest that stays open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occulink.llm.common import ceil_div, stage

#: Vectors of a code block, queries of a query block, code blocks of a walk.
BLOCK, QUERIES, WALK = 4096, 512, 16

CANDIDATES = "q_row long, row long, lower double, upper double"


def usable(vec: Column) -> Column:
    """Vectors that are not null or empty and hold finite numbers only."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & good, F.lit(False))


def code_blocks(vectors: DataFrame, coder: Callable[[np.ndarray], dict[str, np.ndarray]], fields: list[str]) -> DataFrame:
    """One row for each block of staged ``vectors(row, dim, vec)``: row numbers
    and the coder's arrays as binary columns.  The coder gets a block as an
    ``n x dim`` array of doubles."""
    n = vectors.count()
    blocks = ceil_div(max(n, 1), BLOCK)

    def code(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack(pdf["vec"].to_numpy()).astype(np.float64)
        made = coder(x)
        return pd.DataFrame([{"block": pdf["block"].iloc[0], "dim": x.shape[1], "rows": pdf["row"].to_numpy(np.int64).tobytes()} | {k: np.ascontiguousarray(made[k]).tobytes() for k in fields}])

    schema = "block int, dim int, rows binary, " + ", ".join(f"{f} binary" for f in fields)
    return vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).groupBy("block", "dim").applyInPandas(code, schema)


def query_blocks(queries: DataFrame) -> DataFrame:
    """One row for each block of ``queries(row, dim, vec)``."""
    n = ceil_div(max(queries.count(), 1), QUERIES)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack(pdf["vec"].to_numpy()).astype(np.float64)
        return pd.DataFrame([{"q_block": pdf["q_block"].iloc[0], "q_dim": x.shape[1], "q_rows": pdf["row"].to_numpy(np.int64).tobytes(), "q": x.tobytes()}])

    return queries.withColumn("q_block", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")).groupBy("q_block", "dim").applyInPandas(pack, "q_block int, q_dim int, q_rows binary, q binary")


class _Kept:
    """Open candidates of one query block."""

    def __init__(self, q_rows: np.ndarray, k: int) -> None:
        self.q_rows, self.k = q_rows, k
        self.best = np.full((len(q_rows), k), -np.inf)  # the k largest lower bounds so far
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, rows: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
        own = self.q_rows[:, None] == rows[None, :]
        lower = np.where(own, -np.inf, lower)
        top = lower if lower.shape[1] <= self.k else -np.partition(-lower, self.k - 1, axis=1)[:, : self.k]
        self.best = -np.sort(-np.hstack([self.best, top]), axis=1)[:, : self.k]
        i, j = np.nonzero((upper >= self.best[:, -1:]) & ~own)
        self.parts.append((i, rows[j], lower[i, j], upper[i, j]))

    def frame(self) -> pa.RecordBatch:
        i, rows, lower, upper = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        open_ = upper >= self.best[i, -1]
        i = i[open_]
        return pa.RecordBatch.from_arrays([pa.array(self.q_rows[i]), pa.array(rows[open_]), pa.array(lower[open_]), pa.array(upper[open_])], names=["q_row", "row", "lower", "upper"])


def scan(codes: DataFrame, queries: DataFrame, bounds: Callable[[dict, np.ndarray], tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """Candidates ``(q_row, row, lower, upper)`` of staged code and query blocks.

    ``bounds`` gets a code block (a dict of its columns) and an ``m x dim``
    array of queries and gives the lower and upper score bounds, ``m x n``.
    """
    n_blocks, n_q = codes.count(), queries.agg(F.max("q_block")).first()[0]
    walks, n_q = ceil_div(max(n_blocks, 1), WALK), (n_q or 0) + 1
    parts = max(1, ceil_div(n_blocks * n_q, WALK))
    grid = ["walk", "q_block"]
    left = codes.withColumn("walk", F.pmod(F.xxhash64("block"), F.lit(walks)).cast("int")).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    right = queries.withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(walks - 1))))
    met = left.repartition(parts, *grid).join(right.repartition(parts, *grid), grid).where(F.col("dim") == F.col("q_dim")).sortWithinPartitions("q_block", "walk", "q_dim")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept, q = None, None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(c)[r].as_py() for c, name in enumerate(batch.schema.names)}
                if (key := (row["q_block"], row["walk"], row["q_dim"])) != at:
                    if kept is not None:
                        yield kept.frame()
                    at, q_rows = key, np.frombuffer(row["q_rows"], np.int64)
                    q = np.frombuffer(row["q"], np.float64).reshape(len(q_rows), -1)
                    kept = _Kept(q_rows, k)
                kept.add(np.frombuffer(row["rows"], np.int64), *bounds(row, q))
        if kept is not None:
            yield kept.frame()

    return met.mapInArrow(walk, CANDIDATES)


def rerank(candidates: DataFrame, vectors: DataFrame, queries: DataFrame, score: Callable[[Column, Column], Column], k: int, score_type: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of staged candidates.

    ``vectors`` and ``queries`` are staged ``(row, vec_id, exact)``.  Ties go to
    the smaller ``vec_id``, then to the earlier row.
    """
    every = Window.partitionBy("q_row")
    by_lower = every.orderBy(F.desc("lower"), "row")
    by_upper = every.orderBy(F.desc("upper"), "row")
    ranked = candidates.withColumn("lr", F.row_number().over(by_lower)).withColumn("least", F.max(F.when(F.col("lr") == k, F.col("lower"))).over(every))
    ranked = ranked.where(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).withColumn("ur", F.row_number().over(by_upper)).select("q_row", "row", "upper", "ur")
    ranked = stage(ranked, "candidates")
    q = queries.select(F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"), F.col("exact").alias("q_exact"))

    def read(some: DataFrame) -> DataFrame:
        return (
            some.join(vectors.select("row", "vec_id", "exact"), "row")
            .join(q, "q_row")
            .select("q_row", "query_id", "row", "vec_id", score(F.col("q_exact"), F.col("exact")).cast(score_type).alias("score"))
        )

    first = stage(read(ranked.where(F.col("ur") <= k)), "first-reads")
    closed = first.groupBy("q_row").agg(F.min("score").alias("reach"), F.count(F.lit(1)).alias("n"))
    rest = ranked.where(F.col("ur") > k).join(closed, "q_row").where(F.col("upper") >= F.col("reach")).select("q_row", "row", "upper", "ur")
    order = every.orderBy(F.desc("score"), "vec_id", "row")
    return first.unionByName(read(rest)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
