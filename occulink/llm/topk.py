"""Exact top-k by inner product over a vector-approximation file."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occulink.llm.common import stage
from occulink.llm.vectors import code_blocks, query_blocks, rerank, scan, usable

#: With scaled components of +-LIMIT at most and below DIMENSIONS, 64-bit scores
#: cannot overflow; other products are added up as decimals.
SCALE, LIMIT, DIMENSIONS, CELLS = 1024, 1 << 24, 1 << 15, 64
#: 2**63 as a double: scaled components and scores are 64-bit numbers.
BEYOND = float(1 << 63)


def quantise(x: np.ndarray) -> dict[str, np.ndarray]:
    """Cell numbers and, for each dimension, the least and largest value of each
    cell (cells hold equal numbers of rows; unused ones repeat the last)."""
    n, d = x.shape
    cuts = np.sort(x, axis=0)[(np.arange(1, CELLS) * n) // CELLS]  # CELLS-1 x d
    cells = np.empty((n, d), np.uint8)
    low, high = np.zeros((d, CELLS)), np.zeros((d, CELLS))
    for j in range(d):
        c = np.searchsorted(cuts[:, j], x[:, j], side="right")
        cells[:, j] = c
        low[j], high[j] = np.inf, -np.inf
        np.minimum.at(low[j], c, x[:, j])
        np.maximum.at(high[j], c, x[:, j])
    empty = low > high
    low[empty] = high[empty] = 0
    return {"cells": cells, "low": low, "high": high}


def cell_bounds(block: dict, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query with anything in the cells
    of each vector.  Values are integers, so doubles err by rounding only; the
    bounds are widened by far more than that."""
    d = block["dim"]
    cells = np.frombuffer(block["cells"], np.uint8).reshape(-1, d)
    low = np.frombuffer(block["low"], np.float64).reshape(d, CELLS)
    high = np.frombuffer(block["high"], np.float64).reshape(d, CELLS)
    at = np.arange(d)
    lo, hi = low[at, cells], high[at, cells]
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    lower, upper = plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T
    slack = np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T * 1e-12
    return lower - slack, upper + slack


def _product(a: Column, b: Column) -> Column:
    large = lambda x: (x > LIMIT) | (x < -LIMIT)
    plain = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    wide = F.zip_with(a, b, lambda x, y: (x.cast("decimal(20,0)") * y.cast("decimal(20,0)")).cast("decimal(38,0)"))
    exact = F.aggregate(wide, F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    fits = exact.between(F.lit(-(1 << 63)).cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    checked = F.when(fits, exact.cast("long")).otherwise(F.raise_error(F.lit("a score does not fit into 64 bits")).cast("long"))
    return F.when((F.size(a) >= DIMENSIONS) | F.exists(a, large) | F.exists(b, large), checked).otherwise(plain)


def _scaled(v: Column) -> Column:
    def one(x: Column) -> Column:
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < BEYOND, F.floor(y).cast("long")).otherwise(F.raise_error(F.lit("a component times 1024 does not fit into 64 bits")).cast("long"))

    return F.transform(v, one)


def top_k(embeddings: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the ``k`` largest
    integer inner products of ``floor(1024 * x)`` vectors, among all other rows.

    Ties go to the smaller id.  Rows with a null id take no part, as queries or as
    candidates.  Null vectors, empty ones and those that hold
    nulls or non-finite numbers take no part; a query meets vectors of its own
    dimension.  Scores are exact as long as they and ``floor(1024 * x)`` fit into
    64 bits; a component, or a score that has to be read, outside of that raises
    an error.  Rows repeated under one id are rows of their own.  Fewer than
    ``k`` candidates are all returned; an empty table gives no rows.
    """
    v = F.col(vec_col)
    vectors = stage(
        embeddings.where(usable(v) & F.col(id_col).isNotNull()).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), F.size(v).alias("dim"), _scaled(v).alias("exact"), F.coalesce(is_query, F.lit(False)).alias("is_query")
        ),
        "vectors",
    )
    queries = vectors.where("is_query")
    as_rows = lambda df: df.select("row", "dim", F.col("exact").alias("vec"))
    codes = stage(code_blocks(as_rows(vectors), quantise, ["cells", "low", "high"]), "va-file")
    blocks = stage(query_blocks(as_rows(queries)), "query-blocks")
    found = stage(scan(codes, blocks, cell_bounds, k), "bounds")
    return rerank(found, vectors, queries, _product, k, "long")
