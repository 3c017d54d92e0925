"""Nearest neighbours by cosine over randomly rotated one-bit codes.

Unit vectors are centred on their block's mean, rotated by a fixed random
rotation (zeros pad them to the code length first) and reduced to signs.  With
``o`` the unit residual and ``s`` the unit sign vector, ``<s, Pq> / <s, Po>``
estimates ``<o, q>`` without bias, and its error stays below
``sqrt(1 / <s, Po>**2 - 1) * |q| * eps / sqrt(bits - 1)`` with a probability that
``eps`` sets.  Vectors whose upper bound reaches the k-th largest lower bound
are reranked by their exact cosine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occulink.llm.common import stage
from occulink.llm.vectors import code_blocks, query_blocks, rerank, scan, usable

#: Code bits per dimension, and the width of the error bound.
BITS_PER_DIM, EPS, SEED = 16, 3.0, 20240


def code_bits(dim: int) -> int:
    return max(128, -(-BITS_PER_DIM * dim // 64) * 64)


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """``dim`` orthonormal rows in the space of the code bits."""
    g = np.random.default_rng(SEED + dim).standard_normal((code_bits(dim), dim))
    q, r = np.linalg.qr(g)
    return (q * np.sign(np.diag(r))).T


def encode(x: np.ndarray) -> dict[str, np.ndarray]:
    """Packed signs and correction values of a block of unit vectors."""
    n, d = x.shape
    centre = x.mean(axis=0)
    res = x - centre
    radius = np.linalg.norm(res, axis=1)
    turned = (res / np.where(radius > 0, radius, 1)[:, None]) @ rotation(d)
    bits = turned > 0
    align = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])  # <s, Po>
    return {"bits": np.packbits(bits, axis=1), "radius": radius, "align": np.where(radius > 0, align, 1.0), "base": res @ centre, "centre": centre}


def code_bounds(block: dict, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = block["dim"]
    m = code_bits(d)
    read = lambda k: np.frombuffer(block[k], np.float64)
    radius, align, base, centre = (read(k) for k in ("radius", "align", "base", "centre"))
    bits = np.unpackbits(np.frombuffer(block["bits"], np.uint8).reshape(len(radius), -1), axis=1)[:, :m]
    signs = (bits.astype(np.float32) * 2 - 1) / np.float32(np.sqrt(m))
    rest = q - centre
    guess = ((rest @ rotation(d)).astype(np.float32) @ signs.T).astype(np.float64) / align
    width = np.linalg.norm(rest, axis=1)[:, None] * (np.sqrt(np.maximum(1 / align**2 - 1, 0)) * EPS / np.sqrt(m - 1))
    middle = (q @ centre)[:, None] + base + radius * guess  # <c, q> + <x - c, c> + <x - c, q - c>
    width = radius * width + 1e-5
    return middle - width, middle + width


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _cosine(a: Column, b: Column) -> Column:
    return _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the ``k`` nearest
    rows found, by cosine in double precision on the original vectors.

    Ties go to the smaller id.  Rows with a null id take no part, as queries or as
    candidates.  Vectors that are null, empty or zero or hold
    nulls or non-finite numbers take no part; a query meets vectors of its own
    dimension.  Rows repeated under one id are rows of their own.  Fewer than
    ``k`` candidates are all returned; an empty table gives no rows.
    """
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    some = F.exists(v, lambda x: x != 0)
    exact = embeddings.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).where(F.coalesce(some, F.lit(False)))
    vectors = stage(
        exact.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), F.size(v).alias("dim"), v.alias("exact"), F.coalesce(is_query, F.lit(False)).alias("is_query")),
        "vectors",
    )
    queries = vectors.where("is_query")
    length = F.sqrt(_dot(F.col("exact"), F.col("exact")))
    units = lambda df: df.withColumn("length", length).select("row", "dim", F.transform("exact", lambda x: x / F.col("length")).alias("vec"))
    codes = stage(code_blocks(units(vectors), encode, ["bits", "radius", "align", "base", "centre"]), "one-bit-codes")
    blocks = stage(query_blocks(units(queries)), "query-blocks")
    found = stage(scan(codes, blocks, code_bounds, k), "bounds")
    return rerank(found, vectors, queries, _cosine, k, "double")
