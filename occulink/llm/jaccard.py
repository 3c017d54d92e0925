"""Similarity join of texts by word n-grams with Bayesian candidate pruning.

Equal texts form a class with one representative.  MinHash bands put the
representatives into buckets; every pair that shares a bucket is a candidate.
Its MinHash values are compared a few at a time, and it is dropped as soon as
the posterior probability (uniform prior) that its similarity reaches the
threshold falls below the tolerance.  What stays is verified exactly on the
whole sets of n-grams.

A bucket of any size is split into blocks, and every two of its blocks meet in a
task of their own, which gives one row for each text and not one for each pair:
how many documents it is linked with and the least row of its local group.  A
pair belongs to the first band on which it agrees, so it counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occulink.llm.common import stage
from occulink.llm.groups import roots
from occulink.llm.words import split_words, text_column, word_hashes


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    bands: int = 24
    band_rows: int = 5
    step: int = 20  # MinHash values compared at a time
    tolerance: float = 1e-6
    block: int = 256

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows


SEED = 1813
MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The set of word n-grams of each text as ascending 64-bit hashes.  A text
    of fewer words has one, all of its words; one without words has none."""
    w = split_words(texts)
    h = word_hashes(w.distinct)[w.codes]
    out = []
    for a, z in zip(w.starts, w.starts[1:], strict=False):
        words, size = h[a:z], min(n, int(z - a))
        if not size:
            out.append(np.zeros(0, np.uint64))
            continue
        grams = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            grams = _scramble(grams * MIX + words[k : k + len(grams)])
        out.append(np.unique(grams))
    return out


@lru_cache(maxsize=4)
def _families(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    return r.integers(1, 1 << 63, n, np.uint64) | np.uint64(1), r.integers(0, 1 << 63, n, np.uint64)


def min_hashes(grams: np.ndarray, n: int) -> np.ndarray:
    a, b = _families(n)
    least = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(grams), 4096):
        part = ((grams[at : at + 4096, None] * a + b) >> np.uint64(32)).astype(np.uint32)
        least = np.minimum(least, part.min(axis=0))
    return least


@lru_cache(maxsize=8)
def least_matches(s: Settings) -> np.ndarray:
    """For each number of compared values the fewest agreements at which the
    posterior of a similarity of at least the threshold is within tolerance."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    log_p, log_q, high = np.log(grid), np.log1p(-grid), grid >= s.threshold
    out = np.zeros(s.hashes + 1, int)
    for n in range(s.step, s.hashes + 1, s.step):
        m = 0
        while m < n:
            log_density = m * log_p + (n - m) * log_q
            density = np.exp(log_density - log_density.max())
            if density[high].sum() >= s.tolerance * density.sum():
                break
            m += 1
        out[n] = m
    return out


def candidates(sig: np.ndarray, left: np.ndarray, right: np.ndarray, band: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(i in left, j in right)`` that first agree on ``band`` and outlast
    the incremental comparison."""
    shape = (len(left), len(right))
    bands = sig.reshape(len(sig), s.bands, s.band_rows)
    own = np.ones(shape, bool)
    for b in range(band + 1):
        same = np.ones(shape, bool)
        for k in range(s.band_rows):
            same &= bands[left, b, k][:, None] == bands[right, b, k][None, :]
        own &= same if b == band else ~same
    i, j = np.nonzero(own)
    i, j = left[i], right[j]
    some = i != j
    i, j = i[some], j[some]
    agree, need = np.zeros(len(i), int), least_matches(s)
    for n in range(s.step, s.hashes + 1, s.step):
        for at in range(0, len(i), 65_536):
            part = slice(at, at + 65_536)
            agree[part] += (sig[i[part], n - s.step : n] == sig[j[part], n - s.step : n]).sum(axis=1)
        live = agree >= need[n]
        i, j, agree = i[live], j[live], agree[live]
    return i, j


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least the threshold:
    shared n-grams are counted exactly as products of 0/1 matrices."""
    size = np.array([len(x) for x in sets])
    of = np.repeat(np.arange(len(sets)), size)
    grams, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    held = shared[code]
    of, at = of[held], column[code[held]]
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for c in range(0, int(shared.sum()), width):
        a, z = np.searchsorted(at, [c, c + width])
        m = np.zeros((len(sets), width), np.float32)
        m[of[a:z], at[a:z] - c] = 1
        used = np.unique(of[a:z])
        m = m[used]
        common[np.ix_(used, used)] += m @ m.T  # whole numbers below 2**24
    both = common[i, j]
    return both >= threshold * (size[i] + size[j] - both) - 1e-9


def _sides(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    one, two = int(pdf["one"].iloc[0]), int(pdf["two"].iloc[0])
    blk = pdf["blk"].to_numpy()
    return np.nonzero(blk == one)[0], np.nonzero(blk == two)[0], one == two


def _pairs(pdf: pd.DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), s.hashes)
    left, right, same = _sides(pdf)
    i, j = candidates(sig, left, right, int(pdf["band"].iloc[0]), s)
    return (i[i < j], j[i < j]) if same else (i, j)


def similarity(numbered: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``row, doc_id, class_id, class_rows, links, group_id, kept`` for staged
    ``numbered(__row, doc_id, text)``; see :func:`jaccard_join`."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_column(b)
            keys = [xxhash.xxh3_128_digest((t.as_py() or "").encode()) for t in texts]
            sig = [min_hashes(g, s.hashes).tobytes() if len(g) else None for g in shingles(texts, s.words)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(sig, pa.binary())], names=["row", "key", "sig"])

    signed = numbered.select(F.col("__row").alias("row"), "text").mapInArrow(sign, "row long, key binary, sig binary")
    signed = stage(signed, "signatures")
    ids = numbered.select(F.col("__row").alias("row"), "doc_id")
    keys = stage(signed.select("row", "key").join(ids, "row"), "text-keys")
    classes = stage(
        keys.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("one"), F.count(F.lit(1)).alias("class_rows")).select("key", F.col("one.row").alias("row"), F.col("one.doc_id").alias("class_id"), "class_rows"), "classes"
    )
    reps = stage(signed.where("sig IS NOT NULL").select("row", "sig").join(classes.select("row", "class_rows"), "row"), "representatives")

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0).to_numpy()
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(len(rows), s.bands, s.band_rows).astype(np.uint64)
            h = np.broadcast_to(np.arange(s.bands, dtype=np.uint64), sig.shape[:2])
            for k in range(s.band_rows):
                h = _scramble(h * MIX + sig[:, :, k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(rows, s.bands)), pa.array(np.tile(np.arange(s.bands, dtype=np.int32), len(rows))), pa.array(h.ravel().view(np.int64))], names=["row", "band", "bucket"]
            )

    banded = stage(reps.select("row", "sig").mapInArrow(band, "row long, band int, bucket long"), "bands")
    who = F.xxhash64("row").cast("decimal(38,0)")
    buckets = banded.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("n"), F.sum(who).alias("who")).where("n > 1")
    # buckets of the same members hold the same pairs: the first band's one is enough
    buckets = buckets.groupBy("n", "who").agg(F.min(F.struct("band", "bucket")).alias("b")).select("b.band", "b.bucket", F.ceil(F.col("n") / s.block).cast("int").alias("blocks"))
    task = ["bucket", "band", "one", "two"]
    blk = F.pmod(F.xxhash64("row", "bucket"), F.col("blocks")).cast("int")
    members = (
        banded.join(buckets, ["bucket", "band"])
        .withColumn("blk", blk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("row", "bucket", "band", "blk", F.least("blk", "other").alias("one"), F.greatest("blk", "other").alias("two"))
    )

    def active(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = _pairs(pdf, s)
        return pdf.iloc[np.union1d(i, j)][["row", "blk", *task]]

    alive = stage(members.join(reps.select("row", "sig"), "row").groupBy(*task).applyInPandas(active, "row long, blk int, bucket long, band int, one int, two int"), "candidates")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = _pairs(pdf, s)
        good = verified(shingles(pa.array(pdf["text"], pa.string()), s.words), i, j, s.threshold)
        i, j = i[good], j[good]
        rows, weight = pdf["row"].to_numpy(np.int64), pdf["class_rows"].to_numpy(np.int64)
        links = np.zeros(len(pdf), np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        root, before = rows.copy(), None
        while before is None or (root != before).any():
            before = root.copy()
            np.minimum.at(root, i, before[j])
            np.minimum.at(root, j, before[i])
        some = links > 0
        return pd.DataFrame({"row": rows[some], "links": links[some], "root": root[some]})

    whole = alive.join(reps, "row").join(numbered.select(F.col("__row").alias("row"), "text"), "row")
    found = stage(whole.groupBy(*task).applyInPandas(verify, "row long, links long, root long"), "links")
    linked = found.groupBy("row").agg(F.sum("links").alias("links"))
    root = roots(found.select(F.col("row").alias("u"), F.col("root").alias("v")))
    grouped = classes.join(linked, "row", "left").join(root, "row", "left").withColumn("root", F.coalesce("root", "row"))
    grouped = stage(grouped, "grouped")
    heads = grouped.groupBy("root").agg(F.min(F.struct("class_id", "row")).alias("head")).select("root", F.col("head.class_id").alias("group_id"), F.col("head.row").alias("head"))
    of_class = grouped.join(heads, "root").select("key", "class_id", "class_rows", (F.coalesce("links", F.lit(0)) + F.col("class_rows") - 1).alias("links"), "group_id", "head")
    return keys.join(of_class, "key").select("row", "doc_id", "class_id", "class_rows", "links", "group_id", (F.col("row") == F.col("head")).alias("kept"))


def _numbered(docs: DataFrame) -> DataFrame:
    return stage(docs.drop("__row").withColumn("__row", F.monotonically_increasing_id()), "join-docs")


def jaccard_join(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For every document ``doc_id, class_id, class_rows, links, group_id,
    kept``: the least id of the documents of equal text, their number, how many
    other documents reach the similarity threshold with it (equal ones
    included), the least id of its connected group, and whether it is the row
    that stays of that group (least id, then earlier row).

    Null texts count as empty.  Texts without words are linked with equal texts
    only; texts shorter than an n-gram are one n-gram.  Repeated rows are
    documents of their own, a null id comes first, an empty table gives no rows
    and further columns are not read.
    """
    return similarity(_numbered(docs.select("doc_id", "text")), settings).drop("row")


def one_of_each_group(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay when one of each connected group does."""
    numbered = _numbered(docs)
    kept = similarity(numbered.select("__row", "doc_id", "text"), settings).where("kept").select(F.col("row").alias("__row"))
    return numbered.join(kept, "__row", "left_semi").drop("__row")
