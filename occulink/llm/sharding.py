"""Sharding by histogram sort (DataFrame functions only).

Rows are ordered by the key ``(xxhash64(text), xxhash64(doc_id))`` and cut into
contiguous key ranges of near equal bytes.  The cut points (splitters) are found
by counting: every round counts the exact bytes and rows between candidate key
boundaries (probes) across all partitions, and puts new probes only into the
intervals that still hold a splitter, until each splitter lies within the
tolerance of its target.  Rows are then exchanged once.

The first key half is a hash of the text, so equal texts are neighbours and
share a shard.  An interval that holds one single text is not cut while moving
the splitter to one of its ends meets the tolerance; only a group of copies too
large for that is cut, along the second key half, which spreads any group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occulink.llm.common import stage

#: Bits that one round adds to the probes of an interval: the first round puts
#: 2**FIRST_BITS equal intervals over all keys, later ones 2**NEXT_BITS into
#: each interval that holds a splitter.
FIRST_BITS, NEXT_BITS, KEY_BITS = 12, 8, 64
#: Rows that one numbering window holds on average, and the bits of the second
#: key half that split a window whose rows all share one text.
WINDOW_ROWS, COPY_BITS = 20_000, 6
SIGN = -(1 << 63)


@dataclass(frozen=True)
class Splitter:
    """Rows whose key is below ``(text_key, doc_key)`` lie left of it."""

    text_key: int
    doc_key: int = SIGN


def _bits(key: Column, used: int, more: int) -> Column:
    """The ``more`` bits of an order-preserving (sign flipped) key after its
    first ``used`` ones."""
    flipped = key.bitwiseXOR(F.lit(SIGN))
    return F.shiftrightunsigned(flipped, KEY_BITS - used - more).bitwiseAND(F.lit((1 << more) - 1))


def _low(prefix: int, bits: int) -> int:
    """The least signed key with this prefix of the flipped key."""
    return (prefix << (KEY_BITS - bits)) + SIGN


def _probe(rows: DataFrame, key: str, active: list[int], bits: int, more: int) -> dict[int, list[tuple]]:
    """Exact bytes and rows of each sub-interval of the active prefixes.  At
    most ``len(active) * 2**more`` counts reach the driver."""
    k = F.col(key)
    prefix = F.shiftrightunsigned(k.bitwiseXOR(F.lit(SIGN)), KEY_BITS - bits) if bits else F.lit(0).cast("long")
    if bits:
        rows = rows.where(prefix.isin(active))
    counts = (
        rows.groupBy(prefix.alias("p"), _bits(k, bits, more).alias("b"))
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        .collect()
    )
    out: dict[int, list[tuple]] = {}
    for r in sorted(counts, key=lambda r: (r.p, r.b)):
        out.setdefault(r.p, []).append((r.b, r.bytes, r.rows, r.lo, r.hi))
    return out


def _refine(rows: DataFrame, key: str, targets: list[tuple[int, int]], tolerance: int, whole: int) -> dict[int, tuple[int, int | None]]:
    """For each ``(splitter, target bytes)``: the least key right of it and the
    key of the single-key interval that has to be cut at ``target - bytes``
    (else ``None``), as ``{splitter: (key, excess or None)}``.

    ``tolerance``: distance in bytes at which a probe is good enough; ``whole``:
    the distance up to which an interval with one single key stays whole.
    """
    found: dict[int, tuple[int, int | None]] = {}
    open_: dict[int, list[tuple[int, int, int]]] = {0: [(i, t, 0) for i, t in targets]}  # prefix: (splitter, target, bytes below)
    bits = 0
    while open_:
        more = min(FIRST_BITS if not bits else NEXT_BITS, KEY_BITS - bits)
        counts = _probe(rows, key, sorted(open_), bits, more)
        below: dict[int, list[tuple[int, int, int]]] = {}
        for prefix, wanted in open_.items():
            for i, target, base in wanted:
                at = base
                for b, size, _, lo, hi in counts.get(prefix, []):
                    if at + size < target:
                        at += size
                        continue
                    left, right = target - at, at + size - target
                    sub = (prefix << more) | b
                    if left <= tolerance and left <= right:
                        found[i] = (lo, None)
                    elif right <= tolerance:
                        found[i] = (hi + 1 if hi < -SIGN - 1 else hi, None) if hi < -SIGN - 1 else (lo, None)
                    elif lo == hi:
                        near_left = left <= right or hi == -SIGN - 1
                        if min(left, right) <= whole:
                            found[i] = (lo, None) if near_left else (hi + 1, None)
                        else:
                            found[i] = (lo, left)
                    else:
                        below.setdefault(sub, []).append((i, target, at))
                    break
                else:
                    found[i] = (-SIGN - 1, None)  # target beyond the last row: an empty shard follows
        open_, bits = below, bits + more
        if bits >= KEY_BITS and open_:  # cannot happen: one key a prefix by then
            raise AssertionError("probes of all key bits left a splitter open")
    return found


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.002) -> list[Splitter]:
    """``shards - 1`` splitters of staged ``rows(text_key, doc_key, size)``."""
    total, largest = rows.agg(F.sum("size"), F.max("size")).first()
    if not total:
        return [Splitter(-SIGN - 1, -SIGN - 1)] * (shards - 1)
    share = total / shards
    near = int(share * tolerance)
    targets = [(i, math.ceil(total * i / shards)) for i in range(1, shards)]
    at = _refine(rows, "text_key", targets, near, max(near, int(share * 0.01), largest // 2))
    groups: dict[int, list[tuple[int, int]]] = {}
    for i, (key, excess) in at.items():
        if excess is not None:
            groups.setdefault(key, []).append((i, excess))
    cut: dict[int, int] = {}
    for key, wanted in groups.items():  # at most shards - 1 groups are that large
        copies = rows.where(F.col("text_key") == key)
        inner = _refine(copies, "doc_key", wanted, near, -SIGN - 1)
        cut |= {i: k for i, (k, _) in inner.items()}
    return sorted((Splitter(key, cut.get(i, SIGN)) for i, (key, _) in at.items()), key=lambda s: (s.text_key, s.doc_key))


def _shard_of(points: list[Splitter], first: int = 0) -> Column:
    """The number of splitters at or below a row's key, found by halving."""
    if not points:
        return F.lit(first)
    half = len(points) // 2
    s, t, d = points[half], F.col("text_key"), F.col("doc_key")
    above = (t > s.text_key) | ((t == s.text_key) & (d >= s.doc_key))
    return F.when(above, _shard_of(points[half + 1 :], first + half + 1)).otherwise(_shard_of(points[:half], first))


def histogram_sort_shards(docs: DataFrame, shards: int = 40, tolerance: float = 0.002) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for all rows.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16; the law is
    ``bytes``.  ``tolerance`` is the part of a shard's share by which a splitter
    may miss its target; an interval with one row or one group of copies is left
    whole within half the largest row (or a hundredth of a share).  ``slot``
    numbers a shard's rows gaplessly from 0 in key order.  Null texts count as
    empty ones (crc 0), equal rows get neighbouring slots, null ids one common
    key, an empty table gives no rows, and other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_key"),
            F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(1)).alias("doc_key"),
        ),
        "shard-keys",
    )
    points = splitters(rows, shards, tolerance)
    n = rows.count()
    bits = min(30, max(1, math.ceil(math.log2(max(2, n / WINDOW_ROWS * 4)))))
    keyed = rows.select(
        "*",
        _shard_of(points).alias("shard"),
        _bits(F.col("text_key"), 0, bits).alias("text_part"),
        _bits(F.col("doc_key"), 0, COPY_BITS).alias("doc_part"),
    )
    part = ["shard", "text_part", "doc_part"]
    counts = keyed.groupBy(*part).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("text_part", "doc_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*part).orderBy("text_key", "doc_key", "doc_id")
    return (
        keyed.withColumn("at", F.row_number().over(inside) - 1)
        .join(bases, part)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("base") + F.col("at")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
