"""Blocking keys (H1-H7), key filter (W1 + PF8) and candidate pairs (J1 + A1).

Every record emits a small set of blocking keys ("hashes").  Keys held by a
single record, or by more than ``max_group_size`` records, are dropped; every
two records from different datasets that still share a key become a
candidate pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from occulink.functions import identifiers, records
from occulink.functions.common import distinct_present, memoized
from occulink.functions.geo import round_half_up


def _empty() -> Column:
    return F.array().cast("array<string>")

# Default bound on the broadcast list of over-full keys; see ``filter_hashes``.
DEFAULT_STOP_LIST_SIZE = 10_000
# Size of the prefilter's bitmap: 64 MB at most.
MAX_PREFILTER_BITS = 1 << 29


def _present(c: Column) -> Column:
    """``noNulls`` for one string value: neither NULL nor empty."""
    return c.isNotNull() & (c != "")


def _keys_if(cond: Column, keys: Column) -> Column:
    return F.when(cond, keys).otherwise(_empty())


def _codes(allow_numeric: bool, separators: bool = True) -> Column:
    """``codes_and_ids`` of ``with_codes`` rows."""
    forms = identifiers.single_codes(allow_numeric) + identifiers.joined_codes(separators)
    return distinct_present(F.concat(F.array(*forms), identifiers.other_codes(allow_numeric)))


# per-record code sets: name -> (numeric codes allowed, keep ``:`` separators)
CODE_SETS = {
    "_codes": (True, True),
    "_strict_codes": (False, True),
    "_bare_codes": (True, False),
    "_strict_bare_codes": (False, False),
}


def with_code_sets(recs: DataFrame, names=("_codes", "_strict_codes")) -> DataFrame:
    """Add per-record code sets (see ``CODE_SETS``) as array columns."""
    added = [_codes(*CODE_SETS[n]).alias(n) for n in names]
    return identifiers.with_codes(recs).select(*recs.columns, *added)


# single codes, then ``ic:cc:cn`` and ``ic:cn``
_FIXED_CODES = len(identifiers.SINGLE_CODE_FIELDS) + 2


def _other_codes(allow_numeric: bool, prefix: Column | None = None) -> Column:
    """Codes from the other-catalog-number list, optionally as ``prefix|code``."""
    codes = identifiers.other_codes(allow_numeric)
    return codes if prefix is None else F.transform(codes, lambda x: F.concat(prefix, F.lit("|"), x))


def _prefixed(prefix: Column, codes: list[Column]) -> Column:
    return F.array(*[F.concat(prefix, F.lit("|"), c) for c in codes])


def place_date_key() -> Column:
    """H1 as a scalar: species, coordinates to 3 decimals (Java rounding) and
    full date; NULL when any part is missing."""
    sp, lat, lng = F.col("speciesKey"), F.col("decimalLatitude"), F.col("decimalLongitude")
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    key = F.concat_ws(
        "|",
        F.upper(sp),
        round_half_up(lat * 1000.0).cast("string"),
        round_half_up(lng * 1000.0).cast("string"),
        y.cast("string"),
        m.cast("string"),
        d.cast("string"),
    )
    cond = lat.isNotNull() & lng.isNotNull() & y.isNotNull() & m.isNotNull() & d.isNotNull()
    return F.when(cond & _present(sp), key)


def type_key() -> Column:
    """H3 as a scalar: taxon with any stated type status, else NULL."""
    tk, ts = F.col("taxonKey"), F.col("typeStatus")
    cond = _present(tk) & ts.isNotNull() & (F.size(ts) > 0)
    return F.when(cond, F.concat(F.upper(tk), F.lit("|TYPE")))


def record_hashes(recs: DataFrame, families=None) -> DataFrame:
    """``(gbifId, datasetKey, hash)``, one row per distinct key of each record.

    Runs map-side only, in two operators: a projection computing every
    scalar part of the keys (code-generated: it holds no lambda), then the
    ``explode`` that adds the per-element keys of the list fields (lambda
    functions disable code generation for the operator holding them, so they
    are kept to small expressions over prepared columns).
    """
    families = KEY_FAMILIES if families is None else tuple(families)
    scalars = {}
    lists = {}
    for fam in families:
        for name, expr in _SCALAR_PARTS[fam]().items():
            scalars[name] = expr
        lists[fam] = _LIST_PARTS[fam]
    prepared = identifiers.with_codes(recs).select(
        "gbifId",
        "datasetKey",
        "_n_others",
        "_s_others",
        "recordedBy",
        *[e.alias(n) for n, e in scalars.items()],
    )
    parts = [lists[f]() for f in families]
    keys = distinct_present(parts[0] if len(parts) == 1 else F.concat(*parts))
    return prepared.select("gbifId", "datasetKey", F.explode(keys).alias("hash"))


def _c(name: str) -> Column:
    return F.col(name)


@memoized
def _scalar_place_date() -> dict:
    return {"_k_place": place_date_key()}


@memoized
def _list_place_date() -> Column:
    return F.array(_c("_k_place"))


@memoized
def _scalar_species_identifier() -> dict:
    sp = F.col("speciesKey")
    codes = identifiers.single_codes(True) + identifiers.joined_codes(True)
    out = {"_sp_ok": _present(sp), "_spu": F.upper(sp)}
    out.update({f"_k_sid{i}": F.concat(F.upper(sp), F.lit("|"), c) for i, c in enumerate(codes)})
    return out


@memoized
def _list_species_identifier() -> Column:
    fixed = F.array(*[_c(f"_k_sid{i}") for i in range(_FIXED_CODES)])
    return _keys_if(_c("_sp_ok"), F.concat(fixed, _other_codes(True, _c("_spu"))))


@memoized
def _scalar_type() -> dict:
    return {"_k_type": type_key()}


@memoized
def _list_type() -> Column:
    return F.array(_c("_k_type"))


@memoized
def _scalar_recorder() -> dict:
    tk, y = F.col("taxonKey"), F.col("year")
    return {"_rec_ok": _present(tk) & y.isNotNull(), "_year": y.cast("string")}


@memoized
def _list_recorder() -> Column:
    rb = F.col("recordedBy")
    keys = F.transform(rb, lambda r: F.concat(_c("_year"), F.lit("|"), F.upper(F.coalesce(r, F.lit("null")))))
    return _keys_if(_c("_rec_ok") & rb.isNotNull(), keys)


@memoized
def _scalar_specimen() -> dict:
    sp = F.upper(F.coalesce(F.col("speciesKey"), F.lit("null")))
    with_species = identifiers.single_codes(True) + identifiers.joined_codes(False)
    alone = identifiers.single_codes(False) + identifiers.joined_codes(False)
    out = {
        "_spec_ok": F.coalesce(F.col("basisOfRecord").isin(*records.HASHING_SPECIMEN_BASES), F.lit(False)),
        "_sp5": sp,
    }
    out.update({f"_k_spw{i}": F.concat(sp, F.lit("|"), c) for i, c in enumerate(with_species)})
    out.update({f"_k_spa{i}": c for i, c in enumerate(alone)})
    return out


@memoized
def _list_specimen() -> Column:
    n = _FIXED_CODES
    fixed = F.array(*[_c(f"_k_spw{i}") for i in range(n)], *[_c(f"_k_spa{i}") for i in range(n)])
    keys = F.concat(fixed, _other_codes(True, _c("_sp5")), _other_codes(False))
    return _keys_if(_c("_spec_ok"), keys)


_SCALAR_PARTS = {
    "place_date": _scalar_place_date,
    "species_identifier": _scalar_species_identifier,
    "type": _scalar_type,
    "recorder": _scalar_recorder,
    "specimen": _scalar_specimen,
}
_LIST_PARTS = {
    "place_date": _list_place_date,
    "species_identifier": _list_species_identifier,
    "type": _list_type,
    "recorder": _list_recorder,
    "specimen": _list_specimen,
}

# Key families: H1 place_date, H2 species_identifier, H3 type, H4 recorder,
# H5 + H6 specimen.
KEY_FAMILIES = tuple(_SCALAR_PARTS)


def key_counts(hashes: DataFrame) -> DataFrame:
    """Records per key; partial aggregation combines each key map-side first."""
    return hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("cnt"))


def repeated_bitmap(hashes: DataFrame, bits: int) -> DataFrame:
    """``(bucket, repeated)``: a bitmap, in pieces of 1,024 words of 32 bits, of the hashed
    positions that two rows or more fall on.  Rows are counted by position (8
    bytes, combined map-side), not by key."""
    counts = hashes.select(_position("hash", bits).alias("position")).groupBy("position").agg(F.count(F.lit(1)).alias("n"))
    return _bitmap(counts.where(F.col("n") > 1).select("position"))


def _position(name: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(bits)) + 1


def bitmap_of(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """A bitmap, in the form of ``repeated_bitmap``, of the positions of the column."""
    return _bitmap(rows.select(_position(name, bits).alias("position")))


def _bitmap(positions: DataFrame) -> DataFrame:
    bit = F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("repeated")
    pieces = positions.groupBy(F.bitmap_bucket_number("position").alias("bucket")).agg(bit)
    return pieces.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(1023)), _word).alias("repeated"))


def _word(i: Column) -> Column:
    """Bytes ``4 i`` to ``4 i + 3`` of a piece as one number, the first byte
    highest, less 2**31: rows look numbers up in place, bytes would be copied."""
    unsigned = F.conv(F.hex(F.substring(F.col("repeated"), i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    return (unsigned - (1 << 31)).cast("int")


def prefilter_hashes(hashes: DataFrame, bits: int) -> DataFrame:
    """Drop, before any shuffle of the rows, most rows whose key no other row
    holds.  All rows of a key share a position, so a key with two rows or more
    always stays; single ones stay where they meet another key's position.  The
    broadcast bitmap holds at most ``bits / 8`` bytes."""
    return in_bitmap(hashes, "hash", repeated_bitmap(hashes, bits), bits)


def in_bitmap(rows: DataFrame, name: str, bitmap: DataFrame, bits: int, inside: bool = True) -> DataFrame:
    """The rows whose column's position is set in the (broadcast) bitmap, or is not
    set.  (NULL has a position as any value has.)"""
    placed = rows.withColumn("_position", _position(name, bits)).withColumn("bucket", F.bitmap_bucket_number("_position"))
    bit = F.bitmap_bit_position("_position")
    word = F.get("repeated", F.shiftright(bit, 5).cast("int")).cast("bigint") + (1 << 31)
    place = (3 - F.shiftright(bit, 3) % 4) * 8 + bit % 8
    is_set = F.getbit(word, place.cast("int")) == 1
    if inside:
        return placed.join(F.broadcast(bitmap), "bucket").where(is_set).select(*rows.columns)
    # a bucket without any position is no row of the bitmap
    return placed.join(F.broadcast(bitmap), "bucket", "left").where(F.coalesce(~is_set, F.lit(True))).select(*rows.columns)


def prefilter_bits(rows: int) -> int:
    """16 bits a row, as a power of two, at most ``MAX_PREFILTER_BITS``."""
    return min(MAX_PREFILTER_BITS, max(1 << 15, 1 << (16 * rows).bit_length()))


def filter_hashes(
    hashes: DataFrame,
    max_group_size: int = 100,
    method: str = "group",
    stop_list_size: int = DEFAULT_STOP_LIST_SIZE,
    bits: int | None = None,
) -> DataFrame:
    """Keep hash rows whose key is held by more than one and at most
    ``max_group_size`` rows (all datasets counted).

    ``method="group"`` (default) counts keys with a map-side-combined
    aggregate and joins the verdict back.  It never gathers one key's rows in
    one task before dropping them: keys holding more than
    ``max(max_group_size, total_rows / stop_list_size)`` rows are removed
    map-side through a broadcast anti-join.  Fewer than ``stop_list_size``
    keys can exceed ``total_rows / stop_list_size`` rows, so the broadcast is
    bounded by construction (``total_rows`` is a scalar subquery over the
    counts), and every key that reaches the shuffle holds at most that many
    rows.  The remaining rows meet the allowed keys in one shuffle on
    ``hash``, whose partitioning the pair self-join then reuses.

    ``bits``, for hashes that are stored, spares shuffles by two broadcast
    bitmaps: ``prefilter_hashes`` before the count, and a second one of the
    allowed keys' positions, so that hardly a row travels whose key is not
    allowed.  The allowed keys themselves are met by an inner join (they are
    distinct): a semi join would be pushed below the bitmap's join, and every row
    be shuffled.

    ``method="window"`` is the literal ``COUNT(*) OVER (PARTITION BY hash)``
    form, which buffers every row of a key in one task.
    """
    if method == "window":
        cnt = F.count(F.lit(1)).over(Window.partitionBy("hash"))
        return (
            hashes.withColumn("_cnt", cnt)
            .where((F.col("_cnt") > 1) & (F.col("_cnt") <= max_group_size))
            .drop("_cnt")
        )
    if method != "group":
        raise ValueError(f"unknown method {method!r}")
    counts = key_counts(prefilter_hashes(hashes, bits) if bits else hashes)
    allowed = counts.where((F.col("cnt") > 1) & (F.col("cnt") <= max_group_size)).select("hash")
    rows = hashes
    if stop_list_size > 0:
        total = counts.agg(F.sum("cnt")).scalar()
        floor = F.greatest(F.lit(max_group_size), F.ceil(total / F.lit(stop_list_size)))
        heaviest = counts.where(F.col("cnt") > floor).select("hash")
        rows = rows.join(F.broadcast(heaviest), "hash", "left_anti")
    if not bits:
        return rows.join(allowed, "hash", "left_semi")
    marked = in_bitmap(rows, "hash", bitmap_of(allowed, "hash", bits), bits)
    return marked.join(allowed, "hash")


def candidate_pairs(filtered: DataFrame, method: str = "least_key") -> DataFrame:
    """Distinct ``(id1, ds1, id2, ds2)`` for records sharing a kept key.

    ``id1 < id2`` (string order) keeps each pair once and ``ds1 != ds2``
    skips pairs inside one dataset.  The pairs are the same by either method:

    * ``"least_key"``: each row carries the smaller ones of its record's kept
      keys, and a pair counts only at the least key that both records hold:
      where they share a smaller one, it has counted there.  So pairs come out of
      the join distinct, however many keys they share, and no pair is shuffled to
      find that out.  A record's keys are gathered by one exchange of the key
      rows, and travel again, a list a row, to the join.
    * ``"distinct"``: key rows meet where the key filter left them.  A pair is
      dealt by ``id1``, once for each key that it shares, and made distinct
      there, where the join with the first records wants it.  Of a pair only two
      ids and datasets move, which is less than the lists unless groups are large
      and their records share many keys.
    """
    if method == "distinct":
        rows = filtered.select("gbifId", "datasetKey", "hash")
        left = rows.select("hash", F.col("gbifId").alias("id1"), F.col("datasetKey").alias("ds1"))
        right = rows.select("hash", F.col("gbifId").alias("id2"), F.col("datasetKey").alias("ds2"))
        on = (left["hash"] == right["hash"]) & (left["id1"] < right["id2"]) & (left["ds1"] != right["ds2"])
        return left.join(right, on).select("id1", "ds1", "id2", "ds2").repartition("id1").distinct()
    if method != "least_key":
        raise ValueError(f"unknown method {method!r}")
    keys = filtered.groupBy("gbifId", "datasetKey").agg(F.sort_array(F.collect_set("hash")).alias("keys"))
    rows = keys.select("gbifId", "datasetKey", "keys", F.posexplode("keys").alias("place", "hash"))
    rows = rows.select("gbifId", "datasetKey", "hash", F.slice("keys", F.lit(1), F.col("place")).alias("smaller"))
    left = rows.select("hash", F.col("gbifId").alias("id1"), F.col("datasetKey").alias("ds1"), F.col("smaller").alias("smaller1"))
    right = rows.select("hash", F.col("gbifId").alias("id2"), F.col("datasetKey").alias("ds2"), F.col("smaller").alias("smaller2"))
    joined = left.join(
        right,
        (left["hash"] == right["hash"])
        & (left["id1"] < right["id2"])
        & (left["ds1"] != right["ds2"])
        & ~F.arrays_overlap("smaller1", "smaller2"),
    )
    return joined.select("id1", "ds1", "id2", "ds2")
