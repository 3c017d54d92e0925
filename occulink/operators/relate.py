"""Pair expansion (J2, J3), decision and relationship output (O1-O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occulink.functions.packing import pack, unpack
from occulink.functions.records import RECORD_COLUMNS, record_values, with_record_texts
from occulink.operators import facts as facts_mod
from occulink.operators import rules
from occulink.operators.features import FEATURE_FIELDS, comparison_features

RELATIONSHIP_COLUMNS = ("id1", "id2", "reasons", "dataset1", "dataset2", "o1", "o2")


def attach_records(pairs: DataFrame, features: DataFrame, packed: bool = False) -> DataFrame:
    """Join each candidate pair to both records' comparison features.

    Result: ``id1, ds1, id2, ds2, o1, o2`` with ``o1``/``o2`` structs.  Two
    equi-joins on the record id; ``pairs`` from ``candidate_pairs`` is
    already hash-partitioned by ``id1``, so the first join shuffles only the
    features.  The structs are made after the joins, which so move only the
    fields that are used later.  Sizes of stored records are guessed from their
    compressed files, so the joins are told not to broadcast them.

    ``packed``, for uses of most fields: the first record's fields travel to the
    second record as one text, made once a record (see ``packing``).
    """
    fields = [f for f in FEATURE_FIELDS if f != "gbifId"]
    left = features.select(F.col("gbifId").alias("id1"), *[F.col(f).alias(f"_1_{f}") for f in fields])
    right = features.select(F.col("gbifId").alias("id2"), *[F.col(f).alias(f"_2_{f}") for f in fields])
    names = [f"_1_{f}" for f in fields]
    first = pairs.join((pack(left, names) if packed else left).hint("merge"), "id1")
    joined = first.join(right.hint("merge"), "id2")
    if packed:
        joined = unpack(joined, left.schema, names, "_1")

    def record(side: int):
        at = F.col("_1").getField if packed and side == 1 else F.col
        return F.struct(*[F.col(f"id{side}").alias(f) if f == "gbifId" else at(f"_{side}_{f}").alias(f) for f in FEATURE_FIELDS]).alias(f"o{side}")

    return joined.select("id1", "ds1", "id2", "ds2", record(1), record(2))


def pair_records(pairs: DataFrame, recs: DataFrame) -> DataFrame:
    """Candidate pairs expanded to both full records, columns prefixed
    ``t1_`` / ``t2_`` (the wide pair table; J2, J3, PF7)."""
    cols = [c for c in RECORD_COLUMNS if c in recs.columns]
    t1 = recs.select(*[F.col(c).alias(f"t1_{c}") for c in cols])
    t2 = recs.select(*[F.col(c).alias(f"t2_{c}") for c in cols])
    joined = pairs.join(t1.hint("merge"), pairs["id1"] == t1["t1_gbifId"]).join(t2.hint("merge"), pairs["id2"] == t2["t2_gbifId"])
    return joined.select(*[f"t1_{c}" for c in cols], *[f"t2_{c}" for c in cols])


def judge(paired: DataFrame, strict_days: bool = False) -> DataFrame:
    """Add every fact column, ``reasons`` and ``related`` to a pair table."""
    a, b = facts_mod.sides("o1", "o2")
    fact_cols = facts_mod.all_facts(a, b, strict_days)
    return paired.select(
        "*",
        *[c.alias(n) for n, c in fact_cols.items()],
        facts_mod.reasons(fact_cols).alias("reasons"),
        rules.related(fact_cols, a, b).alias("related"),
    )


def related_pairs(paired: DataFrame, strict_days: bool = False) -> DataFrame:
    """Related pairs, one direction (``id1 < id2``), with their reasons."""
    judged = with_facts(paired, strict_days)
    fact_cols, a, b = fact_columns()
    # exploded, not filtered: a filter would go below the facts' projection and
    # work every fact out again for each rule that names it
    kept = F.when(rules.related(fact_cols, a, b), F.array(facts_mod.reasons(fact_cols)))
    rel = judged.select("id1", "id2", "ds1", "ds2", F.explode(kept).alias("reasons"))
    return rel.select("id1", "id2", "reasons", F.col("ds1").alias("dataset1"), F.col("ds2").alias("dataset2"))


# what the rules ask of the records besides the facts
PAIR_FLAGS = ("sequenceRepository", "ruleSpecimen")


def with_facts(paired: DataFrame, strict_days: bool = False) -> DataFrame:
    """Pairs with each fact, and each record's flags, as columns of one projection."""
    a, b = facts_mod.sides("o1", "o2")
    flags = [side(f).alias(f"_{i}_{f}") for i, side in ((1, a), (2, b)) for f in PAIR_FLAGS]
    found = facts_mod.all_facts(a, b, strict_days)
    return paired.select("id1", "id2", "ds1", "ds2", *[c.alias(n) for n, c in found.items()], *flags)


def fact_columns():
    """The facts of ``with_facts`` rows by name, and the flags of either side."""
    fact_cols = {n: F.col(n) for n in facts_mod.FACT_ORDER}
    return fact_cols, lambda f: F.col(f"_1_{f}"), lambda f: F.col(f"_2_{f}")


def both_directions(rel: DataFrame, with_json: bool = True) -> DataFrame:
    """Emit every related pair twice, ids/datasets/records swapped (O2)."""
    names = ["id1", "id2", "reasons", "dataset1", "dataset2"] + (["o1", "o2"] if with_json else [])
    swap = {"id1": "id2", "id2": "id1", "dataset1": "dataset2", "dataset2": "dataset1", "o1": "o2", "o2": "o1"}
    fwd = F.struct(*[F.col(n).alias(n) for n in names])
    rev = F.struct(*[F.col(swap.get(n, n)).alias(n) for n in names])
    return rel.select(F.inline(F.array(fwd, rev)))


def relationships(
    recs: DataFrame,
    pairs: DataFrame,
    strict_days: bool = False,
    with_json: bool = True,
) -> DataFrame:
    """Relationships in both directions, ``RELATIONSHIP_COLUMNS`` schema.

    Rules run on the compact features; the JSON of both records (O3) is
    joined only to pairs that passed, so the wide rows never travel through the
    candidate shuffles.
    """
    one = one_direction(recs, pairs, strict_days, with_json)
    return both_directions(with_record_texts(one, RECORD_TEXTS) if with_json else one, with_json)


RECORD_TEXTS = ("o1", "o2")


def one_direction(recs: DataFrame, pairs: DataFrame, strict_days: bool = False, with_json: bool = True) -> DataFrame:
    """Related pairs, ``id1 < id2``, with both records as ``record_values``: their
    JSON without its names, made once a record, which moves and is stored in less
    space (``with_record_texts`` gives the JSON)."""
    judged = related_pairs(attach_records(pairs, comparison_features(recs), packed=True), strict_days)
    if not with_json:
        return judged
    docs = recs.select(F.col("gbifId").alias("_id"), record_values().alias("_json"))  # wide: not to be broadcast
    # join on id2 first: the pairs arrive hash-partitioned by id2 from attach_records
    with2 = judged.join(docs.select(F.col("_id").alias("id2"), F.col("_json").alias("o2")).hint("merge"), "id2")
    with12 = with2.join(docs.select(F.col("_id").alias("id1"), F.col("_json").alias("o1")).hint("merge"), "id1")
    return with12.select(*RELATIONSHIP_COLUMNS)
