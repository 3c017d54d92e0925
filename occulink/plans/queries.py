"""Registered queries over the driver's tables, one per operator group.

Every query reads the whole ``orders``/``customer`` (linkage) or
``documents`` (FASTA) tables of a data directory and returns a DataFrame with
scalar columns; list-valued results are rendered as ``|``-joined text (set
semantics: sorted first) so that any engine can compare them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occulink.functions import identifiers as ident
from occulink.functions import sql
from occulink.functions.common import distinct_present
from occulink.functions.records import RECORD_COLUMNS
from occulink.operators import blocking, export, facts, features, relate, rules
from occulink.operators.cellstore import CellStore, Layout
from occulink.operators.fasta import fasta
from occulink.session import apply_job_conf, cut_lineage, scratch_path, store_by_key
from occulink.sources.fixtures import CHECKLIST_KEY, occurrence_source, sequence_source

MAX_GROUP_SIZE = 100
BUCKETS = 100
LIST_FIELDS = ("typeStatus", "otherCatalogNumbers", "recordedBy")


def list_text(c: Column, as_set: bool = False) -> Column:
    """NULL stays NULL; otherwise elements joined by ``|`` (sorted for sets)."""
    return F.when(c.isNotNull(), F.array_join(F.array_sort(c) if as_set else c, "|"))


def render_lists(df: DataFrame, names=LIST_FIELDS, prefix: str = "") -> DataFrame:
    for n in names:
        df = df.withColumn(prefix + n, list_text(F.col(prefix + n)))
    return df


# ---- shared stages ----------------------------------------------------------


def records(spark: SparkSession, data_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return features.partition_by_record(features.input_projection(occurrence_source(spark, data_dir), CHECKLIST_KEY))


def stored_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """The records, projected, dealt and stored once, for queries that derive keys
    from them and then meet them again by id."""
    apply_job_conf(spark)
    recs = features.input_projection(occurrence_source(spark, data_dir), CHECKLIST_KEY)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return store_by_key(features.partition_by_record(recs, buckets, packed=True), "gbifId")


def _hashes(spark, data_dir, families=tuple(blocking.KEY_FAMILIES)) -> DataFrame:
    return blocking.record_hashes(records(spark, data_dir), families)


def kept_hashes(hashes: DataFrame) -> DataFrame:
    """The key filter over stored key rows, so that keys are derived once and
    single ones go before the shuffle."""
    stored = cut_lineage(hashes, "parquet")
    return blocking.filter_hashes(stored, MAX_GROUP_SIZE, bits=blocking.prefilter_bits(stored.count()))


def _filtered(spark, data_dir) -> DataFrame:
    return kept_hashes(_hashes(spark, data_dir))


def _pairs(spark, data_dir) -> DataFrame:
    return blocking.candidate_pairs(_filtered(spark, data_dir), "distinct")


def _paired(spark, data_dir, packed: bool = False) -> DataFrame:
    recs = stored_records(spark, data_dir)
    pairs = blocking.candidate_pairs(kept_hashes(blocking.record_hashes(recs)), "distinct")
    return relate.attach_records(pairs, features.comparison_features(recs), packed)


def _one_direction(spark, data_dir, with_json: bool) -> DataFrame:
    recs = stored_records(spark, data_dir)
    pairs = blocking.candidate_pairs(kept_hashes(blocking.record_hashes(recs)), "distinct")
    return relate.one_direction(recs, pairs, with_json=with_json)


def _relationships(spark, data_dir, with_json: bool) -> DataFrame:
    recs = stored_records(spark, data_dir)
    pairs = blocking.candidate_pairs(kept_hashes(blocking.record_hashes(recs)), "distinct")
    return relate.relationships(recs, pairs, with_json=with_json)


# ---- queries ----------------------------------------------------------------


def q_fasta_distinct(spark, data_dir):
    return fasta(sequence_source(spark, data_dir))


def q_input_projection(spark, data_dir):
    return render_lists(records(spark, data_dir))


def q_normalize_identifiers(spark, data_dir):
    """S1-S5 for every raw code of every record."""
    recs = records(spark, data_dir)
    singles = ["occurrenceID", "recordNumber", "fieldNumber", "catalogNumber", "institutionCode", "collectionCode"]
    entries = F.concat(
        F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("raw")) for n in singles]),
        F.transform(
            F.coalesce(F.col("otherCatalogNumbers"), F.array().cast("array<string>")),
            lambda x, i: F.struct(
                F.concat(F.lit("otherCatalogNumbers["), (i + 1).cast("string"), F.lit("]")).alias("field"),
                x.alias("raw"),
            ),
        ),
    )
    codes = recs.select("gbifId", F.inline(entries))
    raw = F.col("raw")
    return codes.select(
        "gbifId",
        "field",
        "raw",
        ident.normalize_id(raw).alias("normalized"),
        ident.is_eligible(raw).alias("eligible"),
        ident.is_numeric(raw).alias("numeric"),
        ident.hash_or_null(raw, True).alias("code_any"),
        ident.hash_or_null(raw, False).alias("code_strict"),
    )


def q_identifier_list(spark, data_dir):
    """S6-S9 and the per-record identifier sets used by the rules."""
    recs = records(spark, data_dir)
    ic, cc, cn = "institutionCode", "collectionCode", "catalogNumber"
    atoms = [F.col(f"_n_{c}") for c in (ic, cc, cn)]
    sets = ident.with_codes(blocking.with_code_sets(recs)).select(
        "*",
        features.record_identifiers().alias("_identifiers"),
        ident.prepared_identifier_set().alias("_id_set"),
        distinct_present(F.col("_catalog_others")).alias("_other_codes"),
    )
    return sets.select(
        "gbifId",
        ident.triple_identifier(ic, cc, cn).alias("triple"),
        ident.scoped_identifier(ic, cn).alias("scoped"),
        list_text(F.col("_identifiers")).alias("identifiers"),
        F.concat(atoms[0], F.lit(":"), atoms[1], F.lit(":"), atoms[2]).alias("triple_code"),
        F.concat(atoms[0], F.lit(":"), atoms[2]).alias("scoped_code"),
        list_text(F.col("_id_set"), True).alias("id_set"),
        ident.prepared_catalog_code().alias("catalog_code"),
        list_text(F.col("_other_codes"), True).alias("other_codes"),
        list_text(F.col("_codes"), True).alias("codes_any"),
        list_text(F.col("_strict_codes"), True).alias("codes_strict"),
    )


def _family(name):
    return lambda spark, data_dir: _hashes(spark, data_dir, (name,))


def q_record_hashes(spark, data_dir):
    return _hashes(spark, data_dir)


def q_hashes_filtered(spark, data_dir):
    return _filtered(spark, data_dir)


def q_candidate_pairs(spark, data_dir):
    return _pairs(spark, data_dir)


def q_candidate_records(spark, data_dir):
    recs = stored_records(spark, data_dir)
    pairs = blocking.candidate_pairs(kept_hashes(blocking.record_hashes(recs)), "distinct")
    wide = relate.pair_records(pairs, recs)
    for side in ("t1_", "t2_"):
        wide = render_lists(wide, prefix=side)
    return wide


def _facts(group):
    def run(spark, data_dir):
        a, b = facts.sides()
        cols = facts.FACT_GROUPS[group](a, b)
        if group == "type":
            cols = {**facts.species_facts(a, b), **cols}
        return _paired(spark, data_dir).select(
            "id1", "id2", *[c.alias(n) for n, c in cols.items()]
        )

    return run


def q_decision(spark, data_dir):
    fact_cols, a, b = relate.fact_columns()
    rule_cols = rules.rule_columns(fact_cols, a, b)
    short = fact_cols["SAME_SPECIMEN"] | fact_cols["TYPIFICATION_RELATION"]
    veto = fact_cols["DIFFERENT_DATE"] | fact_cols["DIFFERENT_COUNTRY"]
    return relate.with_facts(_paired(spark, data_dir, packed=True)).select(
        "id1",
        "id2",
        short.alias("R0"),
        veto.alias("vetoed"),
        *[c.alias(n) for n, c in rule_cols.items()],
        rules.related(fact_cols, a, b).alias("related"),
        facts.reasons(fact_cols).alias("reasons"),
    )


def q_relationships(spark, data_dir):
    return _relationships(spark, data_dir, with_json=False)


def relationships_with_records(spark, data_dir):
    """All seven relationship columns (ids, reasons, datasets, both records as JSON)."""
    return _relationships(spark, data_dir, with_json=True)


def q_relationship_json(spark, data_dir):
    return _relationships(spark, data_dir, with_json=True).select("id1", "id2", "o1", "o2")


def q_export_cells(spark, data_dir):
    return export.export_cells(_relationships(spark, data_dir, with_json=False), BUCKETS, with_json=False)


def served_cells(spark, data_dir, with_json: bool) -> CellStore:
    """A cell store that serves all relationships of the data.  They are stored once
    a pair, and their records as values, until they become cells."""
    store = CellStore(spark, scratch_path(spark, "cells"), Layout(buckets=BUCKETS))
    stored = cut_lineage(_one_direction(spark, data_dir, with_json), "parquet")
    store.refresh(relate.both_directions(stored, with_json), with_json, lineage=None)
    return store


def _returned_orders(spark, data_dir) -> DataFrame:
    returned = spark.read.parquet(f"{data_dir}/lineitem.parquet").where(F.col("l_returnflag") == "R")
    return returned.select(F.col("l_orderkey").cast("string").alias("id"))


def q_lookup_related(spark, data_dir):
    """Batch lookup, in the written cells, of what is related to the records whose
    order had a returned line item."""
    return served_cells(spark, data_dir, with_json=False).related(_returned_orders(spark, data_dir))


def q_lookup_record(spark, data_dir):
    """Prefix lookup, in the written cells, of the record with the most
    relationships (ties: the smallest id)."""
    store = served_cells(spark, data_dir, with_json=True)
    by_id = store.cells().where(F.col("qualifier") == "id1").groupBy("value").count()
    busiest = by_id.orderBy(F.desc("count"), "value").first()
    return store.lookup(busiest["value"] if busiest else "")


def q_export_cells_records(spark, data_dir):
    """``export_cells`` over all seven qualifiers, both records among them, which travel
    as values and become JSON with the cells."""
    return export.export_cells(relate.both_directions(_one_direction(spark, data_dir, with_json=True)), BUCKETS)


def q_lookup_related_records(spark, data_dir):
    """``lookup_related`` over all seven qualifiers."""
    return served_cells(spark, data_dir, with_json=True).related(_returned_orders(spark, data_dir))


def q_sql_functions(spark, data_dir):
    """A report in SQL over the session's functions: records by country,
    normalised catalog number (and whether it is eligible), numeric field number
    and nucleotide letters of the name, with the greatest distance from the
    country's located record of the smallest id."""
    sql.register(spark)
    records(spark, data_dir).createOrReplaceTempView("occulink_records")
    return spark.sql(
        """
        WITH r AS (
          SELECT gbifId, countryCode, decimalLatitude AS lat, decimalLongitude AS lng,
                 normalize_identifier(catalogNumber) AS code,
                 is_eligible_identifier(catalogNumber) AS eligible,
                 is_numeric_identifier(fieldNumber) AS numeric_field,
                 normalize_sequence(scientificName) AS letters
          FROM occulink_records),
        f AS (SELECT countryCode, min_by(lat, gbifId) AS lat0, min_by(lng, gbifId) AS lng0 FROM r
              WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY countryCode)
        SELECT r.countryCode, r.code, r.eligible, r.numeric_field, r.letters, count(*) AS records,
               round(max(great_circle_km(lat0, lng0, lat, lng)), 6) AS farthest_km
        FROM r JOIN f ON f.countryCode <=> r.countryCode
        GROUP BY r.countryCode, r.code, r.eligible, r.numeric_field, r.letters"""
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fasta_distinct": q_fasta_distinct,
    "input_projection": q_input_projection,
    "normalize_identifiers": q_normalize_identifiers,
    "identifier_list": q_identifier_list,
    "hash_place_date": _family("place_date"),
    "hash_species_id": _family("species_identifier"),
    "hash_type": _family("type"),
    "hash_recorder": _family("recorder"),
    "hash_specimen": _family("specimen"),
    "record_hashes": q_record_hashes,
    "hashes_filtered": q_hashes_filtered,
    "candidate_pairs": q_candidate_pairs,
    "candidate_records": q_candidate_records,
    "facts_date": _facts("date"),
    "facts_coordinates": _facts("coordinates"),
    "facts_country": _facts("country"),
    "facts_identifiers": _facts("identifiers"),
    "facts_catalog": _facts("catalog"),
    "facts_recorder": _facts("recorder"),
    "facts_type": _facts("type"),
    "decision": q_decision,
    "relationships": q_relationships,
    "relationship_json": q_relationship_json,
    "export_cells": q_export_cells,
    "lookup_related": q_lookup_related,
    "export_cells_records": q_export_cells_records,
    "lookup_related_records": q_lookup_related_records,
    "lookup_record": q_lookup_record,
    "sql_functions": q_sql_functions,
}

# columns of a full record, as written by ``pair_records``
PAIR_RECORD_COLUMNS = tuple(f"t1_{c}" for c in RECORD_COLUMNS) + tuple(f"t2_{c}" for c in RECORD_COLUMNS)
