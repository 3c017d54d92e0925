"""Input projection (PF1-PF6) and per-record comparison features.

The comparison features hold everything the pair rules need, derived once per
record (normalised identifier sets, catalog codes, lower-cased recorders, type
flags).  Pairs then compare small precomputed values instead of re-normalising
both records for every candidate pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occulink.functions import dates, identifiers, lists, nulls, records
from occulink.functions.common import distinct_present, false_if_null, memoized
from occulink.functions.packing import pack, unpack

# fixed value: taxonomic issue that disqualifies a record from linkage
HIGHER_RANK_ISSUE = "TAXON_MATCH_HIGHERRANK"

LIST_COLUMNS = ("typeStatus", "otherCatalogNumbers", "recordedBy")


def input_projection(source: DataFrame, checklist_key: str) -> DataFrame:
    """Project the wide occurrence table to the 23 linkage columns.

    * species/taxon keys come from ``classificationDetails[checklist_key]``;
    * rows without that checklist entry or species key are dropped;
    * rows flagged ``TAXON_MATCH_HIGHERRANK`` for the checklist are dropped,
      and so are rows where that flag is unknown (missing issue entry, or a
      NULL element and no match): the negated membership test is NULL there;
    * ``eventDateGte`` (epoch seconds) becomes the ``eventDate`` string in the
      session time zone; ``ext_multimedia`` is renamed ``media``;
    * list fields stored as vocabulary structs are unwrapped to their concepts.
    """
    cls = F.col("classificationDetails")[checklist_key]
    issues = F.col("taxonomicissue")[checklist_key]
    keep = (
        cls.isNotNull()
        & cls["specieskey"].isNotNull()
        & ~F.array_contains(issues, HIGHER_RANK_ISSUE)
    )
    return source.where(keep).select(
        F.col("gbifId").cast("string").alias("gbifId"),
        "datasetKey",
        "basisOfRecord",
        cls["specieskey"].cast("string").alias("speciesKey"),
        cls["taxonkey"].cast("string").alias("taxonKey"),
        "scientificName",
        records.list_column(source, "typeStatus").alias("typeStatus"),
        "decimalLatitude",
        "decimalLongitude",
        "countryCode",
        "year",
        "month",
        "day",
        F.from_unixtime("eventDateGte").alias("eventDate"),
        "recordNumber",
        "fieldNumber",
        "occurrenceID",
        records.list_column(source, "otherCatalogNumbers").alias("otherCatalogNumbers"),
        "institutionCode",
        "collectionCode",
        "catalogNumber",
        records.list_column(source, "recordedBy").alias("recordedBy"),
        F.col("ext_multimedia").alias("media"),
    )


def partition_by_record(recs: DataFrame, partitions: int | None = None, packed: bool = False) -> DataFrame:
    """Hash-partition records by ``gbifId`` (one shuffle of the narrow projection).

    Everything derived per record (keys, comparison features, JSON) then runs
    spread over many tasks whatever the input file layout, and the joins back
    to records on ``id1`` / ``id2`` find the record side already partitioned,
    so only the pair side moves.  Without ``partitions`` the count follows
    ``spark.sql.shuffle.partitions`` and AQE may coalesce small partitions.
    ``packed``: the other columns travel as one text (see ``packing``).
    """
    if packed:
        others = [c for c in recs.columns if c != "gbifId"]
        dealt = partition_by_record(pack(recs, others), partitions)
        back = unpack(dealt, recs.schema, others, "_record")
        return back.select(*[c if c in back.columns else F.col("_record")[c].alias(c) for c in recs.columns])
    if partitions:
        return recs.repartition(partitions, "gbifId")
    return recs.repartition("gbifId")


def record_identifiers() -> F.Column:
    """Raw identifier list of each record."""
    return identifiers.list_identifiers(
        "occurrenceID",
        "fieldNumber",
        "recordNumber",
        "catalogNumber",
        "institutionCode",
        "collectionCode",
        "otherCatalogNumbers",
    )


# Fields of the per-record comparison struct, in a fixed order.
FEATURE_FIELDS = (
    "gbifId",
    "datasetKey",
    "speciesKey",
    "taxonKey",
    "scientificName",
    "decimalLatitude",
    "decimalLongitude",
    "countryCode",
    "year",
    "month",
    "day",
    "eventDate",
    "ymd",
    "ids",
    "catalogCode",
    "otherCodes",
    "recorders",
    "hasHolotype",
    "hasType",
    "sequenceRepository",
    "ruleSpecimen",
)


def comparison_features(recs: DataFrame) -> DataFrame:
    """One row per record with the derived values the pair rules compare."""
    from pyspark.sql import types as T

    for name in LIST_COLUMNS:
        if name in recs.columns and not isinstance(recs.schema[name].dataType, T.ArrayType):
            recs = recs.withColumn(name, records.list_column(recs, name))
    return identifiers.with_codes(recs).select(*_feature_columns())


@memoized
def _feature_columns() -> list:
    return [
        "gbifId",
        "datasetKey",
        "speciesKey",
        "taxonKey",
        "scientificName",
        "decimalLatitude",
        "decimalLongitude",
        "countryCode",
        "year",
        "month",
        "day",
        "eventDate",
        dates.safe_date("year", "month", "day").alias("ymd"),
        identifiers.prepared_identifier_set().alias("ids"),
        identifiers.prepared_catalog_code().alias("catalogCode"),
        distinct_present(F.col("_catalog_others")).alias("otherCodes"),
        lists.lowered_set("recordedBy").alias("recorders"),
        lists.contains_ignore_case("typeStatus", "HOLOTYPE").alias("hasHolotype"),
        nulls.not_empty("typeStatus").alias("hasType"),
        records.is_sequence_repository("datasetKey").alias("sequenceRepository"),
        false_if_null(F.col("basisOfRecord").isin(*records.RULE_SPECIMEN_BASES)).alias("ruleSpecimen"),
    ]
