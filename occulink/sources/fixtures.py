"""Occurrence and sequence inputs derived from the driver's TPC-H-like tables.

One occurrence per order (``o_orderkey`` is unique), enriched from its
customer.  The derivation rules are fixed so that a DuckDB oracle can build
the same rows (see ``occulink.plans.oracle``).  Write ``k`` for the order key,
``c`` for the customer key, ``n`` for the customer nation and ``D`` for the
day of month of the order date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occulink.functions.common import memoized
from occulink.sources.tables import read_dir_table

# fixed values of the fixture
CHECKLIST_KEY = "cl"
REPOSITORY_DATASET = "D8CD16BA-BB74-4420-821E-083F2BAC17C2"


def _s(c: Column) -> Column:
    return c.cast("string")


def occurrence_source(spark: SparkSession, data_dir: str) -> DataFrame:
    """The wide occurrence table: map-typed taxonomy, epoch event dates,
    media JSON text."""
    orders = read_dir_table(spark, data_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customer = read_dir_table(spark, data_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    j = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])

    return j.select(*_occurrence_columns())


@memoized
def _occurrence_columns() -> list[Column]:
    """Column expressions of the occurrence view (built once per session)."""
    k, c, n = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    day_of_month = F.dayofmonth("o_orderdate")
    status = F.col("o_orderstatus")
    taxon = F.create_map(F.lit("specieskey"), _s(c), F.lit("taxonkey"), _s(c))
    no_date = k % 7 == 0
    month = (1 + day_of_month % 2).cast("int")
    day = (1 + day_of_month % 5).cast("int")
    event_date = (
        F.when(k % 14 == 0, F.lit("2000-01-02"))
        .when(no_date | (k % 6 == 1), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("2000-0"), _s(month), F.lit("-0"), _s(day)))
    )
    empty = F.array().cast("array<string>")
    return [
        _s(k).alias("gbifId"),
        F.when(k % 4 == 3, F.lit(REPOSITORY_DATASET))
        .otherwise(F.concat(F.lit("ds-"), _s(k % 4)))
        .alias("datasetKey"),
        F.when(status == "P", "PRESERVED_SPECIMEN")
        .when(status == "F", "MATERIAL_SAMPLE")
        .when(status == "O", "HUMAN_OBSERVATION")
        .alias("basisOfRecord"),
        F.when(k % 19 == 0, F.create_map(F.lit("other"), taxon))
        .otherwise(F.create_map(F.lit(CHECKLIST_KEY), taxon))
        .alias("classificationDetails"),
        F.when(k % 23 == 0, F.create_map(F.lit(CHECKLIST_KEY), F.array(F.lit("TAXON_MATCH_HIGHERRANK"))))
        .when(k % 29 == 0, F.create_map(F.lit("other"), empty))
        .otherwise(F.create_map(F.lit(CHECKLIST_KEY), empty))
        .alias("taxonomicissue"),
        F.col("c_name").alias("scientificName"),
        F.when(k % 20 == 0, F.array(F.lit("Holotype")))
        .when(k % 20 == 1, F.array(F.lit("ISOTYPE"), F.lit("holotype")))
        .when(k % 20 == 2, F.array(F.lit("Paratype")))
        .when(k % 20 == 3, empty)
        .alias("typeStatus"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
        .otherwise(n.cast("double") * 3.0 + (k % 5).cast("double") * 0.0007)
        .alias("decimalLatitude"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
        .otherwise(n.cast("double") * 5.0 + (k % 3).cast("double") * 0.006)
        .alias("decimalLongitude"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 17 == 0, F.lit("ZZ"))
        .otherwise(F.concat(F.lit("N"), _s(n)))
        .alias("countryCode"),
        F.when(~no_date, F.lit(2000)).alias("year"),
        F.when(~no_date, month).alias("month"),
        F.when(~no_date, day).alias("day"),
        (F.unix_date(F.to_date(event_date)).cast("bigint") * 86400).alias("eventDateGte"),
        F.when(k % 9 == 0, F.lit("s.n."))
        .otherwise(F.concat(F.lit("RN "), _s(k % 6), F.lit("/"), status))
        .alias("recordNumber"),
        F.when(k % 8 == 0, _s(k % 16)).alias("fieldNumber"),
        F.concat(F.lit("urn:x:"), _s(k)).alias("occurrenceID"),
        F.when(
            k % 3 == 0,
            F.array(
                F.concat(F.lit("Cat. "), _s(k % 50)),
                F.concat(F.lit("I"), _s(c % 5), F.lit("/HERB/C-"), _s(c % 40)),
            ),
        ).alias("otherCatalogNumbers"),
        F.concat(F.lit("I"), _s(c % 5)).alias("institutionCode"),
        F.when(k % 2 == 0, F.lit("HERB")).otherwise(F.lit("unknown")).alias("collectionCode"),
        F.concat(
            F.lit("C "), _s(c % 40), F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("-"), _s(k % 9)))
        ).alias("catalogNumber"),
        F.when(k % 5 != 0, F.array(F.col("c_name"), F.col("o_orderpriority"))).alias("recordedBy"),
        F.concat(F.lit('[{"id":'), _s(k), F.lit("}]")).alias("ext_multimedia"),
    ]




def sequence_source(spark: SparkSession, data_dir: str) -> DataFrame:
    """``documents.text`` standing in for a DNA sequence column."""
    return read_dir_table(spark, data_dir, "documents").select(F.col("text").alias("dnasequence"))
