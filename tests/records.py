"""Literal occurrence records for tests (all fields nullable, unset = NULL)."""

from pyspark.sql import types as T

from occulink.functions.records import RECORD_COLUMNS

S = T.StringType()
ARR = T.ArrayType(T.StringType())
TYPES = {
    "typeStatus": ARR,
    "otherCatalogNumbers": ARR,
    "recordedBy": ARR,
    "decimalLatitude": T.DoubleType(),
    "decimalLongitude": T.DoubleType(),
    "year": T.IntegerType(),
    "month": T.IntegerType(),
    "day": T.IntegerType(),
}
SCHEMA = T.StructType([T.StructField(c, TYPES.get(c, S), True) for c in RECORD_COLUMNS])


def record(**fields):
    unknown = set(fields) - set(RECORD_COLUMNS)
    assert not unknown, unknown
    fields.setdefault("datasetKey", f"ds-{fields.get('gbifId')}")
    return tuple(fields.get(c) for c in RECORD_COLUMNS)


def records_df(spark, *recs):
    return spark.createDataFrame([record(**r) for r in recs], SCHEMA)


def judge_pair(spark, o1, o2, strict_days=False):
    """Run two records through features -> pair -> facts/decision; returns the row."""
    from pyspark.sql import functions as F

    from occulink.operators.features import comparison_features
    from occulink.operators.relate import attach_records, judge

    o1 = dict(o1, gbifId=o1.get("gbifId", "1"))
    o2 = dict(o2, gbifId=o2.get("gbifId", "2"))
    recs = records_df(spark, o1, o2)
    pairs = spark.createDataFrame(
        [(o1["gbifId"], o1.get("datasetKey", "ds-" + o1["gbifId"]), o2["gbifId"], o2.get("datasetKey", "ds-" + o2["gbifId"]))],
        "id1 string, ds1 string, id2 string, ds2 string",
    )
    row = judge(attach_records(pairs, comparison_features(recs)), strict_days).drop("o1", "o2").collect()
    assert len(row) == 1
    return row[0]
