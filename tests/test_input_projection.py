"""Input projection (PF1-PF6, S18): map lookups, the three-valued issue filter."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from occulink.operators.features import input_projection

MAPS = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))
ISSUES = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
VOCAB = T.StructType([T.StructField("concepts", T.ArrayType(T.StringType()))])
SCHEMA = T.StructType(
    [
        T.StructField("gbifId", T.LongType()),
        T.StructField("datasetKey", T.StringType()),
        T.StructField("basisOfRecord", T.StringType()),
        T.StructField("classificationDetails", MAPS),
        T.StructField("taxonomicissue", ISSUES),
        T.StructField("scientificName", T.StringType()),
        T.StructField("typeStatus", VOCAB),
        T.StructField("decimalLatitude", T.DoubleType()),
        T.StructField("decimalLongitude", T.DoubleType()),
        T.StructField("countryCode", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("eventDateGte", T.LongType()),
        T.StructField("recordNumber", T.StringType()),
        T.StructField("fieldNumber", T.StringType()),
        T.StructField("occurrenceID", T.StringType()),
        T.StructField("otherCatalogNumbers", T.ArrayType(T.StringType())),
        T.StructField("institutionCode", T.StringType()),
        T.StructField("collectionCode", T.StringType()),
        T.StructField("catalogNumber", T.StringType()),
        T.StructField("recordedBy", VOCAB),
        T.StructField("ext_multimedia", T.StringType()),
    ]
)


def _row(i, cls, issues):
    return (i, "ds", None, cls, issues, "n", {"concepts": ["Holotype"]}, None, None, None, None, None, None,
            946771200, None, None, None, None, None, None, None, {"concepts": ["Ann"]}, '[{"a":1}]')


def test_filters_and_projection(spark):
    ok = {"cl": {"specieskey": "10", "taxonkey": "11"}}
    rows = [
        _row(1, ok, {"cl": []}),  # kept
        _row(2, ok, {"cl": ["OTHER_ISSUE"]}),  # kept
        _row(3, {"other": {"specieskey": "10"}}, {"cl": []}),  # no checklist entry
        _row(4, {"cl": {"taxonkey": "11"}}, {"cl": []}),  # no species key
        _row(5, ok, {"cl": ["TAXON_MATCH_HIGHERRANK"]}),  # higher-rank match
        _row(6, ok, {"other": []}),  # issue entry missing: NOT array_contains is NULL
        _row(7, ok, {"cl": [None]}),  # NULL element, no match: also NULL
        _row(8, ok, {"cl": [None, "TAXON_MATCH_HIGHERRANK"]}),  # match wins
    ]
    out = input_projection(spark.createDataFrame(rows, SCHEMA), "cl").orderBy("gbifId").collect()
    assert [r.gbifId for r in out] == ["1", "2"]
    r = out[0]
    assert (r.speciesKey, r.taxonKey) == ("10", "11")
    assert r.typeStatus == ["Holotype"] and r.recordedBy == ["Ann"]
    assert r.eventDate == "2000-01-02 00:00:00" and r.media == '[{"a":1}]'
    assert len(out[0].asDict()) == 23


def test_vocabulary_structs_are_unwrapped_end_to_end(spark):
    """Type status and recorders stored as vocabulary structs give the same
    records, and so the same keys, as plain lists."""
    from occulink.operators.blocking import record_hashes
    from occulink.operators.features import input_projection
    from occulink.sources.fixtures import CHECKLIST_KEY, occurrence_source
    from tests.conftest import SF_SMALL

    plain = occurrence_source(spark, SF_SMALL)
    wrapped = plain
    for name in ("typeStatus", "recordedBy"):
        struct = F.struct(F.col(name).alias("concepts"), F.array(F.lit("l")).alias("lineage"))
        wrapped = wrapped.withColumn(name, F.when(F.col(name).isNotNull(), struct))
    one, two = (input_projection(df, CHECKLIST_KEY) for df in (plain, wrapped))
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    assert record_hashes(one, ("type", "recorder")).exceptAll(record_hashes(two, ("type", "recorder"))).count() == 0
