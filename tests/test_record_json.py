"""Record JSON (JSON text is spliced in unchanged) and columns that cells need."""

import json

import pytest
from pyspark.sql import functions as F

from occulink.functions.records import RECORD_COLUMNS, is_json, record_json
from occulink.operators import export


def test_is_json(spark):
    cases = {
        '[{"a":1}]': True,
        '{"a":1,"a":2}': True,
        "1.50": True,
        "null": True,
        '{"a":1}{': False,
        "[1,2": False,
        "1,2": False,
        '1,"w":2': False,
        "1],[2": False,
        '1},{"a":2': False,
        "": False,
        "words": False,
        None: False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.ok for r in df.select("t", F.coalesce(is_json(F.col("t")), F.lit(False)).alias("ok")).collect()}
    assert got == cases


def test_media_text_stays(spark):
    media = ['[{"a":1,"a":2,"n":1.50}]', '{"a":1}{', None]
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(media)], "gbifId string, media string")
    df = df.select("gbifId", *[F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS if c not in df.columns], "media")
    got = {r.gbifId: r.j for r in df.select("gbifId", record_json().alias("j")).collect()}
    assert got["0"].endswith(',"media":[{"a":1,"a":2,"n":1.50}]}')
    assert got["1"].endswith(',"media":null}') and got["2"].endswith(',"media":null}')
    assert all(list(json.loads(j)) == list(RECORD_COLUMNS) for j in got.values())


def test_missing_relationship_column(spark):
    rel = spark.createDataFrame([("1", "2", "X", "d1", "d2")], "id1 string, id2 string, reasons string, dataset1 string, dataset2 string")
    with pytest.raises(ValueError, match="o1"):
        export.export_cells(rel, 7)
    assert export.export_cells(rel, 7, with_json=False).count() == 5


def test_nested_values_stay_values(spark):
    """Lists and JSON text inside a record are JSON values, not quoted text."""
    df = spark.createDataFrame(
        [("1", ["a", 'b"c', None], [], None, '{"k":{"l":[1,{"m":"n\\"o"}]}}', 1.5)],
        "gbifId string, typeStatus array<string>, recordedBy array<string>, otherCatalogNumbers array<string>, media string, decimalLatitude double",
    )
    rest = [F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS if c not in df.columns]
    record = json.loads(df.select("*", *rest).select(record_json().alias("j")).first().j)
    assert record["typeStatus"] == ["a", 'b"c', None] and record["recordedBy"] == [] and record["otherCatalogNumbers"] is None
    assert record["media"] == {"k": {"l": [1, {"m": 'n"o'}]}} and record["decimalLatitude"] == 1.5
