"""Rows that travel as text: packed columns, records as values, pairs, and cells that stay."""

import math

from pyspark.sql import functions as F

from occulink.functions.packing import pack, unpack
from occulink.functions.records import record_json, record_values, with_record_texts
from occulink.operators import blocking, cellstore, export, relate
from occulink.operators.features import partition_by_record
from occulink.plans import queries
from tests.conftest import SF_SMALL
from tests.records import records_df

REL = "id1 string, id2 string, reasons string, dataset1 string, dataset2 string, o1 string, o2 string"
ODD_TEXTS = ["", "plain", "a\x1fb", "\x1e", "\x02", "\x03", "null", '"q"', "é𝄞", " ", "\\", "a,b", '","datasetKey":"x', ',"year":1', "\x1f\x1f"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shown(df):
    return sorted(repr(r) for r in df.collect())


def test_packed_columns_come_back_exactly(spark):
    schema = "k int, s string, l array<string>, d double, i int, b boolean, t date, n bigint, m map<string,string>"
    lists = [None, [], [""], [None], ["a", None], ["a", "b\x1e"], ["", ""], ["\x02"], ["\x03"], ["x", "y"]]
    numbers = [None, 0.0, -0.0, 1e-300, 0.1 + 0.2, math.inf, -math.inf, math.nan, 12345678.9]
    rows = [(k, (ODD_TEXTS + [None])[k % 16], lists[k % 10], numbers[k % 9], [None, -1, 2**31 - 1][k % 3], [None, True, False][k % 3], None, -(2**63) + k, {"a": "b"}) for k in range(720)]
    df = spark.createDataFrame(rows, schema).withColumn("t", F.when(F.col("k") % 3 > 0, F.date_from_unix_date(F.col("k") * 9000 - 2_000_000)))
    df = df.union(df.limit(1).withColumn("s", F.expr("cast(X'61FF62' as string)")))
    names = [c for c in df.columns if c != "k"]
    packed = pack(df, names)
    assert packed.columns == ["k", "m", "_packed", "_packed_odd"]
    back = unpack(packed.repartition(3, "k"), df.schema, names, "r").select(*[c if c in "km" else F.col("r")[c].alias(c) for c in df.columns])
    assert back.schema.simpleString() == df.schema.simpleString()
    seen = lambda d: shown(d.withColumn("s", F.hex(F.col("s").cast("binary"))).withColumn("d", F.col("d").cast("string")).withColumn("t", F.col("t").cast("string")))
    assert seen(back) == seen(df)
    plain = packed.where("_packed IS NOT NULL")
    assert 0 < plain.count() < df.count() and plain.where("_packed_odd IS NOT NULL").count() == 0


def odd_records(spark):
    media = [None, "", "{}", '[{"id":1,"datasetKey":2,"year":3}]', "no json", '"\x1f"', '{"a":1,"media":[1.50, 1e2]}', " [1] "]
    return records_df(spark, *[dict(gbifId=t, datasetKey=t, scientificName=t, countryCode=t, typeStatus=[t, None, "datasetKey"], recordedBy=[] if i % 2 else [t, t], year=i if i % 3 else None, decimalLatitude=-0.0 if i % 2 else 1.5, media=media[i % 8]) for i, t in enumerate(ODD_TEXTS)], dict())


def test_records_moved_as_values_become_the_same_json(spark):
    recs = odd_records(spark)
    got = with_record_texts(recs.select("gbifId", record_values().alias("o1"), record_json().alias("o2")), ("o1", "o2"))
    assert got.columns == ["gbifId", "o1", "o2"] and got.count() == 16
    assert got.where("NOT o1 <=> o2").count() == 0 and got.where("o1 IS NULL").count() == 0
    assert shown(partition_by_record(recs, 4, packed=True)) == shown(recs)


def test_cells_of_values_are_the_cells_of_the_json(spark):
    recs = odd_records(spark)
    rel = recs.select(F.col("gbifId").alias("id1"), F.lit("z").alias("id2"), F.lit("X").alias("reasons"), F.col("datasetKey").alias("dataset1"), F.lit("d").alias("dataset2"), record_values().alias("o1"), record_values().alias("o2"))
    texts = with_record_texts(rel, ("o1", "o2"))
    assert cellstore.range_tasks(rel, True, 100) == cellstore.range_tasks(texts, True, 100)
    for make in (lambda r: export.export_cells(r, 7), lambda r: cellstore.ordered_cells(r, cellstore.Layout(buckets=7))):
        assert shown(make(rel)) == shown(make(texts))
    both = relate.both_directions(rel)
    assert shown(with_record_texts(both, ("o1", "o2"))) == shown(relate.both_directions(texts))


def test_pairs_are_the_same_by_either_method(spark):
    rows = [(f"r{i % 23}", f"d{i % 4}", f"K{i * i % 31}") for i in range(400)]
    rows += [("r1", "d9", "K1"), (None, "d0", "K1"), ("n", None, "K1"), ("m", "d0", None), ("m", "d0", None)]
    h = spark.createDataFrame(rows + rows[:50], "gbifId string, datasetKey string, hash string")
    got = shown(blocking.candidate_pairs(h, "distinct"))
    assert got == shown(blocking.candidate_pairs(h)) and len(got) == len(set(got)) > 100


def test_pairs_and_features_travel_as_little_text(spark):
    for name in ("relationships", "candidate_records", "decision"):
        plan = optimized(queries.QUERIES[name](spark, SF_SMALL))
        assert "collect_set" not in plan and "RepartitionByExpression [id1" in plan, name  # no lists of keys travel
        assert name == "candidate_records" or "_packed" in plan, name


def test_looked_up_cells_stay_but_for_positions_of_both_kinds(spark):
    pairs = [("a", "b:d"), ("a:b", "d"), ("a", "c"), ("b", "a"), ("", "q"), (None, "x"), ("c", None), ("a", "c")] + [(f"i{n}", f"j{n % 3}") for n in range(200)]
    rel = spark.createDataFrame([(a, b, "X", "d1", None, "{}", "{}") for a, b in pairs], REL)
    cells = export.cells(rel, 1)
    ids = spark.createDataFrame([("a",), ("a",), ("",), (None,), ("nope",)] + [(f"i{n}",) for n in range(0, 200, 3)], "id string")
    for wanted in (ids, ids.limit(0), ids.where("id = 'a'")):
        want = shown(export.related_records(cells, wanted, 1))
        for bits in (1, 8, 256, 1 << 15, 1 << 20):
            got = export.related_records(cells, wanted, 1, bits)
            assert got.columns == cells.columns and shown(got) == want, bits
    assert "LeftSemi" not in optimized(got)  # it would be pushed below the bitmaps, and every cell shuffled
