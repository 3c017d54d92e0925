"""SQL functions give what the Column builders give, without a call in the plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from occulink.functions import identifiers, sequences, sql
from occulink.functions.geo import haversine_km


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    sql.register(spark)


def test_identifier_functions_agree_with_the_builders(spark):
    raw = [None, "", " ", "a-b c", "s.n.", "S/Nº", "it's", "1e5", " 12.5f", "0x1p3", "NaN", "x", "[]", "a\\b", "unknown s.n.", "ß|1", "12 13"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    df.createOrReplaceTempView("raw_ids")
    got = spark.sql("SELECT raw, normalize_identifier(raw) n, is_eligible_identifier(raw) e, is_numeric_identifier(raw) d FROM raw_ids")
    want = df.select("raw", identifiers.normalize_id("raw").alias("n"), identifiers.is_eligible("raw").alias("e"), identifiers.is_numeric("raw").alias("d"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "normalize_identifier" not in plan and "translate" in plan


def test_distance_and_sequence_agree_with_the_builders(spark):
    points = [(0.0, 0.0, 0.0, 0.0), (55.7, 12.5, 55.70009, 12.5001), (-90.0, 0.0, 90.0, 180.0), (None, 1.0, 2.0, 3.0), (10.0, 179.9, 10.0, -179.9)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    got = df.select(F.expr("great_circle_km(a, b, c, d)").alias("x"), haversine_km("a", "b", "c", "d").alias("y")).collect()
    assert all(r.x == r.y for r in got)
    texts = spark.createDataFrame([(t,) for t in (None, "", "acgtx", "straße", "zzz", "n n")], "t string")
    rows = texts.select(F.expr("normalize_sequence(t)").alias("x"), sequences.normalize_sequence("t").alias("y")).collect()
    assert all(r.x == r.y for r in rows) and {r.x for r in rows} == {None, "ACGT", "STRASS", "", "NN"}


def test_registering_twice_is_fine(spark):
    sql.register(spark)
    assert spark.sql("SELECT normalize_identifier('a.b') AS x").first().x == "AB"
