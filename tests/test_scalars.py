"""Distance, rounding, dates, list predicates, null logic, salting."""

import pytest
from pyspark.sql import functions as F

from occulink.functions import dates, geo, hashing, lists, nulls
from occulink.operators.export import java_string_hash_py, salt_py


def test_haversine_reference_points(spark):
    df = spark.createDataFrame(
        [(21.8656, -102.909, 21.86558, -102.90929), (21.506, -103.092, 21.50599, -103.09193), (0.0, 0.0, 0.0, 1.0)],
        "a double, b double, c double, d double",
    )
    km = [r[0] for r in df.select(geo.haversine_km("a", "b", "c", "d")).collect()]
    assert km[0] < 0.2 and km[1] < 0.2
    assert km[2] == pytest.approx(111.19, abs=0.01)


def test_round_half_up_matches_java(spark):
    vals = [2.5, -2.5, 0.49999999999999994, -0.5, 1.4999, 44000.0, 55737.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(geo.round_half_up("x")).collect()]
    assert got == [3, -2, 0, 0, 1, 44000, 55737, 0]


@pytest.mark.parametrize(
    "d1,d2,expected",
    [
        ("2004-08-01", "2004-08-02", 1),
        ("2004-08-02", "2004-08-01", -1),
        ("2000-01-15", "2000-02-16", 1),  # one month and one day apart
        ("2000-01-15", "2001-01-15", 0),  # a year apart
        ("2000-01-31", "2000-03-01", 1),  # Jan 31 + 1 month = Feb 29, then one day
        ("2000-03-01", "2000-01-31", -1),
        ("2000-03-10", "2000-02-20", -19),
    ],
)
def test_period_days_quirk(spark, d1, d2, expected):
    df = spark.createDataFrame([(d1, d2)], "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b")
    )
    assert df.select(dates.period_days("a", "b")).collect()[0][0] == expected


def test_safe_date_rejects_impossible(spark):
    df = spark.createDataFrame([(2000, 2, 30), (2000, 2, 29), (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(dates.safe_date("y", "m", "d")).collect()]
    assert got[0] is None and str(got[1]) == "2000-02-29" and got[2] is None


def test_list_predicates(spark):
    df = spark.createDataFrame(
        [(["John", "tim"], ["TIM"], ["HoloType"]), (["ISOHOLOTYPE"], None, ["ISOHOLOTYPE"]), ([None, "a"], ["A"], None)],
        "a array<string>, b array<string>, t array<string>",
    )
    got = df.select(
        lists.intersect_ignore_case("a", "b").alias("i"), lists.contains_ignore_case("t", "HOLOTYPE").alias("h")
    ).collect()
    assert [(r.i, r.h) for r in got] == [(True, True), (False, False), (True, False)]


def test_null_logic(spark):
    df = spark.createDataFrame([(None, None), (None, ""), ("a", "a"), ("a", "b")], "a string, b string")
    got = df.select(
        nulls.all_null("a", "b").alias("n"),
        nulls.equals_and_not_null("a", "b").alias("e"),
        nulls.present_and_not_equals("a", "b").alias("d"),
        nulls.present_on_one_only("a", "b").alias("o"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False, False),
        (False, False, False, True),
        (False, True, False, False),
        (False, False, True, False),
    ]


def test_java_string_hash_and_salt(spark):
    ids = ["hello", "Aa", "BB", "1412", "polygenelubricants", "0", "9", "10", "D8CD16BA-bb74"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = df.select("id", hashing.java_string_hash("id").alias("h"), hashing.salt("id", 100).alias("s")).collect()
    known = {"hello": 99162322, "Aa": 2112, "BB": 2112, "polygenelubricants": -2147483648}
    for r in got:
        assert r.h == java_string_hash_py(r.id)
        assert r.s == salt_py(r.id, 100) and 0 <= r.s < 100
        if r.id in known:
            assert r.h == known[r.id]
