"""Scalar identifier rules (S1-S9, S15) on literal values."""

from pyspark.sql import functions as F

from occulink.functions import identifiers as I


def _eval(spark, rows, schema, exprs):
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[e.alias(n) for n, e in exprs.items()]).collect()


def test_normalize_id(spark):
    rows = [(" A-/, B \\C",), ("David S. Seigler|J.T. Miller",), ("D. S. Seigler & J. T. Miller",), ("*",), (None,)]
    out = _eval(spark, rows, "s string", {"n": I.normalize_id("s")})
    assert [r["n"] for r in out] == ["ABC", "DAVIDSSEIGLERJTMILLER", "DSSEIGLERJTMILLER", None, None]


def test_omit_list_normalised():
    assert "SN" in I.OMITTED_IDENTIFIERS and "UNKNOWNSN" in I.OMITTED_IDENTIFIERS
    assert "[]" in I.OMITTED_IDENTIFIERS and "SNº" in I.OMITTED_IDENTIFIERS
    assert "" not in I.OMITTED_IDENTIFIERS and len(I.OMITTED_IDENTIFIERS) == 26


def test_eligibility_and_hash_or_null(spark):
    rows = [("SN",), ("s.n.",), ("",), ("[]",), ("--",), ("AB12",), ("123",), ("1e5",), ("0x1p3",), (None,)]
    out = _eval(
        spark,
        rows,
        "s string",
        {
            "e": I.is_eligible("s"),
            "any": I.hash_or_null("s", True),
            "strict": I.hash_or_null("s", False),
        },
    )
    got = {r["s"]: (r["e"], r["any"], r["strict"]) for r in out}
    assert got["SN"] == (False, None, None)
    assert got["s.n."] == (False, None, None)
    assert got[""] == (False, None, None)
    assert got["[]"] == (False, None, None)
    assert got["--"] == (False, None, None)
    assert got["AB12"] == (True, "AB12", "AB12")
    assert got["123"] == (True, "123", None)
    assert got["1e5"] == (True, "1E5", None)
    assert got["0x1p3"] == (True, "0X1P3", None)
    assert got[None] == (False, None, None)


def test_java_numeric_grammar(spark):
    numeric = ["12", " 12 ", "-1.5", "+.5e-3", "1.", "12D", "12f", "1E5", "0x1p3", "0X1.8P1", "NaN", "-Infinity", "\t7\n"]
    not_numeric = ["", ".", "1e", "abc", "1_000", "NaNd", "Infinityf", "0x1", "nan", "inf", "1,5", "--1"]
    rows = [(s,) for s in numeric + not_numeric]
    out = {r["s"]: r["n"] for r in _eval(spark, rows, "s string", {"n": I.is_numeric("s")})}
    assert all(out[s] for s in numeric), {s: out[s] for s in numeric}
    assert not any(out[s] for s in not_numeric), {s: out[s] for s in not_numeric}


def test_concat_if_eligible(spark):
    rows = [("good Id", "SN"), ("good Id", "tim"), ("N", "A")]
    out = _eval(spark, rows, "a string, b string", {"c": I.concat_if_eligible(":", "a", "b")})
    assert [r["c"] for r in out] == [None, "GOODID:TIM", "N:A"]


def test_catalog_number_overlaps(spark):
    cases = [
        ("A", "B", "123", "A:B:123", True),
        ("A", "B", "123", "A-B-123", True),
        ("A", "B", "123", "A/B/123", True),
        ("A", "B", "123", "AB123", True),
        ("A", "B", "123", "A:123", False),
        ("A", "B", "123", "A-123", False),
        ("A", "B", "123", "A/123", False),
        ("A", "B", "123", "A:B:A123", False),
        ("A", "B", "123", "123", False),
        (None, None, "AB123", "AB123", False),
        ("", "NO DISPONSIBL", "AB123", "AB123", False),
        ("", "NO DISPONSIBL", "123", "123", False),
        ("C", "AT", "2323", "Cat. 2323", False),
        ("C", "AT", "2323", "Cat# 2323", False),
        ("C", "AT", "2323", "cat# 2323", False),
        ("C", "AT", "2323", "cat 2323", True),
    ]
    rows = [(ic, cc, cn, [t, "x"], exp) for ic, cc, cn, t, exp in cases]
    overlap = F.coalesce(
        F.array_contains(I.other_catalog_codes("target"), I.catalog_code("ic", "cc", "cn")), F.lit(False)
    )
    out = _eval(spark, rows, "ic string, cc string, cn string, target array<string>, exp boolean", {"o": overlap})
    for r in out:
        assert r["o"] == r["exp"], r


def test_list_identifiers_and_sets(spark):
    rows = [("o1", None, "r1", "C1", "I", "HERB", ["Cat. 9", None])]
    schema = "occ string, fn string, rn string, cn string, ic string, cc string, ocn array<string>"
    ids = I.list_identifiers("occ", "fn", "rn", "cn", "ic", "cc", "ocn")
    out = _eval(spark, rows, schema, {"ids": ids, "norm": F.array_sort(I.normalized_identifier_set(ids))})[0]
    assert out["ids"] == ["o1", "r1", "C1", "I:HERB:C1", "I:C1", "Cat. 9"]
    assert out["norm"] == sorted(["O1", "R1", "C1", "IHERBC1", "IC1", "CAT9"])


def test_identifier_overlap_cases(spark):
    from tests.records import judge_pair

    yes = [("A1234", "A1234"), ("A1234", "A::_-*1234")]
    no = [("A1234", "AA:1234"), (None, "A1234"), ("*", "A1234"), ("s.n.", "A1234"), ("s.n.", "S/N")]
    for a, b in yes + no:
        row = judge_pair(spark, {"occurrenceID": a}, {"occurrenceID": b})
        assert row["IDENTIFIERS_OVERLAP"] == ((a, b) in yes), (a, b)
