"""Blocking keys (H1-H7), key filter thresholds and candidate pairs."""

from pyspark.sql import functions as F

from occulink.operators import blocking
from tests.records import records_df


def keys_of(spark, families=tuple(blocking.KEY_FAMILIES), **fields):
    df = records_df(spark, dict(fields, gbifId="1"))
    return sorted(r.hash for r in blocking.record_hashes(df, families).collect())


def test_place_date_key_uses_java_rounding(spark):
    got = keys_of(spark, ("place_date",), speciesKey="sp", decimalLatitude=-2.5, decimalLongitude=12.538,
                  year=2004, month=8, day=1)
    assert got == ["SP|-2500|12538|2004|8|1"]
    assert keys_of(spark, ("place_date",), speciesKey="", decimalLatitude=1.0, decimalLongitude=1.0,
                   year=2004, month=8, day=1) == []


def test_species_identifier_keys_keep_separators(spark):
    got = keys_of(spark, ("species_identifier",), speciesKey="7", institutionCode="a", collectionCode="b",
                  catalogNumber="c", occurrenceID="123", recordNumber="s.n.")
    assert got == ["7|123", "7|A:B:C", "7|A:C", "7|C"]


def test_type_and_recorder_keys(spark):
    assert keys_of(spark, ("type",), taxonKey="9", typeStatus=["x"]) == ["9|TYPE"]
    assert keys_of(spark, ("type",), taxonKey="9", typeStatus=[]) == []
    got = keys_of(spark, ("recorder",), taxonKey="9", year=2001, recordedBy=["Ann", None])
    assert got == ["2001|ANN", "2001|NULL"]
    assert keys_of(spark, ("recorder",), taxonKey=None, year=2001, recordedBy=["Ann"]) == []


def test_specimen_keys(spark):
    got = keys_of(spark, ("specimen",), basisOfRecord="PRESERVED_SPECIMEN", speciesKey="7",
                  institutionCode="a", collectionCode="b", catalogNumber="c", fieldNumber="42")
    # species + separator-free codes (numeric allowed), and strict codes alone (no numeric single codes)
    assert got == ["7|42", "7|ABC", "7|AC", "7|C", "ABC", "AC", "C"]
    assert keys_of(spark, ("specimen",), basisOfRecord="HUMAN_OBSERVATION", catalogNumber="c") == []
    assert keys_of(spark, ("specimen",), basisOfRecord="MATERIAL_SAMPLE", catalogNumber="c") == ["C", "NULL|C"]


def test_all_keys_distinct_upper(spark):
    got = keys_of(spark, speciesKey="sp", taxonKey="t", catalogNumber="x1", basisOfRecord="FOSSIL_SPECIMEN")
    assert len(got) == len(set(got)) and all(k == k.upper() for k in got)


def _hash_rows(spark, rows):
    return spark.createDataFrame(rows, "gbifId string, datasetKey string, hash string")


def test_threshold_boundaries_and_methods(spark):
    rows = [("a", "d1", "ONE")]  # 1 record: dropped
    rows += [(f"b{i}", f"d{i}", "TWO") for i in range(2)]  # 2: kept
    rows += [(f"c{i}", f"d{i}", "FULL") for i in range(5)]  # T=5: kept
    rows += [(f"e{i}", f"d{i}", "OVER") for i in range(6)]  # T+1: dropped
    rows += [(f"f{i}", f"d{i}", "HOT") for i in range(40)]  # far over: dropped
    h = _hash_rows(spark, rows)
    expected = {"TWO": 2, "FULL": 5}
    for kwargs in ({"method": "window"}, {"stop_list_size": 0}, {"stop_list_size": 1}, {"stop_list_size": 100}):
        got = {r.hash: r.n for r in blocking.filter_hashes(h, 5, **kwargs).groupBy("hash").agg(F.count("*").alias("n")).collect()}
        assert got == expected, kwargs


def test_candidate_pairs_order_and_dataset(spark):
    h = _hash_rows(spark, [("9", "d1", "K"), ("10", "d2", "K"), ("11", "d2", "K"), ("9", "d1", "L"), ("10", "d2", "L")])
    got = sorted(tuple(r) for r in blocking.candidate_pairs(h).collect())
    # string order: "10" < "11" < "9"; 10/11 share a dataset; the 9-10 pair appears once
    assert got == [("10", "d2", "9", "d1"), ("11", "d2", "9", "d1")]


def test_pairs_sharing_many_keys_come_once_without_an_aggregate(spark):
    import itertools
    import random

    rng = random.Random(4)
    records = {f"r{i:02}": (f"d{i % 3}", rng.sample([f"K{k}" for k in range(30)], rng.randrange(1, 20))) for i in range(40)}
    h = _hash_rows(spark, [(i, d, k) for i, (d, keys) in records.items() for k in keys])
    pairs = blocking.candidate_pairs(h.repartition(5))
    want = sorted((a, da, b, db) for (a, (da, ka)), (b, (db, kb)) in itertools.combinations(sorted(records.items()), 2) if da != db and set(ka) & set(kb))
    assert sorted(tuple(r) for r in pairs.collect()) == want
    plan = blocking.candidate_pairs(h)._jdf.queryExecution().executedPlan().toString()
    above = plan[: min(plan.index(j) for j in ("SortMergeJoin", "HashJoin") if j in plan)]
    assert "Aggregate" not in above and "Exchange" not in above


def test_prefilter_drops_no_repeated_key(spark):
    rows = [(f"a{i}", "d1", f"ONCE{i}") for i in range(2000)]
    rows += [(f"b{i}{j}", "d2", f"TWICE{i}") for i in range(300) for j in range(2)]
    rows += [(f"c{i}", "d3", "MANY") for i in range(50)]
    h = _hash_rows(spark, rows)
    repeated = {r for r in rows if not r[2].startswith("ONCE")}
    for bits in (1, 8, 1 << 10, 1 << 15, blocking.prefilter_bits(len(rows)), 1 << 22):
        kept = [tuple(r) for r in blocking.prefilter_hashes(h, bits).collect()]
        assert len(kept) == len(set(kept)) and repeated <= set(kept) <= set(rows)
    assert len(kept) < len(repeated) + 20
    assert blocking.prefilter_hashes(h, 1).count() == len(rows)  # one position: nothing can go
    for size in (2, 49, 50):
        want = sorted(map(tuple, blocking.filter_hashes(h, size).collect()))
        assert sorted(map(tuple, blocking.filter_hashes(h, size, bits=1 << 15).collect())) == want
    assert blocking.prefilter_hashes(h.limit(0), 1 << 15).count() == 0
    assert blocking.prefilter_bits(0) == 1 << 15 and blocking.prefilter_bits(10**12) == blocking.MAX_PREFILTER_BITS
