"""What the linkage's shuffles move."""

import re

from occulink.operators import blocking, cellstore, export
from occulink.plans import queries
from tests.conftest import SF_SMALL

REL = "id1 string, id2 string, reasons string, dataset1 string, dataset2 string, o1 string, o2 string"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_keys_that_are_not_allowed_go_before_the_shuffle(spark):
    rows = [(f"a{i}", "d1", f"ONCE{i}") for i in range(500)]
    rows += [(f"b{i}{j}", f"d{j}", f"TWICE{i}") for i in range(50) for j in range(2)]
    rows += [(f"c{i}", "d3", "MANY") for i in range(40)]
    rows += [("b00", "d0", "TWICE0"), (None, "d0", "TWICE1"), ("n", "d0", None), ("m", "d0", None)]
    h = spark.createDataFrame(rows, "gbifId string, datasetKey string, hash string")
    for bits in (1, 8, 1 << 15):  # few positions: the exact join has to drop what the bitmap lets through
        got = blocking.filter_hashes(h, 5, bits=bits)
        assert got.columns == blocking.filter_hashes(h, 5).columns
        key = lambda r: tuple(str(v) for v in r)
        assert sorted(got.collect(), key=key) == sorted(blocking.filter_hashes(h, 5).collect(), key=key)
    plan = optimized(got)
    top = next(line for line in plan.splitlines() if "Join" in line)
    assert "LeftSemi" not in plan  # it would be pushed below the bitmap, and every row shuffled
    assert re.search(r"Join Inner, \(hash#\d+ = hash#\d+\)", top)


def test_records_are_derived_once_and_not_broadcast(spark):
    for name in ("relationships", "candidate_records", "relationship_json"):
        plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "occulink_records" in plan and "o_orderkey" not in plan, name
        assert not re.search(r"Exchange hashpartitioning\((t._)?gbifId#\d+, \d+\), REPARTITION", plan), name


def test_stored_records_are_the_records(spark):
    got = queries.stored_records(spark, SF_SMALL)
    want = queries.records(spark, SF_SMALL)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_relationships_travel_as_rows_and_become_cells_there(spark):
    rel = spark.createDataFrame([("a", "b", "X", "d1", "d2", "{}", None), ("a", "b", "X", "d1", "d2", "{}", "{}"), (None, "b", "", "d1", "d2", "", "{}")], REL)
    want = [tuple(str(v) for v in r) for r in export.cells(rel, 7).collect()]
    for df in (cellstore.ordered_cells(rel, cellstore.Layout(buckets=7)), export.export_cells(rel, 7)):
        assert sorted(tuple(str(v) for v in r) for r in df.collect()) == sorted(want) and len(want) == 21
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate inline") < plan.index("Exchange")
