"""A run goes on from its stage tables; pairs meet bucketed records in place."""

from __future__ import annotations

import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from occulink.operators import blocking, relate
from occulink.plans import linkage
from occulink.plans.linkage import LinkageConfig, finished_stages, run_linkage
from occulink.sources import sinks
from occulink.sources.fixtures import CHECKLIST_KEY, occurrence_source
from occulink.sources.tables import source_fingerprint
from tests.conftest import SF_SMALL

CFG = LinkageConfig(checklist_key=CHECKLIST_KEY, with_json=False, lineage="table", prefix="t_resume", resume=True, partitions=8)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def source(spark):
    path = tempfile.mkdtemp(prefix="occulink-src-") + "/occurrence"
    occurrence_source(spark, SF_SMALL).write.parquet(path)
    yield spark.read.parquet(path)
    sinks.drop_stage_tables(spark, CFG.prefix)


@pytest.fixture
def built(monkeypatch):
    """Names of the stages that are computed."""
    names = []
    for module, name in ((blocking, "record_hashes"), (blocking, "filter_hashes"), (blocking, "candidate_pairs"), (relate, "relationships")):
        monkeypatch.setattr(module, name, lambda *a, _f=getattr(module, name), _n=name, **k: names.append(_n) or _f(*a, **k))
    return names


def test_rerun_goes_on_after_the_last_finished_stage(spark, source, built, monkeypatch):
    expected = rows(run_linkage(source, replace(CFG, lineage=None, resume=False)).relationships)
    built.clear()
    sinks.drop_stage_tables(spark, CFG.prefix)
    with monkeypatch.context() as m:
        broken = lambda *a, **k: spark.range(1).select(F.raise_error(F.lit("killed")).cast("string").alias("id1"))
        m.setattr(relate, "relationships", broken)
        with pytest.raises(Exception, match="killed"):
            run_linkage(source, CFG)
    assert list(finished_stages(spark, CFG.prefix)) == ["input", "hashes", "hashes_filtered", "candidates"]
    built.clear()
    assert rows(run_linkage(source, CFG).relationships) == expected
    assert built == ["relationships"]
    built.clear()
    assert rows(run_linkage(source, CFG).relationships) == expected and built == []

    run_linkage(source, replace(CFG, strict_days=True))
    assert built == ["relationships"]
    built.clear()
    run_linkage(source, replace(CFG, max_group_size=7))
    assert built == ["filter_hashes", "candidate_pairs", "relationships"]
    built.clear()
    smaller = source.where("gbifId < '3'")  # same files: told apart by the name given
    run_linkage(smaller, replace(CFG, max_group_size=7, source_id="smaller"))
    assert built == ["record_hashes", "filter_hashes", "candidate_pairs", "relationships"]


def test_half_written_and_foreign_stages_are_not_taken(spark, source, built):
    sinks.drop_stage_tables(spark, CFG.prefix)
    spark.range(3).write.saveAsTable("t_resume_hashes")  # without a mark
    assert finished_stages(spark, CFG.prefix) == {}
    run_linkage(source, CFG)
    assert len(built) == 4
    built.clear()
    spark.sql("DROP TABLE t_resume_candidates PURGE")
    run_linkage(source, CFG)
    assert built == ["candidate_pairs", "relationships"]
    built.clear()
    run_linkage(source, replace(CFG, resume=False))
    assert len(built) == 4


def test_source_fingerprint_follows_the_files(spark, source):
    mark = source_fingerprint(source)
    assert mark and mark == source_fingerprint(spark.read.parquet(source.inputFiles()[0].rsplit("/", 1)[0]))
    path = tempfile.mkdtemp(prefix="occulink-src-") + "/t"
    spark.range(5).write.parquet(path)
    one = source_fingerprint(spark.read.parquet(path))
    spark.range(5).write.mode("overwrite").parquet(path)
    assert one != source_fingerprint(spark.read.parquet(path))
    assert source_fingerprint(spark.createDataFrame([(1,)], "x int")) is None


def below_exchanges(plan):
    """Plan text of what lies below each exchange."""
    out = []

    def walk(node):
        if "Exchange" in node.nodeName():
            out.append(node.toString())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan.initialPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan)
    return out


def test_joins_do_not_move_the_records(spark, source):
    cfg = replace(CFG, with_json=True)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        res = run_linkage(source, cfg)
        assert "Bucket" in spark.sql("DESCRIBE EXTENDED t_resume_input").toPandas().to_string()
        rel = relate.relationships(res.records, res.pairs)
        plan = rel._jdf.queryExecution().executedPlan()
        moved = below_exchanges(plan)
        assert moved and all("t_resume_candidates" in text for text in moved)  # only pairs, with what has joined them
        assert plan.toString().count("t_resume_input") >= 4  # both records, both JSON texts
        assert rows(rel) == rows(res.relationships) and len(rows(rel)) == 2 * 868
        assert linkage.STAGE_SETTINGS.keys() == set(sinks.STAGE_SUFFIXES)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
