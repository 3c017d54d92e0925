"""Sinks, infinite coordinates and salts of uncommon characters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from occulink.functions.geo import round_half_up
from occulink.functions.hashing import java_string_hash, salt
from occulink.operators.export import java_string_hash_py, salt_py
from occulink.operators.fasta import fasta
from occulink.sources.sinks import drop_stage_tables, replace_table


def test_infinite_values_round_to_the_ends(spark):
    rows = [(float("inf"),), (float("-inf"),), (float("nan"),), (2.5,), (-2.5,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x double").select(round_half_up("x")).collect()]
    assert got == [(1 << 63) - 1, -(1 << 63), 0, 3, -2]


def test_salt_twins_agree(spark):
    ids = ["a", "é", "id-\U0001f600-7", "", "x" * 50]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert {r.id: r.s for r in df.select("id", salt("id", 100).alias("s")).collect()} == {i: salt_py(i, 100) for i in ids}


def test_hash_folds_utf16_units(spark):
    # values of String.hashCode: 0xD83D * 31 + 0xDE00, and so on
    known = {"\U0001f600": 1772899, "a\U0001f600": 97 * 961 + 1772899, "\U0001f600z": 1772899 * 31 + 122, "\U00010000": 0xD800 * 31 + 0xDC00, "\U0010ffff": 0xDBFF * 31 + 0xDFFF, "\uffff": 0xFFFF, "": 0, "polygenelubricants": -(1 << 31)}
    df = spark.createDataFrame([(k,) for k in known], "id string")
    assert {r.id: r.h for r in df.select("id", java_string_hash("id").alias("h")).collect()} == known
    assert {k: java_string_hash_py(k) for k in known} == known


def test_stage_tables_of_a_database_go(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stage_db")
    spark.range(3).write.mode("overwrite").saveAsTable("stage_db.p_input")
    drop_stage_tables(spark, "stage_db.p")
    assert not spark.catalog.tableExists("stage_db.p_input")
    spark.sql("DROP DATABASE stage_db CASCADE")


def test_replace_matches_columns_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS replaced")
    replace_table(spark.createDataFrame([(1, 2)], "x int, y int"), "replaced")
    replace_table(spark.createDataFrame([(4, 3)], "y int, x int"), "replaced")
    assert [tuple(r) for r in spark.table("replaced").select("x", "y").collect()] == [(3, 4)]
    with pytest.raises(ValueError):
        replace_table(spark.createDataFrame([(4, 3)], "y int, z int"), "replaced")
    spark.sql("DROP TABLE replaced")


def test_fasta_partitions_do_not_change_the_result(spark):
    df = spark.createDataFrame([("acgt",), ("ACGT",), (None,), ("tt",)], "dnasequence string")
    assert sorted(r.f for r in fasta(df).collect()) == sorted(r.f for r in fasta(df, partitions=3).collect())
    assert fasta(df).agg(F.count("f")).first()[0] == 2
