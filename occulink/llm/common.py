"""Helpers shared by the operators of this subpackage.

Staged tables: an intermediate result that is read more than once, or whose
loss would force a long recomputation, is written as Parquet below the folder
the session names in ``spark.checkpoint.dir`` and read back.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which ``lookup_join`` broadcasts, and its salts beyond that.
LOOKUP_ROWS, SALTS = 100_000, 64


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only on a
    ``local[...]`` master that names none (tests)."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if conf:
        return conf.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    conf = "file://" + tempfile.mkdtemp(prefix="occulink-llm-")
    spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/occulink-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, name: str, key: str, deal: bool = False) -> DataFrame:
    """As ``stage``, in buckets by ``key``, one for each shuffle partition: joins and
    groups by the key do not move these rows.  (Files know no buckets, tables do;
    the table's name is given up at once, its files stay.)  ``deal``: rows are
    dealt by the key first, so that a task with many keys writes one file."""
    spark = df.sparkSession
    table = f"occulink_llm_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/occulink-llm/{table}"
    dealt = df.repartition(buckets, key) if deal else df
    dealt.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, also
    when that place is not their working folder.  (A cluster without it there
    gets the package by ``--py-files``.)"""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup_join(df: DataFrame, side: DataFrame, on: list[str], spread: Column) -> DataFrame:
    """Join staged ``side``, which has one row a key, to each row of ``df``.

    The side is broadcast if it has at most ``LOOKUP_ROWS`` rows.  Otherwise it is
    repeated under every salt and ``df``'s rows take a salt from ``spread``, so
    that a key with many rows is dealt to ``SALTS`` tasks.
    """
    if side.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS:
        return df.join(F.broadcast(side), on)
    salted = side.withColumn("lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("lookup_salt", F.pmod(spread, F.lit(SALTS)).cast("int")).join(salted, [*on, "lookup_salt"]).drop("lookup_salt")


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)
