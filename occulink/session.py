"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: UTC renders epoch dates the same
# everywhere, AQE coalesces shuffle partitions and splits skewed ones.
# Constraint propagation is off: the per-record rules are large expression
# trees, and inferring constraints over their aliases grows super-linearly
# (tens of seconds of optimiser time per plan); no plan here needs the
# inferred filters.
# Code of over 8,000 bytes a method is never compiled by the JVM but interpreted:
# operators that would need it run expression by expression instead.
JOB_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "occulink", extra_conf: dict | None = None
) -> SparkSession:
    """A local session for tests and the bench (UI off, quiet logs)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("OCCULINK_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**JOB_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; a scratch folder only
    when the session names none (local tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder to checkpoint on a cluster")
        configured = tempfile.mkdtemp(prefix="occulink-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/occulink-{name}-{uuid.uuid4().hex}"


def store_by_key(df: DataFrame, key: str) -> DataFrame:
    """Files of ``df`` in the shared folder, in buckets by ``key``, one for each
    shuffle partition and sorted by it: joins by the key do not move these rows.
    ``df`` is dealt by the key already.  (Only tables know buckets; the table's
    name is given up at once, its files stay.)"""
    spark = df.sparkSession
    path = scratch_path(spark, "records")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


def cut_lineage(df: DataFrame, how: str | None, table: str | None = None) -> DataFrame:
    """Materialise a stage so a lost executor does not recompute the plan.

    ``how``: ``None`` (keep lazy), ``"checkpoint"`` (reliable checkpoint in
    ``spark.checkpoint.dir``), ``"parquet"`` (files in that folder, whose later
    reads prune columns) or ``"table"`` (overwrite parquet table ``table`` and
    read it back).
    """
    if how is None:
        return df
    if how == "parquet":
        path = scratch_path(df.sparkSession, "stage")
        df.write.option("compression", "zstd").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "table":
        if not table:
            raise ValueError("table name required")
        df.write.format("parquet").mode("overwrite").saveAsTable(table)
        return df.sparkSession.table(table)
    raise ValueError(f"unknown lineage cut {how!r}")
