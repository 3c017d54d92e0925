"""Reading inputs (IO1, IO3, IO4, IO12)."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``db.table`` or ``catalog.db.table``) or a file path."""
    if "/" in name_or_path or name_or_path.endswith(f".{fmt}"):
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_dir_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """``<data_dir>/<name>.parquet`` (the driver's test tables)."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))


def use_database(spark: SparkSession, database: str) -> None:
    spark.catalog.setCurrentDatabase(database)


def source_fingerprint(df: DataFrame) -> str | None:
    """A digest of the files that ``df`` reads (names, sizes, times) and of its
    columns; ``None`` if it reads no files.  Folders are listed, not files opened."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    if not files:
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path
    digest = hashlib.sha256(df.schema.json().encode())
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        at = path(spark._jvm.java.net.URI(folder))
        for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            name = status.getPath().toUri().toString()
            if not status.isDirectory() and not status.getPath().getName().startswith(("_", ".")):
                digest.update(f"{name} {status.getLen()} {status.getModificationTime()}\n".encode())
    for f in files:
        digest.update(f"{f}\n".encode())
    return digest.hexdigest()
