"""Writing outputs (IO2, IO5, IO6, IO7, IO9, IO11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Stage tables of one linkage run, by suffix.
STAGE_SUFFIXES = ("input", "hashes", "hashes_filtered", "candidates", "relationships")


def write_table(df: DataFrame, name: str, fmt: str = "parquet", compression: str = "snappy") -> None:
    """Overwrite a managed table (snappy parquet by default)."""
    df.write.format(fmt).option("compression", compression).mode("overwrite").saveAsTable(name)


def write_text(df: DataFrame, path: str, compression: str = "none") -> None:
    """One string column as plain text files, uncompressed by default."""
    df.write.mode("overwrite").option("compression", compression).text(path)


def write_bucketed_table(df: DataFrame, name: str, buckets: int, key: str) -> None:
    """Overwrite a managed table of ``buckets`` buckets by ``key``, sorted in each."""
    df.write.format("parquet").option("compression", "snappy").bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def stage_table(prefix: str, suffix: str) -> str:
    """Name of a stage table; the prefix may name a database (``db.prefix``)."""
    return f"{prefix}_{suffix}"


def drop_stage_tables(spark: SparkSession, prefix: str, suffixes: tuple[str, ...] = STAGE_SUFFIXES) -> None:
    """Remove the stage tables of a previous run with this prefix."""
    for suffix in suffixes:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(stage_table(prefix, suffix))} PURGE")


def set_table_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('{key}' = '{value}')")


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property of a table; ``None`` without the property or the table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()
    return next((r["value"] for r in rows if r["key"] == key), None)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a served table's content as a whole (IO9).

    An existing table keeps its definition and is overwritten in place, columns
    matched by name (another set of names is an error); otherwise it is created.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if sorted(columns) != sorted(df.columns):
            raise ValueError(f"columns {df.columns} do not match those of {name}: {columns}")
        df.select(*columns).write.insertInto(name, overwrite=True)
    else:
        df.write.format("parquet").mode("overwrite").saveAsTable(name)
