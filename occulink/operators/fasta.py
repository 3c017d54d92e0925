"""Distinct nucleotide sequences as FASTA text (PF10, S19, A2, S20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occulink.functions.sequences import fasta_record, normalize_sequence


def distinct_sequences(df: DataFrame, column: str = "dnasequence", partitions: int | None = None) -> DataFrame:
    """Normalised, distinct, non-empty input sequences (column ``seq``).

    The distinct is a partial + final hash aggregate: duplicates of a very
    common sequence collapse map-side before the shuffle.  ``partitions`` deals
    the raw rows out first, for inputs of few large splits.
    """
    c = F.col(column)
    if partitions:
        df = df.repartition(partitions)
    return (
        df.where(c.isNotNull() & (F.length(c) > 0))
        .select(normalize_sequence(c).alias("seq"))
        .distinct()
    )


def fasta(df: DataFrame, column: str = "dnasequence", partitions: int | None = None) -> DataFrame:
    """One string column ``f`` = ``>md5\\nsequence`` per distinct sequence."""
    return distinct_sequences(df, column, partitions).select(fasta_record("seq").alias("f"))


def write_fasta(fasta_df: DataFrame, path: str) -> None:
    """Uncompressed text output (IO6, IO7), one part file per task.

    FASTA records are self-contained, so the part files concatenated in any
    order form the export; no single task has to write all sequences.
    """
    fasta_df.write.mode("overwrite").option("compression", "none").text(path)
