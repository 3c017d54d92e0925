"""The FASTA export job: table -> distinct normalised sequences -> text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from occulink.operators.fasta import fasta, write_fasta


def run_fasta(source: DataFrame, target: str, column: str = "dnasequence") -> DataFrame:
    out = fasta(source, column)
    write_fasta(out, target)
    return out
