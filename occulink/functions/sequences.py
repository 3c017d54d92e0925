"""Nucleotide sequence cleaning and FASTA rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occulink.functions.common import as_col

# fixed value: IUPAC nucleotide letters kept in an exported sequence
IUPAC_NUCLEOTIDES = "ACGTURYSWKMBDHVN"


def normalize_sequence(c) -> Column:
    """Upper-case and keep IUPAC letters only; NULL or empty input -> NULL.

    A non-empty input without any valid letter becomes the empty string.
    """
    c = as_col(c)
    cleaned = F.regexp_replace(F.upper(c), f"[^{IUPAC_NUCLEOTIDES}]", "")
    return F.when(c.isNotNull() & (F.length(c) > 0), cleaned)


def fasta_record(seq) -> Column:
    """``>md5(seq)`` header line followed by the sequence."""
    seq = as_col(seq)
    return F.concat(F.lit(">"), F.md5(seq), F.lit("\n"), seq)
