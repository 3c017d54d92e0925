"""Training-data pipeline over ``documents``: filters, deduplication, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  A stage's result is written as
Parquet in the shared checkpoint folder and read again as the next one's input.

Odd rows: null and empty texts are documents like others (the classifiers score
them; near copies of each other, one of them stays; each packs to its closing id).
Repeated rows and rows with a null id are judged one by one.  An empty table gives
none.  Columns besides ``doc_id``, ``text`` and ``n_chars`` are passed on as they
are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occulink.llm.classifiers import keep_clean, keep_good
from occulink.llm.common import stage, table
from occulink.llm.jaccard import one_of_each_group
from occulink.llm.linedup import EVERY, remove_repeats
from occulink.llm.packing import pack


def _beside(docs: DataFrame, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``function`` keeps of ``docs``; it sees the columns that it does not use
    under names that clash with none of its own."""
    names = [c if c in ("doc_id", "text", "n_chars") else f"other_{i}" for i, c in enumerate(docs.columns)]
    return function(docs.toDF(*names)).select(*names).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return _beside(docs, lambda d: keep_good(d, table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier keeps."""
    return _beside(docs, lambda d: keep_clean(d, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without repeated passages; ``n_chars`` follows the text of
    those that lost one."""

    def cut(d: DataFrame) -> DataFrame:
        out = remove_repeats(d, EVERY)
        if "n_chars" in d.columns:
            size = F.when(F.col("removed_chunks") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
            out = out.withColumn("n_chars", size.cast(d.schema["n_chars"].dataType))
        return out

    return _beside(docs, cut)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return _beside(docs, one_of_each_group)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into windows."""
    import public_tokenizers

    return pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("packing", packing)]

#: The classifiers' decisions cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
