"""Quality and toxicity of documents, each by a factorisation machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occulink.llm import fm

#: Hashed words, structure statistics and the text's own sizes.
QUALITY = fm.Settings(statistics=True)
#: Hashed terms alone; pairs of them meet in the factors.
TOXICITY = fm.Settings(statistics=False)
#: A document gets label 1 from this score on.
THRESHOLD = 0.3


def _held_out(modulus: int, remainder: int) -> Column:
    return fm.id_remainder(modulus) == remainder


def quality_model(docs: DataFrame, labels: DataFrame, settings: fm.Settings = QUALITY) -> fm.Model:
    return fm.fit(docs, labels, "quality", ~_held_out(5, 0), settings)


def toxicity_model(docs: DataFrame, labels: DataFrame, settings: fm.Settings = TOXICITY) -> fm.Model:
    return fm.fit(docs, labels, "toxic", ~_held_out(4, 2), settings)


def scores(docs: DataFrame, model: fm.Model, held_out: Column) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    scored = fm.with_score(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every document; the model learns from rows outside the fold
    ``crc32(doc_id) mod 5 = 0``.  Null texts count as empty, null ids as the
    empty id, repeated rows are scored alike, an empty table gives no rows and
    further columns are not read."""
    return scores(docs, quality_model(docs, labels), _held_out(5, 0))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every document; the model learns from rows outside the fold
    ``crc32(doc_id) mod 4 = 2``.  Odd rows are treated as by
    :func:`quality_scores`."""
    return scores(docs, toxicity_model(docs, labels), _held_out(4, 2))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a quality score of at least the threshold."""
    return fm.with_score(docs, quality_model(docs, labels), "__score").where(F.col("__score") >= THRESHOLD).drop("__score")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a toxicity score below the threshold; all of them
    without a labelled document to learn from."""
    model = toxicity_model(docs, labels)
    if not model.rows:
        return docs
    return fm.with_score(docs, model, "__score").where(F.col("__score") < THRESHOLD).drop("__score")
