"""The toxicity filter without a labelled document."""

from __future__ import annotations

from pyspark.sql import functions as F

from occulink.llm import classifiers


def test_nothing_is_dropped_without_labels(spark):
    docs = spark.createDataFrame([(i, f"river stone {i}") for i in range(20)] + [(None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    null = spark.createDataFrame([(i, None, None) for i in range(20)], none.schema)
    held = docs.where(F.col("doc_id").isNotNull() & classifiers._held_out(4, 2)).select("doc_id", F.lit(1).alias("quality"), F.lit(1).alias("toxic"))
    assert held.count() > 0
    for labels in (none, null, held):
        kept = classifiers.keep_clean(docs, labels)
        assert kept.columns == docs.columns and kept.count() == docs.count()
