"""Connected groups of linked rows by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occulink.llm.common import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each row's larger (or smaller) neighbours on its least neighbour."""
    u, v = F.col("u"), F.col("v")
    both = edges.select("u", "v").unionByName(edges.select(v.alias("u"), u.alias("v"))) if large else edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = both.join(least, "u")
    hung = met.where(v > u).select(v.alias("u"), F.col("m").alias("v")) if large else met.select(v.alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return hung.where(u != v).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """``row, root`` for the rows of ``edges(u long, v long)``: the least row
    number that a row is connected with.  Each round is a few joins on staged
    edges; their number grows with the logarithm of the longest path."""
    now = stage(edges.where("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        now = stage(_stars(_stars(now, large=True), large=False), "edges")
    return now.select(F.col("u").alias("row"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("row"), F.col("v").alias("root")).distinct())
