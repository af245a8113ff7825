"""Connected components of links between numbered rows, by rounds of Spark joins.

Alternates the two star operations known from the literature: every node's larger neighbours are linked to its
smallest neighbour, then every node and its smaller neighbours to the smallest of them. Each keeps connectivity, and a
chain of n links becomes stars in about log n rounds. All state is in written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.scratch import written


def _to_smallest(pairs: DataFrame, keep_own: bool) -> DataFrame:
    """(u, v) pairs become (v, smallest of u and its v). Counting the smallest first lets Spark split a hot u's join."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    out = pairs.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep_own:
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _measure(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links, a table of long columns a and b; component is its smallest node.

    Loops and repeated links are allowed; no links give no rows.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    pairs = written(spark, pairs, "links")
    before = _measure(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours only; a smaller one stays linked through the smallest.
        large = both.join(both.groupBy("u").agg(F.min("v").alias("m")), "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = written(spark, large, "large-star")
        pairs = written(spark, _to_smallest(large, keep_own=True), "small-star")
        now = _measure(pairs)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
