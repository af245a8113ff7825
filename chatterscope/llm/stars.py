"""Groups of linked rows found through shared buckets, without listing all pairs of a bucket.

In a bucket every row is compared with one hub. Only a bucket whose rows then lie in several components may still hide a
link; an operator finds those links by an exact search of its own. So no linked pair that shares a bucket is lost, while a
bucket of n alike rows costs n comparisons.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.components import components
from chatterscope.llm.scratch import small_side, written

#: Whether two rows' info allows a link at all; and pairs (a, b, info_a, info_b) to (a, b, linked).
Possible = Callable[[Column, Column], Column]
Verify = Callable[[DataFrame], DataFrame]


def crowded(spark: SparkSession, keyed: DataFrame, first: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows (key, id, info) of buckets that have company, with the bucket's size and hub. Ids of any orderable type.

    first: the row with the least value of it, by its info, is the hub, the smallest id among equals.

    Keys alone are counted first, as most have one row; rows move only if their key has more.
    """
    counts = written(spark, keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "crowded-keys")
    rows = written(spark, keyed.join(small_side(counts), "key"), "bucket-rows")
    order = F.lit(0) if first is None else first(F.col("info"))
    least = rows.groupBy("key").agg(F.min(F.struct(order.alias("order"), "id", "info")).alias("hub"))
    hubs = written(spark, least.select("key", F.struct("hub.id", "hub.info").alias("hub")), "hubs")
    return written(spark, rows.join(small_side(hubs), "key"), "buckets")


def pairs_of(rows: DataFrame, one: Column, other: Column, possible: Possible) -> DataFrame:
    """Pairs (a, b, info_a, info_b) of two columns (id, info) that may be linked, a the larger id, each once."""
    # `possible` is asked before the pair is put in order, which would otherwise be done anew for each use of an info.
    rows = rows.where(one["id"] != other["id"]).where(possible(one["info"], other["info"]))
    high, low = F.greatest(one, other), F.least(one, other)
    pairs = rows.select(high["id"].alias("a"), low["id"].alias("b"), high["info"].alias("info_a"), low["info"].alias("info_b"))
    return pairs.dropDuplicates(["a", "b"])


def star_components(spark: SparkSession, buckets: DataFrame, possible: Possible, verify: Verify, across: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of all rows with a link; component is the smallest id.

    across: from the rows (key, id, info, hub_id, part) of the buckets that span several components (part), and from the pairs that were
    verified, a table like these that connects whatever else is linked within such a bucket.
    """
    done = written(spark, verify(pairs_of(buckets, F.struct("id", "info"), F.col("hub"), possible)), "verified")
    parts = written(spark, components(spark, done.where("linked")), "components")

    own = buckets.where("size > 2").join(small_side(parts).withColumnRenamed("node", "id"), "id", "left")
    own = written(spark, own.select("key", "id", "info", F.col("hub.id").alias("hub_id"), F.coalesce("component", "id").alias("part")), "parted")
    several = own.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    rows = written(spark, own.join(small_side(written(spark, several, "several")), "key"), "open-rows")
    if rows.isEmpty():
        return parts
    more = written(spark, across(rows, done).select("a", "b", "linked"), "verified")
    return written(spark, components(spark, done.select("a", "b", "linked").unionByName(more).where("linked")), "components")
