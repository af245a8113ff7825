"""Tables written to the folder that all executors share, to cut lineage.

A written table outlives lost executors, unlike cached or locally checkpointed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.session import scratch_dir


def written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """The rows, stored and read again."""
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


#: A stored side of a join is broadcast up to this many rows; more are shuffled.
BROADCAST_ROWS = 1_000_000


def small_side(stored: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The stored rows of narrow columns, marked to be broadcast if a count finds them few."""
    return F.broadcast(stored) if stored.limit(most + 1).count() <= most else stored


def unused(rows: DataFrame, name: str) -> str:
    """The name, made longer until no column has it."""
    while name.lower() in {c.lower() for c in rows.columns}:
        name += "_"
    return name
