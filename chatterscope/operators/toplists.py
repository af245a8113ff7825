"""Top-n rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, numbered in ``rank``.

    Spark limits each task's share of a group before the exchange, so a hot group sends at
    most ``n`` rows per task to the task that merges it. ``order`` must be total.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)
