"""Turning arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, keep: list[str], *arrays: Column) -> DataFrame:
    """Rows of the given arrays in a column ``item``, next to the columns in ``keep``.

    The outer array of arrays is never empty, so Spark adds no "is it empty" filter below the
    explode; such a filter would compute the array expressions a second and third time.
    """
    outer = df.select(*keep, F.explode(F.array(*arrays)).alias("_items"))
    return outer.select(*keep, F.explode("_items").alias("item"))


def unnest_structs(df: DataFrame, keep: list[str], array: Column) -> DataFrame:
    """Like ``unnest`` for structs; their fields become columns."""
    outer = df.select(*keep, F.explode(F.array(array)).alias("_items"))
    return outer.select(*keep, F.inline("_items"))


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is worked out once per row, however often it is looked into.

    Spark would otherwise put the expression into a lambda that uses the column, and evaluate it there for every item.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def repeats(ordered: str) -> Column:
    """The items of a sorted array column beyond the first of each kind.

    Together with the distinct items they make up the array again.
    """
    following = F.slice(ordered, F.lit(2), F.size(ordered))
    pairs = F.zip_with(ordered, following, lambda a, b: F.when(a == b, a))
    return F.filter(pairs, lambda item: item.isNotNull())


def run_starts(ordered: str) -> Column:
    """Where each run of equal items begins in a sorted array column."""
    places = F.transform(
        ordered, lambda item, i: F.when((i == 0) | (item != F.get(F.col(ordered), i - 1)), i)
    )
    return F.filter(places, lambda i: i.isNotNull())
