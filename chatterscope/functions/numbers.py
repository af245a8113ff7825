"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatterscope.constants import NEGATIVE_TO, POSITIVE_FROM


def round_half_up(value: Column, digits: int) -> Column:
    """Round like a SQL NUMERIC: half away from zero on the decimal value."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return round_half_up(F.lit(100.0) * part.cast("double") / whole.cast("double"), digits)


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= POSITIVE_FROM, F.lit("positive"))
        .when(compound <= NEGATIVE_TO, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def alert_band(ratio: Column) -> Column:
    """Colour of a spike: above 5 red, from 3 orange, from 2 yellow."""
    return (
        F.when(ratio > 5, F.lit("red"))
        .when(ratio >= 3, F.lit("orange"))
        .when(ratio >= 2, F.lit("yellow"))
    )


def sentiment_colour(average: Column) -> Column:
    return F.when(average < 0, F.lit("red")).when(average > 0, F.lit("green"))


def exact_mean(value: Column, digits: int = 6) -> Column:
    """Mean of values with few decimals, summed as integers.

    Unlike a sum of doubles this does not depend on the order in which rows arrive, so a
    re-run on other partitions gives the same number.
    """
    scale = float(10 ** digits)
    total = F.sum(F.round(value * scale).cast("long")).cast("double")
    return total / scale / F.count(value)
