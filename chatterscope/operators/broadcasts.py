"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most ``max_rows`` rows of ``max_bytes`` in all, as text. Reads no further than one row past that."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long") for c in df.columns), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def small(df: DataFrame, source: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side table for broadcast only if it is small; else Spark plans a shuffle join.

    ``source`` is a table that ``df`` was made from and cannot outgrow; its size is checked instead.
    """
    return F.broadcast(df) if is_small(source or df, max_rows) else df
