"""Streams whose micro-batches are handled one by one, each under a name of its own."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_batches(
    stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, str], None], every: str | None = None
) -> StreamingQuery:
    """Calls ``on_batch`` with each micro-batch and its name; a batch that is repeated has the same name again.

    Batch numbers restart with a new checkpoint; the id that the checkpoint gives the query tells the runs apart.
    Without ``every`` the stream works off what has landed and stops.
    """
    known, query = threading.Event(), []

    def named(rows: DataFrame, number: int) -> None:
        known.wait()
        on_batch(rows, f"{query[0].id}-{number:012d}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint).trigger(**trigger)
    query.append(writer.start())
    known.set()
    return query[0]
