"""What each micro-batch of a stream took in, stored, lost to the watermark, and how long it took."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from chatterscope.sinks.tables import read_table
from chatterscope.streaming.live import dropped_late

ATTEMPTED, INSERTED = "attempted", "inserted"
METRICS = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("attempted", T.LongType()), T.StructField("inserted", T.LongType()),
    T.StructField("dropped_late", T.LongType()), T.StructField("duration_ms", T.LongType()),
    T.StructField("reported_at", T.StringType()),
])


def counted(stream: DataFrame, name: str) -> DataFrame:
    """Counts the rows that pass here in each micro-batch, under a name the listener knows."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"))


class MetricsListener(StreamingQueryListener):
    """Stores a row for each micro-batch of the session's streams; those without ``counted`` report the rows they read.

    Reports arrive on a thread of their own, some time after the batch. ``flush`` waits until a query's last is
    stored.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = {name: row["rows"] for name, row in progress.observedMetrics.items() if "rows" in row.asDict()}
        row = (
            str(progress.id), progress.batchId, observed.get(ATTEMPTED, progress.numInputRows),
            observed.get(INSERTED), dropped_late(progress), progress.batchDuration, progress.timestamp,
        )
        self._spark.createDataFrame([row], METRICS).coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def flush(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Waits for the end of a query and of its reports; False if they take longer."""
        query.awaitTermination()
        return self._end_of(str(query.runId)).wait(seconds)


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch. Of a batch that was repeated the last report counts."""
    latest = F.row_number().over(Window.partitionBy("query", "batch_id").orderBy(F.desc("reported_at")))
    return read_table(spark, path, METRICS).withColumn("_latest", latest).where("_latest = 1").drop("_latest")
