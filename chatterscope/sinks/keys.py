"""Which keys a table holds: a narrow index, so that an append never scans the table itself.

The index is a table of keys bucketed by key. A batch's keys meet it bucket by bucket, so the history is never
shuffled. In front of it lies a bit filter per bucket: keys whose bit is not set are new, and if no key of a batch
has its bit set, Spark skips the scan of the index.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from chatterscope.sinks.files import remove
from chatterscope.sinks.tables import read_table

_FILTERS = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("number", T.LongType()), T.StructField("bits", T.BinaryType()),
])
_GENERATIONS = T.StructType([T.StructField("generation", T.IntegerType())])
#: Bits in one of Spark's bitmaps.
_BITMAP = 32_768
#: What rows are marked with once no batch among them can be repeated.
BASE = "base"


class KeyIndex:
    """The keys stored so far, each with the batch that brought it.

    ``buckets`` and ``bits`` (per bucket, one hash) are fixed once the index is written. About ten bits per key
    keep nine of ten new keys from the index; with fewer it stays right and only reads more. A batch that is repeated finds its own keys
    in the index; they do not count as known to it. ``most_files`` per bucket are written before they are made one.
    """

    def __init__(self, path: str, column: str = "post_id", buckets: int = 64, bits: int = 1 << 20, most_files: int = 8):
        self.path, self.column, self.buckets, self.bits, self.most_files = path, column, buckets, bits, most_files

    def _generation(self, spark: SparkSession) -> int:
        return read_table(spark, f"{self.path}/generations", _GENERATIONS).agg(F.max("generation")).first()[0] or 0

    def _folder(self, kind: str, generation: int) -> str:
        return f"{self.path}/{kind}-{generation}"

    def _table(self, spark: SparkSession, generation: int) -> str:
        """The name of the bucketed table over the index's files. Names hold for a session, files for good."""
        folder = self._folder("keys", generation)
        name = f"key_index_{hashlib.md5(folder.encode()).hexdigest()}"
        location = folder.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (`{self.column}` STRING, batch STRING) USING parquet "
            f"CLUSTERED BY (`{self.column}`) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        spark.catalog.refreshTable(name)
        return name

    def _place(self) -> list[Column]:
        """Bucket, bitmap and bit of a key. The bucket is the one that Spark's bucketing deals the key to."""
        position = F.pmod(F.xxhash64(self.column), F.lit(self.bits))
        return [
            F.pmod(F.hash(self.column), F.lit(self.buckets)).alias("bucket"),
            F.floor(position / _BITMAP).alias("number"), (position % _BITMAP).alias("bit"),
        ]

    def _filters(self, spark: SparkSession, generation: int) -> DataFrame:
        stored = read_table(spark, self._folder("filters", generation), _FILTERS)
        return stored.groupBy("bucket", "number").agg(F.bitmap_or_agg("bits").alias("bits"))

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """The distinct keys whose bit is set: all known ones, and a few new ones."""
        spark = keys.sparkSession
        placed = keys.select(self.column).distinct().select(self.column, *self._place())
        byte = F.hex(F.call_function("substring", F.col("bits"), (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1)))
        own = F.call_function("shiftleft", F.lit(1), (F.col("bit") % 8).cast("int"))
        is_set = F.conv(byte, 16, 10).cast("int").bitwiseAND(own)
        filters = self._filters(spark, self._generation(spark))
        return placed.join(filters, ["bucket", "number"]).where(is_set != 0).select(self.column)

    def known(self, keys: DataFrame, batch: str | None = None) -> DataFrame:
        """The keys that other batches than ``batch`` have stored."""
        spark = keys.sparkSession
        stored = spark.table(self._table(spark, self._generation(spark)))
        if batch is not None:
            stored = stored.where(F.col("batch") != batch)
        return stored.select(self.column).join(self.maybe_known(keys), self.column, "left_semi").distinct()

    def build(self, rows: DataFrame) -> None:
        """Indexes a table that was stored without an index, from its keys and batches."""
        self._append(rows.select(self.column, "batch").distinct(), self._generation(rows.sparkSession))

    def add(self, keys: DataFrame, batch: str) -> None:
        """Stores the keys of a batch. The filter comes first, so that no stored key is ever without its bit."""
        spark = keys.sparkSession
        self.build(keys.select(self.column, F.lit(batch).alias("batch")))
        generation = self._generation(spark)
        files = len(spark.table(self._table(spark, generation)).inputFiles())
        if files > self.most_files * self.buckets:
            self.compact(spark, batch)

    def _append(self, rows: DataFrame, generation: int) -> None:
        bits = rows.select(*self._place()).groupBy("bucket", "number").agg(F.bitmap_construct_agg("bit").alias("bits"))
        bits.coalesce(1).write.mode("append").parquet(self._folder("filters", generation))
        name = self._table(rows.sparkSession, generation)
        rows.repartition(self.buckets, self.column).write.insertInto(name)

    def forget(self, keys: DataFrame) -> None:
        """Takes keys out, so that they count as new once they come again."""
        self.compact(keys.sparkSession, BASE, without=keys)

    def compact(self, spark: SparkSession, last: str, without: DataFrame | None = None) -> None:
        """Makes the files of a bucket one. Keys of all batches but the last, which alone can be repeated, become the base's.

        The next generation is written whole before it counts; after a crash the former one still does.
        """
        now = self._generation(spark)
        rows = spark.table(self._table(spark, now))
        if without is not None:
            rows = rows.join(without.select(self.column), self.column, "left_anti")
        whose = F.when(F.max((F.col("batch") != last).cast("int")) == 1, F.lit(BASE)).otherwise(F.lit(last))
        for kind in ("keys", "filters"):
            remove(spark, self._folder(kind, now + 1))  # of an attempt that was lost
        self._append(rows.groupBy(self.column).agg(whose.alias("batch")), now + 1)
        spark.createDataFrame([(now + 1,)], _GENERATIONS).coalesce(1).write.mode("append").parquet(f"{self.path}/generations")
        for kind in ("keys", "filters"):
            remove(spark, self._folder(kind, now))

    def exists(self, spark: SparkSession) -> bool:
        return self._generation(spark) > 0 or not read_table(spark, self._folder("filters", 0), _FILTERS).isEmpty()
