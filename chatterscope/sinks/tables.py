"""Writing tables: keyed appends, partition overwrites, contract checks and counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from chatterscope.operators.toplists import top_n_per_group
from chatterscope.schemas import DEFAULTS, KEYS, MAX_LENGTHS, SCHEMAS
from chatterscope.session import scratch_dir


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table, or no rows where it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key. Copies of a hot key are dropped in each task before the shuffle."""
    return top_n_per_group(df, keys, order, 1).drop("rank")


def known_keys(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of the batch that the stored table holds.

    With a small batch Spark broadcasts its keys, and the large table is only scanned, one
    column wide, not shuffled.
    """
    return existing.select(*keys).join(new.select(*keys), keys, "left_semi").distinct()


def anti_existing(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the stored table does not hold."""
    return new.join(known_keys(existing, new, keys), keys, "left_anti")


def append_new(
    new: DataFrame, existing: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """What an insert that skips known keys would add: the first row per new key."""
    known = known_keys(existing, new, keys)
    return first_per_key(new, keys, order).join(known, keys, "left_anti")


def overwrite_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replaces exactly the partitions that ``df`` has rows for, so repeating it changes nothing.

    The rebalance hint gives evenly sized files: large partitions are split, small ones merged.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def upsert_daily_summary(summary: DataFrame, path: str) -> None:
    """Inserts the rows of ``summary`` or replaces those of the same day and subreddit.

    Other rows of the touched days are carried over. What the days become is stored first, as they
    are read and replaced.
    """
    spark = summary.sparkSession
    merged_path = scratch_dir(spark, "summary")
    old = read_table(spark, path, summary.schema).alias("old")
    new = summary.alias("new")
    days = summary.select("summary_date").distinct()
    same = (F.col("old.summary_date") == F.col("new.summary_date")) & F.col("old.subreddit").eqNullSafe(
        F.col("new.subreddit")
    )
    kept = old.join(days, "summary_date", "left_semi").alias("old").join(new, same, "left_anti")
    kept.select(summary.columns).unionByName(summary).write.parquet(merged_path)
    overwrite_partitions(spark.read.schema(summary.schema).parquet(merged_path), path, "summary_date")


def write_keyword_trends(trends: DataFrame, path: str) -> None:
    """Replaces the hours of ``trends`` and leaves all others as they are; the caller passes whole hours."""
    hours = {"dt": F.to_date("hour_bucket"), "hr": F.hour("hour_bucket")}
    overwrite_partitions(trends.withColumns(hours), path, "dt", "hr")


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS[table].items() if c in df.columns}
    return df.withColumns(filled) if filled else df


def validate_contract(df: DataFrame, table: str, lengths: bool = True) -> DataFrame:
    """Fills defaults and adds ``violations``: what breaks the table's rules, empty if nothing.

    ``lengths`` checks the longest accepted strings too, which only a database column needs.
    """
    filled = with_defaults(df, table)
    required = [f.name for f in SCHEMAS[table].fields if not f.nullable and f.name in df.columns]
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    checks += [
        F.when(F.length(c) > n, F.lit(f"{c} is longer than {n}"))
        for c, n in MAX_LENGTHS[table].items() if lengths and c in df.columns
    ]
    return filled.withColumn(
        "violations", F.filter(F.array(*checks), lambda found: found.isNotNull())
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0).drop("violations")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") > 0)


def fk_semi(child: DataFrame, posts: DataFrame) -> DataFrame:
    """Child rows whose post exists."""
    return child.join(posts.select("post_id"), "post_id", "left_semi")


def orphans(child: DataFrame, posts: DataFrame) -> DataFrame:
    """Child rows whose post does not exist."""
    return child.join(posts.select("post_id"), "post_id", "left_anti")


def delete_posts_cascade(
    deleted: DataFrame, *tables: DataFrame
) -> tuple[DataFrame, ...]:
    """What remains of posts and their children once the given posts are gone."""
    keys = deleted.select("post_id")
    return tuple(t.join(keys, "post_id", "left_anti") for t in tables)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows and keys on the way through; the counts are there once ``df`` was written."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def append_counted(
    new: DataFrame, existing: DataFrame, table: str, order: list[Column], path: str
) -> dict[str, int]:
    """Appends the new keys and reports how many rows were offered and how many inserted."""
    keys = KEYS[table]
    known = known_keys(existing, new, keys)
    offered, attempted = observed(new, f"{table}-attempted")
    fresh = first_per_key(offered, keys, order).join(known, keys, "left_anti")
    added, inserted = observed(fresh, f"{table}-inserted")
    added.write.mode("append").parquet(path)
    return {"attempted": attempted.get["rows"], "inserted": inserted.get["rows"]}
