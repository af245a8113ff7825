"""The small side tables shipped with the package, as DataFrames.

Each has under 200 rows. Callers may pass tables of their own instead.
"""

from __future__ import annotations

import csv
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chatterscope.constants import EMOJI, FEEDS, IDIOMS


def rows(name: str) -> list[dict]:
    with files(__package__).joinpath(f"{name}.csv").open(encoding="utf-8") as handle:
        return list(csv.DictReader(handle))


def english_stopwords() -> list[str]:
    """Spark ML's English list, without the words that three-letter tokens can never equal."""
    return files(__package__).joinpath("stopwords_english.txt").read_text("utf-8").split()


def _frame(spark: SparkSession, data: list[dict]) -> DataFrame:
    """Small Arrow tables become local relations, whose size Spark knows without a job."""
    return spark.createDataFrame(pa.Table.from_pylist(data))


def lexicon(spark: SparkSession) -> DataFrame:
    return _frame(spark, [{**r, "valence": float(r["valence"])} for r in rows("lexicon")])


def modifiers(spark: SparkSession) -> DataFrame:
    return _frame(spark, [{**r, "weight": float(r["weight"])} for r in rows("modifiers")])


def idioms(spark: SparkSession) -> DataFrame:
    return _frame(spark, [{"term": t, "valence": v} for t, v in IDIOMS])


def emoji(spark: SparkSession) -> DataFrame:
    return _frame(spark, [{"symbol": s, "name": n} for s, n in EMOJI])


def gazetteer(spark: SparkSession) -> DataFrame:
    return _frame(spark, rows("gazetteer"))


def feed_map(spark: SparkSession) -> DataFrame:
    return _frame(spark, [{"feed": f, "topic": t, "url": u} for f, t, u in FEEDS])
