"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept and gives documents again, but for the last, which gives the
pieces of the sequences. Texts that a stage changes go on changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatterscope.llm.decontamination import decontaminate
from chatterscope.llm.line_dedup import without_repeated_lines
from chatterscope.llm.minhash import near_duplicates
from chatterscope.llm.packing import pack
from chatterscope.llm.scratch import written
from chatterscope.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not taken for toxic. Without a confirmed example all stay."""
    return without_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that (nearly) repeat an earlier one."""
    return without_repeated_lines(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; those without words and those without a doc_id stay."""
    gone = near_duplicates(spark, docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without spans of benchmark items; those mostly made of such spans go."""
    return decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Learned scores, hashes and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored before the next reads it."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = written(spark, stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
