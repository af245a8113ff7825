"""Secrets in every version of every text, by an incremental ledger of content-addressed blobs.

A version's blob is the SHA-256 of its text. The ledger holds, per blob and rule version, the findings of one scan; only
pairs it lacks are scanned, so copies and old versions cost nothing, and findings are joined back to all paths that
hold the blob. Everything is built-in expressions: positions come from the pieces between matches, split by the same
pattern.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.functions.arrays import settled
from chatterscope.llm.scratch import small_side, written
from chatterscope.session import scratch_dir


class SecretRule(NamedTuple):
    """A pattern, and the least length of one of its groups; shorter matches are used up but not reported."""

    kind: str
    pattern: str
    group: int
    least: int


RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    SecretRule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),  # a run shorter than 18 has no longer match in it
    SecretRule("hex", r"[0-9a-f]{16,}", 0, 16),
)
RULE_VERSION = "1"


#: Matches are placed in blocks of this many, as appending to an array copies it.
BLOCK = 128
_SPANS = "array<struct<start int, rank int, kind string, end int>>"


def _lengths(text: Column, rule: SecretRule) -> Column:
    """Of each match: the code points before it since the last one, of itself and of its group. The last entry has no match; null without any."""
    pattern = F.lit(rule.pattern)
    size = lambda parts: F.transform(parts, F.length)
    pieces = F.arrays_zip(
        size(F.split(text, rule.pattern, -1)).alias("gap"),
        size(F.regexp_extract_all(text, pattern, F.lit(0))).alias("whole"),
        size(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("group"),
    )
    return F.when(F.regexp_like(text, pattern), pieces)


def _with_matches(rows: DataFrame, rule: SecretRule, rank: int) -> DataFrame:
    """Adds found_<rank>: the rule's matches in the text, leftmost and apart, as (start, rank, kind, end) in code points.

    Each begins after all pieces and matches before it. Sums of blocks come first, so the time is nearly linear in the matches.
    """
    pieces, sums, begins = (f"{x}_{rank}" for x in ("pieces", "sums", "begins"))
    passed = lambda x: x["gap"] + F.coalesce(x["whole"], F.lit(0))
    block = lambda k: F.slice(pieces, k * BLOCK + 1, BLOCK)
    none = F.array().cast(_SPANS)
    rows = settled(rows, pieces, _lengths(F.col("text"), rule))
    blocks = F.sequence(F.lit(0), ((F.size(pieces) - 1) / BLOCK).cast("int"))
    rows = settled(rows, sums, F.when(F.col(pieces).isNotNull(), F.transform(blocks, lambda k: F.aggregate(block(k), F.lit(0), lambda total, x: total + passed(x)))))
    running = F.aggregate(sums, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
    rows = settled(rows, begins, F.slice(running, F.lit(1), F.size(sums)))

    def placed(at: Column, k: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (start + x["whole"]).alias("end"))
            spans = F.when(x["group"] >= rule.least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
            return F.struct((acc["at"] + passed(x)).alias("at"), spans.alias("spans"))

        return F.aggregate(block(k), F.struct(at.alias("at"), none.alias("spans")), step)["spans"]

    found = F.when(F.col(pieces).isNull(), none).otherwise(F.flatten(F.transform(begins, placed)))
    return settled(rows, f"found_{rank}", found).drop(pieces, sums, begins)


def scan(blobs: DataFrame, rules: Sequence[SecretRule], rule_version: str) -> DataFrame:
    """(blob, rule_version, spans) of (blob, text); spans by start, then by the order of the rules."""
    for rank, rule in enumerate(rules):
        blobs = _with_matches(blobs, rule, rank)
    found = [F.col(f"found_{rank}") for rank in range(len(rules))]
    return blobs.select("blob", F.lit(rule_version).alias("rule_version"), F.array_sort(F.concat(*found)).alias("spans"))


LEDGER = f"blob string, rule_version string, spans {_SPANS}"


def scan_new(spark: SparkSession, versions: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES, rule_version: str = RULE_VERSION, keys: Sequence[str] = ("path", "version")) -> DataFrame:
    """Scans the versions' unseen blobs, adds them to the ledger at that path, and gives every version's findings.

    versions: the key columns and text. One row per given row: keys, blob and spans. A null text counts as empty; repeated
    rows share a blob and are each reported. Appending the same blobs again after a failure does no harm, as a reader
    takes one entry for each blob and rule version. Other columns of `versions` are not read; keys named blob, spans or text are refused.
    """
    if {"blob", "spans", "text"} & {k.lower() for k in keys}:
        raise ValueError("keys can't be named blob, spans or text")
    given = versions.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    addressed = given.withColumn("blob", F.sha2("text", 256))
    known = _entries(spark, ledger)
    todo = addressed.select("blob", "text")
    if known is not None:
        # Keys are looked up alone, so the texts of known blobs don't move.
        unseen = addressed.select("blob").distinct().join(known.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
        todo = todo.join(small_side(written(spark, unseen, "unseen-blobs")), "blob", "left_semi")
    scan(todo.groupBy("blob").agg(F.first("text").alias("text")), rules, rule_version).write.mode("append").parquet(ledger)
    findings = _entries(spark, ledger).where(F.col("rule_version") == rule_version).where(F.size("spans") > 0).dropDuplicates(["blob"])
    findings = written(spark, findings, "findings")  # a join of stored rows can be split where one blob has many paths
    held = addressed.select(*keys, "blob").join(findings.select("blob", "spans"), "blob", "left")
    return held.select(*keys, "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def _entries(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The stored entries; None while there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def secrets(spark: SparkSession, docs: DataFrame, rules: Sequence[SecretRule] = RULES, ledger: str | None = None) -> DataFrame:
    """One row per document: matches by kind, a digest of their spans, and the spans. Each document is a path of one version.

    Without a ledger the scan starts from an empty one. The method adds no spans to the rules' own. Null and empty texts
    have none; an empty table gives no rows.
    """
    ledger = ledger or scratch_dir(spark, "secret-ledger")
    found = scan_new(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ledger, rules, keys=("doc_id",))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in rules]
    rows = found.select("doc_id", *counts, spans.alias("spans"))
    return rows.select("doc_id", *[f"n_{r.kind}" for r in rules], F.sha2("spans", 256).alias("base_sha256"), "spans")
