"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Every rule bounds one measure of a text; a document is kept if all its measures lie within their bounds. The measures
are built-in expressions of the text alone, so a scan needs no shuffle and no Python, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: The commonest function words of the languages that the shipped thresholds are meant for.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "with",
    "der", "die", "das", "und", "ist", "den", "von", "mit", "ein", "eine", "zu", "auf",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "en", "du",
    "el", "los", "las", "y", "del", "por", "con", "se",
)


class Rule(NamedTuple):
    """A measure and the bounds it must keep; None is no bound."""

    measure: str
    least: float | None
    most: float | None


#: Length, symbol, stop-word and line rules. Ratios are of words, or of lines that have a word.
RULES = (
    Rule("mean_word_chars", 2, 15),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.3),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.3),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` named doc_id, and every measure of the text.

    A null text counts as empty: all counts are 0 and all ratios null. Words are runs of characters that are no ASCII
    blanks. n_repeat_words counts the words inside some window of eight words that the text has at least twice.
    Windows are compared by a 64-bit hash of the hashes of their words.
    """
    words = F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    one = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    two = one.select(
        "doc_id", "_text",
        words.alias("_words"), lines.alias("_lines"),
        F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    three = two.select(
        "doc_id", "word_chars", "n_symbols", "_lines",
        F.size("_words").cast("long").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
            lambda i: F.xxhash64(*(F.col("_hashes")[i + k] for k in range(WINDOW))),
        ),
    ).otherwise(F.expr("array()").cast("array<bigint>"))
    four = three.withColumn("_windows", windows)
    # Only texts with some repeated window need their windows sorted.
    ordered = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda key, at: F.struct(key.alias("key"), at.alias("at")))),
    )
    five = four.withColumn("_ordered", ordered)
    repeated = F.array_sort(
        F.transform(
            F.filter(
                F.transform(
                    "_ordered",
                    lambda x, i: F.struct(
                        x["at"].alias("at"),
                        (
                            ((i > 0) & (F.get(F.col("_ordered"), i - 1)["key"] == x["key"]))
                            | F.coalesce(F.get(F.col("_ordered"), i + 1)["key"] == x["key"], F.lit(False))
                        ).alias("again"),
                    ),
                ),
                lambda x: x["again"],
            ),
            lambda x: x["at"],
        )
    )
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, at: F.struct(
            (acc["n"] + (at + WINDOW - F.greatest(at, acc["end"]))).cast("long").alias("n"), (at + WINDOW).alias("end")
        ),
    )["n"]
    return five.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.col("n_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_lines", lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        "n_stop_words", "n_lines",
    )


def verdict(rules: Sequence[Rule] = RULES) -> Column:
    """All rules as one boolean expression over the columns of `measures`. A measure that is null breaks no rule."""
    known = {
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), F.col("n_words")),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "bullet_line_ratio": _ratio(F.col("n_bullet_lines"), F.col("n_lines")),
        "ellipsis_line_ratio": _ratio(F.col("n_ellipsis_lines"), F.col("n_lines")),
        "n_words": F.col("n_words"),
        "n_repeat_words": F.col("n_repeat_words"),
    }
    out = F.lit(True)
    for measure, least, most in rules:
        if least is not None:
            out &= F.coalesce(known[measure] >= least, F.lit(True))
        if most is not None:
            out &= F.coalesce(known[measure] <= most, F.lit(True))
    return out


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """One row per document: measures, whether the base rules fail, and whether it is kept.

    Base rules: fewer than `min_words` words, or more than `repeat_percent` % of the words in repeated windows. Null
    and empty texts fail them. Repeated doc_ids are judged one by one; other columns of `docs` are not read.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
