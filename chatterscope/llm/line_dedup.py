"""Fuzzy line deduplication: hashes of words as candidates, edit similarity, one occurrence per connected group.

Lines are normalised and reduced to distinct ones. Two are linked if their edit similarity reaches a threshold, at every
length. Candidates share the least hashes of their words under four of `MINIMA` orders. A SimHash can't find them: a
changed word flips 9 of its 63 bits in a line of 8 words, and blocks that stay equal then are too short to be keys. Candidates
that no hub connects (`stars.py`) are compared with each other in cells of bounded size; only linked ones become rows. Lines
connected by links form a group, of which the first occurrence in the corpus stays. Built-in functions only. Texts stay
where they are, unless so many lines have candidates that these can't be broadcast.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.scratch import BROADCAST_ROWS, small_side, unused, written
from chatterscope.llm.stars import Possible, crowded, star_components

MIN_WORDS, SIMILARITY = 5, 0.9
#: Orders of the words' hashes, and places of the orders that make a key, counted from each order on. Two keys share one at most.
MINIMA, ROWS = 13, (0, 1, 3, 9)
#: Words of fewer characters are mostly function words, which lines of a language share; they come after three quarters of the hashes.
LONG_CHARS, MASK = 4, (1 << 31) - 1
#: Each order is that of the hashes after an exclusive or with a fixed number.
ORDERS = [random.Random(9 + k).getrandbits(31) for k in range(MINIMA)]
#: Scripts without blanks, in which each character counts as a word.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_APART = r"[^\p{L}\p{N}]+"
#: Characters that are counted together, to rule out pairs by the counts alone.
COUNTED = [*"etaonisrhldcum", "fp", "gw", "yb", "vkxjqz", "éèêëáíóúñçäöüß"]
#: What stands for them while they are counted, of one byte each. A normalised line has letters, digits and blanks only.
_STAND_IN = [x[0] if x.isascii() else "#" for x in COUNTED]
#: Lines of a bucket are compared with each other in blocks of about so many.
BLOCK = 128


def words_of(line: Column) -> Column:
    """Runs of letters and digits of a lower-case line: the normalised line, as an array."""
    return F.array_remove(F.split(line, _APART), "")


def _units(norm: Column, words: Column) -> Column:
    """The words, or in scripts without blanks the characters."""
    unspaced = (F.octet_length(norm) > F.length(norm)) & norm.rlike(f"[{UNSPACED}]")
    return F.when(unspaced, F.array_remove(F.split(norm, f" |(?<=[{UNSPACED}])|(?=[{UNSPACED}])"), "")).otherwise(words)


def _lines(texts: DataFrame) -> DataFrame:
    """(doc_id, at, line): lower-case lines, numbered from 0 in their document."""
    return texts.select("doc_id", F.posexplode(F.split(F.lower("text"), "\n")).alias("at", "line"))


def _with_words(lines: DataFrame) -> DataFrame:
    """Adds the words in place of the line. Exploding an array of one keeps Spark from working them out at every use."""
    return lines.withColumn("words", F.explode(F.array(words_of(F.col("line"))))).drop("line")


def _keys() -> list[Column]:
    """128 bits that stand for the normalised line."""
    return [F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2")]


def _signed(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, at, k1, k2, size, minima) of every line with words, numbered from 0 in its document.

    minima: under each order, the least hash of a word; null for lines of too few. They are found in the task before they are shuffled.
    """
    lines = _with_words(_lines(docs))
    norm = F.array_join("words", " ")
    lines = lines.where(F.size("words") > 0).select("*", F.explode(F.array(_units(norm, F.col("words")))).alias("units"))
    # The keys come first: in one select with the explode they would be worked out again for each word.
    keyed = lines.select("doc_id", "at", *_keys(), F.length(norm).alias("size"), "units", F.size("units").alias("n"))
    words = keyed.select("doc_id", "at", "k1", "k2", "size", "n", F.explode(F.when(F.col("n") >= min_words, F.col("units")).otherwise(F.array(F.lit("")))).alias("word"))
    words = words.withColumn("h", F.hash("word").bitwiseAND(F.lit(MASK))).withColumn("short", F.length("word") < LONG_CHARS)
    order = lambda x: F.col("h").bitwiseXOR(F.lit(x))
    late = lambda h: F.shiftright(h, 2).bitwiseOR(F.lit(MASK - (MASK >> 2)))
    least = [F.min(F.when(F.col("short"), late(order(x))).otherwise(order(x))).alias(f"m{k}") for k, x in enumerate(ORDERS)]
    signed = words.groupBy("doc_id", "at", "k1", "k2", "size", "n").agg(*least)
    return signed.select("doc_id", "at", "k1", "k2", "size", F.when(F.col("n") >= min_words, F.array(*[f"m{k}" for k in range(MINIMA)])).alias("minima"))


def _bucket_keys(minima: Column) -> Column:
    return F.array(*[F.xxhash64(F.lit(k), *[minima[(k + r) % MINIMA] for r in ROWS]) for k in range(MINIMA)])


def _alike(a: Column, b: Column) -> Column:
    """How many elements two arrays that differ begin with alike."""
    return F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False).cast("int") - 1


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of the value, which is worked out once."""
    return F.transform(F.array(value), use)[0]


def _counts(norm: Column) -> Column:
    alike = F.translate(norm, "".join(COUNTED), "".join(y * len(x) for x, y in zip(COUNTED, _STAND_IN, strict=True)))
    count = lambda line: [F.octet_length(line) - F.octet_length(F.replace(line, F.lit(y))) for y in _STAND_IN]
    return _with(alike, lambda line: F.array(*count(line)))


def _most(a: Column, b: Column, similarity: float) -> Column:
    """The most edits that lines of these lengths may differ by."""
    return F.floor(F.greatest(a, b) * (1 - similarity) + 1e-9)


def _counts_apart(a: Column, b: Column) -> Column:
    """An edit lowers one count by one and raises one by one at most, so lines of these counts differ by no fewer."""
    more, fewer = (reduce(add, [F.greatest(x[k] - y[k], F.lit(0)) for k in range(len(COUNTED))]) for x, y in ((a, b), (b, a)))
    return F.greatest(more, fewer)


def _similar(a: Column, b: Column, similarity: float) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    most = F.floor(longest * (1 - similarity) + 1e-9).cast("int")

    def linked(x: Column) -> Column:
        pa, pb, most = x["pa"], x["pb"], x["most"]
        # Replacing the words that differ place by place bounds the distance; mostly that decides.
        changed = F.zip_with(pa, pb, lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.length(x), F.length(y))))
        replaced = (F.size(pa) == F.size(pb)) & (F.aggregate(changed, F.lit(0), lambda total, n: total + n) <= most)
        return F.when(replaced, True).otherwise(_with(F.struct(_alike(pa, pb).alias("p"), _alike(F.reverse(pa), F.reverse(pb)).alias("q")), lambda both: apart(pa, pb, both, most)))

    def apart(pa: Column, pb: Column, both: Column, most: Column) -> Column:
        # What both begin and end with is left out, but for a word each, so that the blank between words is counted.
        p = F.greatest(both["p"] - 1, F.lit(0))
        q = F.greatest(F.least(both["q"], F.least(F.size(pa), F.size(pb)) - p) - 1, F.lit(0))
        ra, rb = (F.array_join(F.slice(x, p + 1, F.size(x) - p - q), " ") for x in (pa, pb))
        return F.call_function("levenshtein", ra, rb, most) >= 0  # below zero beyond the limit

    return _with(F.struct(F.split(a, " ").alias("pa"), F.split(b, " ").alias("pb"), most.alias("most")), linked)


def _linked_in_cells(spark: SparkSession, rows: DataFrame, lines: DataFrame, possible: Possible, similarity: float) -> DataFrame:
    """(a, b, linked): the linked pairs of rows (key, id, hub_id, part) that share a key but no part, none of them its hub.

    The rows of a key are dealt into blocks. Those outside the key's largest part go to every block; only they need to be compared
    with all others, and no task gets all pairs of a key. The lines are compared where they meet; no pair is stored, or moved to its texts.
    Of the keys that two rows share the first makes the pair.
    """
    rows = rows.where("id != hub_id")
    parts = rows.groupBy("key", "part").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("most"))
    blocks = written(spark, parts.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.col("most.part").alias("largest")), "blocks")
    each = rows.groupBy("id").agg(F.collect_set("key").alias("keys"), F.first("part").alias("part"))
    own = lines.join(small_side(written(spark, each, "open-lines")), "id").withColumn("key", F.explode("keys")).join(small_side(blocks), "key")
    own = own.select("key", "id", "part", "keys", F.struct("size", "counts").alias("info"), "norm", "blocks", (F.col("part") != F.col("largest")).alias("outside"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but long to compare
    x = own.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).repartition(n, "key", "block").alias("x")
    y = own.where("outside").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).repartition(n, "key", "block").alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.block") == F.col("y.block")) & (F.col("x.part") != F.col("y.part"))
    meet &= ~F.col("x.outside") | (F.col("x.id") > F.col("y.id"))
    meet &= possible(F.col("x.info"), F.col("y.info")) & (F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key"))
    meet &= _similar(F.col("x.norm"), F.col("y.norm"), similarity)
    ids = F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")
    return x.join(y, meet).select(*ids, F.lit(True).alias("linked"))


def removals(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, removed): numbers of the lines that go, sorted, for documents that lose any.

    Lines without words always stay. Lines of fewer than `min_words` words, or characters in scripts without blanks, go only
    if they repeat one exactly. Of lines that repeat or nearly repeat, the one of the smallest doc_id, then the first there, stays. Null and empty texts and rows without a doc_id lose
    nothing; rows that repeat a doc_id and text lose the same lines.
    """
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = written(spark, _signed(texts, min_words), "lines")
    distinct = every.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at", "k1")).alias("id"), F.first("size").alias("size"), F.first("minima").alias("minima"))
    distinct = written(spark, distinct, "distinct-lines")

    def possible(a: Column, b: Column) -> Column:
        most = _most(a["size"], b["size"], similarity)  # each edit changes the length by one at most
        return (F.abs(a["size"] - b["size"]) <= most) & F.coalesce(_counts_apart(a["counts"], b["counts"]) <= most, F.lit(True))

    # The line that occurs most often is the hub: it is the likeliest to be the one that others were made from.
    info = F.struct("n", "size", F.lit(None).cast("array<int>").alias("counts")).alias("info")
    keyed = distinct.where("minima is not null").select("id", info, F.explode(_bucket_keys(F.col("minima"))).alias("key"))
    buckets = crowded(spark, keyed, first=lambda info: -info["n"])
    # Only rows that may be compared are worth their text: near to the hub, or in a bucket of three or more.
    worth = buckets.where((F.col("size") > 2) | ((F.col("id") != F.col("hub.id")) & possible(F.col("info"), F.col("hub.info"))))
    worth = worth.select("id").unionByName(worth.select("hub.id")).distinct()
    wanted = written(spark, worth.select("id.doc_id", "id.at", "id.k1"), "wanted-lines")
    holding = texts.join(small_side(written(spark, wanted.select("doc_id").distinct(), "wanted-docs")), "doc_id", "left_semi")
    own = _with_words(_lines(holding).join(small_side(wanted), ["doc_id", "at"]))
    lines = own.where(F.xxhash64("words") == F.col("k1")).select(F.struct("doc_id", "at", "k1").alias("id"), F.array_join("words", " ").alias("norm"))
    lines = lines.dropDuplicates(["id"]).select("id", "norm", F.length("norm").alias("size"), _counts(F.col("norm")).alias("counts"))
    lines = written(spark, lines, "candidate-lines")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = written(spark, pairs.select("a", "b"), "pairs")
        left = lines.select(F.col("id").alias("a"), F.col("norm").alias("norm_a"), F.struct("size", "counts").alias("x")).join(small_side(pairs), "a")
        both = left.join(lines.select(F.col("id").alias("b"), F.col("norm").alias("norm_b"), F.struct("size", "counts").alias("y")), "b")
        both = both.where(possible(F.col("x"), F.col("y"))).select("a", "b", "norm_a", "norm_b")
        both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "a", "b")  # few bytes, but long to compare
        return both.select("a", "b", _similar(F.col("norm_a"), F.col("norm_b"), similarity).alias("linked"))

    parts = star_components(spark, buckets, possible, verify, across=lambda rows, _: _linked_in_cells(spark, rows, lines, possible, similarity))
    groups = distinct.join(parts.withColumnRenamed("node", "id"), "id", "left").where("n > 1 or component is not null")
    groups = groups.select("k1", "k2", F.coalesce("component", "id").alias("stays"))
    gone = every.join(groups, ["k1", "k2"]).where(F.struct("doc_id", "at", "k1") != F.col("stays"))
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("at")).alias("removed"))


def line_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: how many of its lines go, and their numbers from 0, comma-joined."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(removals(spark, docs), "doc_id", "left")
    numbers = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.select("doc_id", F.size(numbers).cast("long").alias("n_removed"), F.array_join(numbers, ",").alias("removed_lines"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without the lines that go; all columns are kept, and n_chars, if there, follows a changed text."""
    gone = written(spark, removals(spark, docs), "removals")
    if (gone.agg(F.sum(F.size("removed"))).first()[0] or 0) <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    at, removed, lines = (unused(docs, x) for x in ("of", "removed", "lines"))
    gone = gone.withColumnsRenamed({"doc_id": at, "removed": removed})
    rows = docs.join(gone, F.col("doc_id") == F.col(at), "left").withColumn(lines, F.when(F.col(at).isNotNull(), F.split("text", "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    text = F.array_join(F.transform(kept, lambda k: F.get(F.col(lines), k)), "\n")
    rows = rows.withColumn("text", F.when(F.col(at).isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col(at).isNull(), F.col("n_chars")).otherwise(size))
    return rows.select(docs.columns)
