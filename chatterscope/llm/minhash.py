"""Near-duplicates by one-permutation hashing, banded buckets and star-shaped candidates, confirmed on full sets.

1. A task hashes each text's shingles once. The smallest hash in each of `BINS` equal ranges is the signature; an empty
   range borrows the value of a filled one, found in an order of its own (optimal densification). Texts with the same
   set are one class from here on.
2. Bands of the signature are bucket keys. In a bucket every class is compared with one hub only, so a bucket of n
   classes gives n - 1 candidates. Candidates are confirmed on full sets.
3. A bucket whose classes are in several components after that may still hide a link between two that are no hubs.
   Its classes are written as differences from one centre, the class nearest to what all of them share. A class linked
   with the centre needs no other link to its like. One that is not differs from it by so much that a linked class must have
   a good part of this difference too; prefixes of the differences, rarest shingles first, find all of these.

At a similarity of 0.8, five rows in a band and 32 bands miss a pair with probability 3e-6, at 0.85 with 7e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import BLANK_WORDS, mix64, split_words, text_bytes, text_slices
from chatterscope.llm.scratch import small_side, written
from chatterscope.llm.stars import crowded, pairs_of, star_components

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
SHINGLE, PERCENT = 5, 80

SIGNATURES = "doc_id long, n_shingles long, set_hi long, set_lo long, bands array<long>"
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


def _word_hashes(values: pa.BinaryArray) -> np.ndarray:
    coded = values.dictionary_encode()
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return own[coded.indices.to_numpy()]


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one text after the other, and where each text's begin and end.

    A text with fewer words than a shingle has its whole sequence as one; one without words has none.
    """
    words = split_words(*text_bytes(texts), BLANK_WORDS)
    n = len(words.per_text)
    hashes = _word_hashes(words.values)
    mixed = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        mixed += mix64(hashes[k : k + len(mixed)] + np.uint64(_ODD[k % 8])) * np.uint64(_ODD[(k + 3) % 8] | 1)
    mixed = mix64(mixed)
    edges = np.concatenate([[0], np.cumsum(words.per_text)])
    sets = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(mixed[a : b - size + 1]))
        elif b > a:
            sets.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]) if n else np.zeros(1, np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), cuts


def _set_hashes(sets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = sets.view(np.uint8)
    whole = b"".join(xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    both = np.frombuffer(whole, np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _orders(bins: int) -> np.ndarray:
    """For each range, all ranges in an order of its own."""
    at = np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins)
    return np.argsort(mix64(at + np.uint64(0x51_7CC1B727220A95)), axis=1)


def signatures(sets: np.ndarray, cuts: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """One row of densified minima per text; texts without shingles have a row of zeros."""
    bins, n = len(orders), len(cuts) - 1
    out, filled = np.zeros((n, bins), np.uint64), np.zeros((n, bins), bool)
    if len(sets):
        text = np.repeat(np.arange(n), np.diff(cuts))
        place = text * bins + ((sets >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))  # sorted: the first in a range is least
        out.reshape(-1)[place[head]] = sets[head]
        filled.reshape(-1)[place[head]] = True
    rows, empty = np.nonzero(~filled & (np.diff(cuts) > 0)[:, None])
    for attempt in range(bins):
        if not len(rows):
            break
        source = orders[empty, attempt]
        hit = filled[rows, source]
        out[rows[hit], empty[hit]] = out[rows[hit], source[hit]]
        rows, empty = rows[~hit], empty[~hit]
    return out


def signature_rows(docs: DataFrame, shingle: int, bands: int = BANDS, rows_in_band: int = ROWS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(bands * rows_in_band)
        salt = mix64(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_ODD[0]))
        for rows in text_slices(batches):
            sets, cuts = shingle_sets(rows.column("text"), shingle)
            sig = signatures(sets, cuts, orders).reshape(rows.num_rows, bands, rows_in_band)
            keys = np.broadcast_to(salt, sig.shape[:2]).copy()
            for k in range(rows_in_band):
                keys = mix64(keys * np.uint64(_ODD[1]) + sig[:, :, k])
            hi, lo = _set_hashes(sets, cuts)
            flat = pa.array(keys.reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(cuts)), pa.array(hi), pa.array(lo), lists], [x.split()[0] for x in SIGNATURES.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SIGNATURES)


def set_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, set_hi, set_lo, shingles) of each document, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches):
            sets, cuts = shingle_sets(rows.column("text"), shingle)
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column("id"), *map(pa.array, _set_hashes(sets, cuts)), lists], ["id", "set_hi", "set_lo", "shingles"])

    return docs.select("id", "text").mapInArrow(run, "id long, set_hi long, set_lo long, shingles array<long>")


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Whether sets can be similar enough, by their sizes `n` and how many of their shingles `common` another may have."""
    most = F.least(a["common"], b["common"])
    return (100 + percent) * most >= percent * (a["n"] + b["n"])


def _shared_shingles(spark: SparkSession, ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, info) by the ids' own shingles: those that no other of them has can't be common."""
    own = sets.join(small_side(written(spark, ids, "open-ids")), "id").select("id", F.size("shingles").cast("long").alias("n"), "shingles")
    single = own.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("times"), F.min("id").alias("id"))
    single = single.where("times = 1").groupBy("id").agg(F.count("*").alias("single"))
    return own.join(single, "id", "left").select("id", F.struct("n", (F.col("n") - F.coalesce("single", F.lit(0))).alias("common")).alias("info"))


def _differences(spark: SparkSession, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows with the shingles that they alone or their centre alone have, and the centre's number of shingles."""
    apart = F.concat(F.array_except("shingles", "_centre"), F.array_except("_centre", "shingles"))
    centres = sets.join(small_side(written(spark, rows.select(F.col("other.id").alias("id")).distinct(), "centres")), "id", "left_semi")
    own = sets.join(small_side(rows.where(F.col("id") != F.col("other.id"))), "id")
    both = own.join(centres.select(F.col("id").alias("_c"), F.col("shingles").alias("_centre")).hint("merge"), F.col("other.id") == F.col("_c"))
    return both.select("id", "info", "part", "other", F.col("info.n").alias("n"), F.size("_centre").cast("long").alias("m"), apart.alias("apart"))


def _nearby(spark: SparkSession, rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, info, other): the pairs that may be linked, of rows that have a centre (`other`) in common, with those linked with it.

    With n and m shingles and d in the difference, rows are linked if (100 + percent) * d <= (100 - percent) * (n + m). The differences
    from a common centre of two rows then share at least t shingles, 2 * (100 + percent) * t >= W by `least`. In any fixed order of all
    shingles one of these stands, in both, where t or more are left. Shingles of one row or one component alone come first, then the
    rarest. A row outside, which is not linked with the centre, makes t at least 1, and large enough against any row to look it up by a
    part of that row's difference.
    """
    plus, minus = 100 + percent, 100 - percent
    rows = written(spark, rows, "centred")
    apart = _differences(spark, rows, sets).withColumn("d", F.size("apart").cast("long"))
    apart = written(spark, apart.withColumn("outside", plus * F.col("d") > minus * (F.col("n") + F.col("m"))), "apart")
    linked = apart.where(~F.col("outside") & (F.col("part") != F.col("other.part"))).select("id", "info", F.struct("other.id", "other.info").alias("other"))

    each = apart.select(F.col("other.id").alias("centre"), "id", "info", "part", "n", "m", "d", "outside", F.explode("apart").alias("s"))
    times = each.groupBy("centre", "s").agg(F.count("*").alias("times"), F.min("part").alias("low"), F.max("part").alias("high"), F.max("outside").alias("any"))
    times = written(spark, times.where("any and low < high").select("centre", "s", "times"), "times")
    own = ["centre", "id", "info", "part", "n", "m", "d", "outside"]
    ordered = each.join(small_side(times), ["centre", "s"]).groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("times", "s"))).alias("_all"))
    placed = ordered.select(*own, F.size("_all").alias("_size"), F.posexplode("_all").alias("_at", "_e"))
    placed = written(spark, placed.select(*own, F.col("_e.s").alias("s"), (F.col("_size") - F.col("_at")).cast("long").alias("left")), "placed")

    x = placed.where(2 * plus * F.col("left") > plus * F.col("d") + minus * (F.col("m") - F.col("n"))).alias("x")
    y = placed.where("outside").alias("y")
    least = plus * (F.col("x.d") + F.col("y.d")) - minus * (F.col("x.n") + F.col("y.n"))
    meet = (F.col("x.centre") == F.col("y.centre")) & (F.col("x.s") == F.col("y.s")) & (F.col("x.part") != F.col("y.part"))
    meet &= (~F.col("x.outside") | (F.col("x.id") > F.col("y.id"))) & (2 * plus * F.least("x.left", "y.left") >= least)
    pairs = x.join(y, meet).select("x.id", "x.info", F.struct("y.id", "y.info").alias("other"))
    return linked.unionByName(pairs)


def _compared(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with their distance and whether they are linked, by the full sets.

    Sets of `a` come to the pairs where they lie. Only these rows move, to their `b`, the hub of many pairs; Spark splits its join.
    """
    pairs = written(spark, pairs, "pairs")
    hubs = written(spark, pairs.select(F.col("b").alias("id")).distinct(), "pair-hubs")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a")).join(small_side(pairs), "a")
    right = sets.join(small_side(hubs), "id", "left_semi").select(F.col("id").alias("b"), F.col("shingles").alias("_b"))
    both = left.join(right.hint("merge"), "b")
    sized = both.select("a", "b", F.size(F.array_intersect("_a", "_b")).alias("same"), (F.col("info_a.n") + F.col("info_b.n")).alias("total"))
    union = F.col("total") - F.col("same")
    return sized.select("a", "b", (100 * F.col("same") >= percent * union).alias("linked"))


def _centred(spark: SparkSession, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, info, part, other): rows of open buckets with a centre, the text nearest to what all of a bucket share."""
    tight = written(spark, _shared_shingles(spark, rows.select("id").distinct(), sets), "tighter")
    rows = written(spark, rows.drop("info").join(small_side(tight), "id"), "tight-rows")
    order = -F.col("info.common") / F.col("info.n")
    centres = rows.groupBy("key").agg(F.min(F.struct(order.alias("order"), "id", "info", "part")).alias("other"))
    rows = written(spark, rows.join(small_side(written(spark, centres, "second-hubs")), "key"), "open")
    return rows.select("id", "info", "part", "other").distinct()


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows_in_band: int = ROWS
) -> DataFrame:
    """One row per document: n_shingles, component_id (the smallest doc_id reachable by links) and kept (it is its own).

    Documents are linked if 100 * intersection >= percent * union of their sets of shingles. Null and empty texts, and
    texts of blanks, have no shingles and are linked with nothing. Rows that repeat a doc_id are one node if their sets
    are the same, and each is reported. An empty table gives no rows. Only doc_id and text are read.
    """
    signed = written(spark, signature_rows(docs, shingle, bands, rows_in_band), "signatures")
    same = ["set_hi", "set_lo"]
    # Should a doc_id come with several texts, the one of the least set is the node.
    full = signed.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*same, "n_shingles")).alias("s"), F.count("*").alias("times"))
    full = full.select("doc_id", "s.*", "times")
    classes = full.groupBy(*same).agg(F.min(F.struct("doc_id", "n_shingles", "times")).alias("c"))
    classes = classes.select(*same, F.col("c.doc_id").alias("id"), F.col("c.n_shingles").alias("n"), F.col("c.times").alias("times"))
    classes = written(spark, classes, "classes")
    member = full.join(classes, same).select("doc_id", "id")

    keyed = signed.join(classes.select(F.col("id").alias("doc_id"), "n", *same), ["doc_id", *same]).dropDuplicates(["doc_id"])
    sizes = F.struct("n", F.col("n").alias("common")).alias("info")
    buckets = crowded(spark, keyed.select(F.col("doc_id").alias("id"), sizes, F.explode("bands").alias("key")))
    # Texts stay where they are, unless those in shared buckets are too many to be broadcast by their ids.
    everyone = written(spark, classes.join(buckets.select("id").distinct(), "id").select("id", *same, "times"), "sharing")
    texts = docs.selectExpr("cast(doc_id as long) id", "text").join(small_side(everyone.select("id")), "id", "left_semi")
    sets = written(spark, set_rows(texts, shingle).join(small_side(everyone), ["id", *same]).select("id", "shingles", "times"), "sets")
    repeated = sets.where("times > 1").dropDuplicates(["id"])
    sets = sets.where("times = 1").unionByName(repeated).select("id", "shingles")

    may = lambda a, b: _may_link(a, b, percent)
    verify = lambda pairs: _compared(spark, pairs, sets, percent)

    def across(rows: DataFrame, done: DataFrame) -> DataFrame:
        near = _nearby(spark, _centred(spark, rows, sets), sets, percent)
        pairs = pairs_of(near, F.struct("id", "info"), F.struct("other.id", "other.info"), may)
        return verify(pairs.join(done, ["a", "b"], "left_anti"))

    parts = star_components(spark, buckets, may, verify, across=across)
    found = member.join(parts.withColumnRenamed("node", "id"), "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    rows = signed.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce(component, "doc_id").alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
