"""SimHash near-duplicates by anchor points: a covering code as the places where fingerprints meet.

1. A task hashes each text's shingles and takes the majority of each bit. Equal fingerprints are one from here on.
2. The 64 bits are two halves. Fingerprints that differ in 4 bits at most differ in 2 of the first half at most, or in 1
   of the second (3 + 2 > 4). The anchors of a half are a covering code of it: the Hamming code of 31 bits, whose
   covering radius is 1, with the last bit free. Each fingerprint's home is the one anchor within 1. It is replicated to
   every anchor within covering radius plus threshold, so it meets all linked ones at their homes.
3. Per anchor, those at home are compared with all that came. Anchors that are nobody's home drop out
   before rows move; those with many rows are dealt in blocks of both sides, which stay exact. Each task hands on a
   spanning forest of the links it finds, never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import BLANK_WORDS, split_words, text_bytes, text_slices
from chatterscope.llm.components import components
from chatterscope.llm.scratch import small_side, written

SHINGLE, THRESHOLD, SEED = 4, 4, 42

#: An anchor with more rows than this is dealt in blocks, of so many rows each at most on average.
BLOCK_ROWS = 8_192
#: Pairs that a task compares at a time.
PAIRS = 1 << 21


class Half(NamedTuple):
    """Bits from `shift` on, and the largest difference in them that this half answers for."""

    shift: int
    threshold: int


#: Linked fingerprints are within the threshold of one half at least: (2 + 1) + (1 + 1) > THRESHOLD.
HALVES = (Half(0, 2), Half(32, 1))
CHECKS = 5
CODED = (1 << CHECKS) - 1


def _syndrome(x: np.ndarray) -> np.ndarray:
    """The exclusive or of the numbers, from 1, of the coded bits that are set: 0 for a code word, else the bit to flip."""
    out = np.zeros(x.shape, np.uint64)
    for k in range(CHECKS):
        mask = sum(1 << (i - 1) for i in range(1, CODED + 1) if i >> k & 1)
        out |= (np.bitwise_count(x & np.uint64(mask)).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    return out


def _errors(radius: int) -> list[np.ndarray]:
    """For each syndrome, the differences of at most so many of the 32 bits that lead from there to a code word."""
    masks = [sum(1 << b for b in bits) for w in range(radius + 1) for bits in combinations(range(CODED + 1), w)]
    every = np.array(masks, np.uint64)
    own = _syndrome(every)
    return [every[own == s] for s in range(CODED + 1)]


def homes(prints: np.ndarray, half: Half) -> np.ndarray:
    """The anchor within the covering radius of each fingerprint's half."""
    x = (prints >> np.uint64(half.shift)) & np.uint64(0xFFFFFFFF)
    s = _syndrome(x)
    return x ^ np.where(s > 0, np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1)), np.uint64(0))


def _tagged(anchors: np.ndarray, k: int) -> np.ndarray:
    """Keys that tell the halves' anchors apart."""
    return (anchors | np.uint64(k << 32)).view(np.int64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit hashes, repeats included; zero for none."""
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(texts: pa.Array, size: int) -> np.ndarray:
    """One fingerprint per text, over the XXH64 of its space-joined shingles of lower-case words.

    A text with fewer words than a shingle has its whole sequence as one; one without words has fingerprint zero.
    """
    words = split_words(*text_bytes(texts), BLANK_WORDS)
    joined = b" ".join(words.values.to_pylist())
    stop = np.cumsum(words.stop - words.start + 1) - 1  # of each word in the joined text
    start = stop - (words.stop - words.start)
    edges = np.concatenate([[0], np.cumsum(words.per_text)])
    out = np.zeros(len(texts), np.uint64)
    for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if b == a:
            continue
        last = max(a + 1, b - size + 1)
        begins, ends = start[a:last].tolist(), stop[min(a + size, b) - 1 : b].tolist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(begins, ends, strict=True)), np.uint64, last - a)
        out[k] = fingerprint(hashes)
    return out


def fingerprint_rows(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print) of each document; the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches):
            prints = fingerprints(rows.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(prints)], ["doc_id", "print"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, print long")


def _replicas(prints: DataFrame) -> DataFrame:
    """(key, print) of every anchor within covering radius plus threshold of a fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = [_errors(1 + half.threshold) for half in HALVES]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                for k, half in enumerate(HALVES):
                    x = (own >> np.uint64(half.shift)) & np.uint64(0xFFFFFFFF)
                    s = _syndrome(x)
                    for value in np.unique(s).tolist():
                        mine, masks = s == value, errors[k][value]
                        keys = _tagged((x[mine][:, None] ^ masks[None, :]).reshape(-1), k)
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(own[mine].view(np.int64), len(masks)))], ["key", "print"])

    return prints.select("print").mapInArrow(run, "key long, print long")


def _home_keys(prints: DataFrame) -> DataFrame:
    """(key, print) of the anchors that are some fingerprint's home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = np.concatenate([_tagged(homes(own, half), k) for k, half in enumerate(HALVES)])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(own.view(np.int64), len(HALVES)))], ["key", "print"])

    return prints.select("print").mapInArrow(run, "key long, print long")


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect the same values: each with the least that it reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[x], least[y])
        new = least.copy()
        for end in (x, y, least[x], least[y]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == least).all():
            break
        least = new
    linked = least != np.arange(len(nodes))
    return nodes[linked], nodes[least[linked]]


def _compared(left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between left[i] and right[low[i]:high[i]], as a spanning forest; some millions of pairs at a time."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    sizes = high - low
    upto = np.cumsum(sizes)
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        n = sizes[at:to]
        row = np.repeat(np.arange(at, to), n)
        col = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:to], n)
        x, y = left[row], right[col]
        near = (np.bitwise_count(x ^ y) <= THRESHOLD) & (x != y)
        if near.any():
            found.append(spanning_forest(x[near], y[near]))
        at = to
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return spanning_forest(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _links(dealt: DataFrame) -> DataFrame:
    """(a, b): links between fingerprints at home and those that came, of rows (key, block, home, print) sorted by key, block and home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: pa.Table) -> pa.RecordBatch:
            key, block, home, prints = (rows.column(c).to_numpy() for c in ("key", "block", "home", "print"))
            prints = prints.view(np.uint64)
            group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
            # Within a group the visitors come first.
            at_home = np.flatnonzero(home)
            low = np.searchsorted(group, group[at_home])
            high = np.searchsorted(group, group[at_home], side="right")
            visitors = high - np.bincount(group[at_home], minlength=int(group[-1]) + 1)[group[at_home]]
            a, b = _compared(prints[at_home], prints, low, visitors)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < 8 * BLOCK_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            key, block = rows.column("key").to_numpy(), rows.column("block").to_numpy()
            # The last group may go on in the next batch.
            whole = int(np.flatnonzero((key != key[-1]) | (block != block[-1]))[-1]) + 1 if (key != key[-1]).any() or (block != block[-1]).any() else 0
            if whole:
                yield linked(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield linked(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long")


def _dealt(spark: SparkSession, home: DataFrame, visits: DataFrame) -> DataFrame:
    """(key, block, home, print): rows of one anchor, or of a block of its homes and a block of its visitors, in one task each."""
    rows = home.withColumn("home", F.lit(True)).unionByName(visits.withColumn("home", F.lit(False)))
    sizes = rows.groupBy("key").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visits"))
    parts = lambda c: F.ceil(F.col(c) / BLOCK_ROWS).cast("int")
    many = sizes.where(F.greatest("homes", "visits") > BLOCK_ROWS).select("key", parts("homes").alias("rows"), parts("visits").alias("columns"))
    many = written(spark, many, "anchor-blocks")
    blocked = rows.join(small_side(many), "key", "left")
    own = F.pmod(F.xxhash64("print"), F.when(F.col("home"), F.col("rows")).otherwise(F.col("columns"))).cast("int")
    across = F.sequence(F.lit(0), F.when(F.col("home"), F.col("columns")).otherwise(F.col("rows")) - 1)
    number = F.transform(across, lambda o: F.when(F.col("home"), own * F.col("columns") + o).otherwise(o * F.col("columns") + own))
    blocks = F.when(F.col("rows").isNull(), F.array(F.lit(0))).otherwise(number)
    dealt = blocked.select("key", F.explode(blocks).alias("block"), "home", "print")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key", "block").sortWithinPartitions("key", "block", "home")


def simhash_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: its fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable by links.

    Fingerprints are linked if they differ in `THRESHOLD` bits at most, equal ones too. Null and empty texts and texts of
    blanks have fingerprint zero and are linked like any other. Repeated rows, and several texts under one doc_id, are reported one by one;
    rows without a doc_id link nothing and keep a null component_id unless others share or reach their fingerprint. An empty table gives no rows. Only
    doc_id and text are read.
    """
    signed = written(spark, fingerprint_rows(docs, shingle), "fingerprints")
    distinct = signed.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("id"))
    distinct = written(spark, distinct, "distinct-prints")
    home = written(spark, _home_keys(distinct), "homes")
    taken = small_side(written(spark, home.select("key").distinct(), "home-keys"))
    visits = written(spark, _replicas(distinct).join(taken, "key", "left_semi"), "visits")
    links = written(spark, _links(_dealt(spark, home, visits)), "print-links")
    ids = small_side(distinct)
    links = links.join(ids.select(F.col("print").alias("a"), F.col("id").alias("id_a")), "a")
    links = links.join(ids.select(F.col("print").alias("b"), F.col("id").alias("id_b")), "b")
    parts = components(spark, links.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    whole = distinct.join(parts.withColumnRenamed("node", "id"), "id", "left").select("print", F.coalesce("component", "id").alias("component_id"))
    whole = small_side(written(spark, whole, "print-components"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return signed.join(whole, "print", "left").select("doc_id", digits, "component_id")
