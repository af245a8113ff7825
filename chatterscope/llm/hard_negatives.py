"""Hard negatives by exact inner-product search with one shared list per cluster of anchors.

1. Spherical k-means on a bounded sample of the anchors gives centroids; each anchor joins the nearest. A cluster knows the
   largest angle between its centroid and a member.
2. A row at an angle t to the centroid has an inner product of at most |row| |anchor| cos(t - that angle) with any member.
   In each batch of rows, a cluster sorts the rows by this bound once, and all its members walk that list in steps.
   A member stops once the bound falls below the last place that it still has to fill: no later row can count.
3. Tasks keep the best rows of each anchor over all their batches; their lists are merged by anchor.

The first search finds the positives, the second the negatives below each. Anchors go through in blocks, one at a time;
the rows are scanned in place and never moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.scratch import written
from chatterscope.operators.toplists import top_n_per_group
from chatterscope.session import scratch_dir

#: Clusters, the anchors they are fitted on, members that share a list, lists in a block of anchors, rows walked at a time.
CLUSTERS, SAMPLE_ANCHORS, MEMBERS, LISTS, STEP = 16, 4_096, 512, 16, 1_024
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80
NONE = np.iinfo(np.int64).max


class Group(NamedTuple):
    """Anchors of one cluster that share a list: where they lie in their block, and the cosine and sine of their spread."""

    members: slice
    centre: np.ndarray
    cos: float
    sin: float


class Block(NamedTuple):
    """A bounded number of anchors, ordered by cluster."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    groups: list[Group]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """One row per list; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def spherical_means(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of the vectors' directions; at most as many as there are distinct directions to begin with."""
    units = _unit(vectors)
    start = np.unique(units.round(9), axis=0)
    centres = start[np.linspace(0, len(start) - 1, min(clusters, len(start))).astype(int)]
    for _ in range(rounds):
        own = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        moved = _unit(sums)
        centres = np.where(np.any(moved != 0, axis=1, keepdims=True), moved, centres)
    return centres


def anchor_block(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, clusters: np.ndarray, lists: np.ndarray, centres: np.ndarray) -> Block:
    """Anchors in the order of their lists; each list's spread is that of its own members."""
    order = np.lexsort((ids, lists, clusters))
    ids, labels, vectors, clusters, lists = (x[order] for x in (ids, labels, vectors, clusters, lists))
    changed = (clusters[1:] != clusters[:-1]) | (lists[1:] != lists[:-1])
    edges = [*np.flatnonzero(np.concatenate([[True], changed])).tolist(), len(ids)] if len(ids) else [0]
    groups = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        cos = float(np.clip((_unit(vectors[a:b]) @ centres[clusters[a]]).min(), -1, 1))
        groups.append(Group(slice(a, b), centres[clusters[a]], cos, float(np.sqrt(1 - cos * cos))))
    return Block(ids, labels, vectors, groups)


def bounds(rows: np.ndarray, group: Group) -> np.ndarray:
    """For each row, no less than its inner product with a member of the group divided by the member's norm."""
    norms = np.linalg.norm(rows, axis=1)
    along = rows @ group.centre
    across = np.sqrt(np.maximum(norms * norms - along * along, 0))
    # Within the spread the angle may be zero; beyond it, cos(t - spread).
    return np.where(along >= norms * group.cos, norms, along * group.cos + across * group.sin)


class Best:
    """The best `k` (score, id) of each slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int):
        self.scores, self.ids = np.full((slots, k), -np.inf), np.full((slots, k), NONE)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = (score > self.scores[slot, -1]) | ((score == self.scores[slot, -1]) & (ids < self.ids[slot, -1]))
        slot, score, ids = slot[better], score[better], ids[better]
        if not len(slot):
            return
        k = self.scores.shape[1]
        touched = np.unique(slot)
        slot = np.concatenate([slot, np.repeat(touched, k)])
        score, ids = np.concatenate([score, self.scores[touched].reshape(-1)]), np.concatenate([ids, self.ids[touched].reshape(-1)])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.repeat(np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])), np.unique(slot, return_counts=True)[1])
        top = place < k
        self.scores[slot[top], place[top]], self.ids[slot[top], place[top]] = score[top], ids[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all places filled."""
        slot, place = np.nonzero(self.ids != NONE)
        return slot, self.scores[slot, place].astype(np.int64), self.ids[slot, place]


#: Tells which (member, row) pairs count and hands them on; from members, their scores with some rows, the rows' labels and ids.
Offer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]


def walk(block: Block, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, needed: Callable[[np.ndarray], np.ndarray], offer: Offer) -> int:
    """Shows each member the rows of its list until its bound is below what it needs. Returns the number of scores worked out."""
    looked = 0
    for group in block.groups:
        bound = bounds(vectors, group)
        order = np.lexsort((ids, -bound))
        bound = bound[order] * (1 + 1e-9) + 1e-6  # rounding of the bound must not end a walk
        members = np.arange(group.members.start, group.members.stop)
        norms = np.linalg.norm(block.vectors[group.members].astype(np.float64), axis=1)
        for at in range(0, len(order), STEP):
            going = norms * bound[at] >= needed(members)
            members, norms = members[going], norms[going]
            if not len(members):
                break
            part = order[at : at + STEP]
            offer(members, block.vectors[members] @ vectors[part].T, labels[part], ids[part])
            looked += len(members) * len(part)
    return looked


def positives_of(block: Block, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> Best:
    """For each anchor the best other rows of its label among batches of (vectors, labels, ids)."""
    best = Best(len(block.ids), k)

    def offer(members: np.ndarray, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        counts = scores >= best.scores[members, -1][:, None]
        m, r = np.nonzero(counts & (block.labels[members][:, None] == labels) & (block.ids[members][:, None] != ids))
        best.offer(members[m], scores[m, r].astype(np.float64), ids[r])

    for vectors, labels, ids in batches:
        walk(block, vectors, labels, ids, lambda members: best.scores[members, -1], offer)
    return best


def negatives_of(block: Block, positives: np.ndarray, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, percent: int) -> Best:
    """For each anchor and positive score (a row of scores, NaN where there are fewer) the best rows of other labels that
    score at least so many percent of it and no more than it. Slots are numbered anchor by anchor."""
    width = positives.shape[1]
    best = Best(positives.size, k)
    whole = np.nan_to_num(positives).astype(np.int64)
    least = -((-percent * whole) // 100)
    least = np.where(np.isnan(positives) | (least > whole), np.inf, least)

    def lowest(members: np.ndarray) -> np.ndarray:
        return np.maximum(least[members], best.scores[:, -1].reshape(-1, width)[members])

    def offer(members: np.ndarray, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        low = lowest(members)
        high = np.where(np.isfinite(least[members]), positives[members], -np.inf).max(axis=1)
        m, r = np.nonzero((scores >= low.min(axis=1)[:, None]) & (scores <= high[:, None]) & (block.labels[members][:, None] != labels))
        own = scores[m, r].astype(np.float64)
        for j in range(width):
            fits = (own >= low[m, j]) & (own <= positives[members[m], j])
            best.offer(members[m[fits]] * width + j, own[fits], ids[r[fits]])

    for vectors, labels, ids in batches:
        walk(block, vectors, labels, ids, lambda members: lowest(members).min(axis=1), offer)
    return best


def _batches(found: Iterator[pa.RecordBatch], width: int, dtype: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in found:
        if batch.num_rows:
            yield matrix(batch.column("vector"), width).astype(dtype), batch.column("label").to_numpy(), batch.column("vec_id").to_numpy()


def _anchors(spark: SparkSession, anchors: DataFrame, width: int) -> tuple[DataFrame, np.ndarray, int]:
    """Stored anchors with their cluster, list and block, the centroids, and the number of blocks."""
    anchors = written(spark, anchors.distinct(), "anchors")
    sample = anchors.orderBy(F.xxhash64("vec_id", "label", "vector")).limit(SAMPLE_ANCHORS).select("vector").toArrow()
    centres = spherical_means(matrix(sample.column(0).combine_chunks(), width), CLUSTERS)
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.argmax(_unit(matrix(batch.column("vector"), width)) @ shared.value.T, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "cluster"])

    placed = written(spark, anchors.mapInArrow(assign, "vec_id long, label long, vector array<double>, cluster int"), "anchor-clusters")
    sizes = {r.cluster: r.n for r in placed.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    lists, first = {}, {}
    for c, n in sorted(sizes.items()):
        first[c], lists[c] = sum(lists.values()), -(-n // MEMBERS)

    def of(values: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for item in sorted(values.items()) for x in item]), F.col("cluster"))

    own = of(first) + F.pmod(F.xxhash64("vec_id", "label", "vector"), of(lists))
    placed = placed.withColumn("list", own).withColumn("part", F.floor(F.col("list") / LISTS))
    return placed, centres, -(-sum(lists.values()) // LISTS)


def hard_negatives(
    spark: SparkSession, rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = LEAST_PERCENT
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, vector).

    Vectors hold whole numbers as doubles; inner products must stay below 2**53 and shorter vectors end in zeros. An anchor's positives are the
    best other ids of its label, the negatives of each are the best rows of other labels with a score between `percent` of the positive's and the whole. Higher scores come
    first, ties by smaller id. Rows with a null id, label or vector, or a null or non-finite number in it, take no part. Anchors that repeat
    one count once; other repeated rows count each. Further columns are ignored; an empty table and anchors without positives or negatives give no rows.
    """
    whole = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id is not null and label is not null and vector is not null").where(~whole)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    width, largest = rows.agg(F.max(F.size("vector")), F.max(square)).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if width is None or rows.where(is_anchor).isEmpty():
        return spark.createDataFrame([], schema)
    width = max(1, width)
    # Below 2**24 all partial sums of an inner product are exact in single precision too.
    dtype = np.float32 if largest < 2**24 else np.float64
    placed, centres, parts = _anchors(spark, rows.where(is_anchor), width)
    path = scratch_dir(spark, "hard-negatives")
    for p in range(parts):
        found = _search(spark, rows, placed.where(F.col("part") == p), centres, width, dtype, positives, negatives, percent)
        found.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _search(spark: SparkSession, rows: DataFrame, anchors: DataFrame, centres: np.ndarray, width: int, dtype: type, positives: int, negatives: int, percent: int) -> DataFrame:
    """Both searches for one block of anchors, whose number is bounded by `LISTS` times `MEMBERS`, more or less."""
    own = anchors.toArrow().combine_chunks()
    get = lambda name: own.column(name).combine_chunks()
    block = anchor_block(*(get(c).to_numpy() for c in ("vec_id", "label")), matrix(get("vector"), width).astype(dtype), *(get(c).to_numpy() for c in ("cluster", "list")), centres)
    shared = spark.sparkContext.broadcast(block)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, score, ids = positives_of(shared.value, _batches(batches, width, dtype), positives).rows()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, score, ids)], ["slot", "score", "id"])

    order = [F.desc("score"), F.col("id")]
    best = top_n_per_group(rows.mapInArrow(near, "slot long, score long, id long"), ["slot"], order, positives)
    best = written(spark, best.withColumnRenamed("slot", "anchor"), "positives")
    scores = np.full((len(block.ids), positives), np.nan)
    for r in best.collect():  # `positives` per anchor of the block
        scores[r.anchor, r.rank - 1] = r.score
    limits = spark.sparkContext.broadcast(scores)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = negatives_of(shared.value, limits.value, _batches(batches, width, dtype), negatives, percent)
        slot, score, ids = found.rows()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, score, ids)], ["slot", "score", "id"])

    hard = top_n_per_group(rows.mapInArrow(below, "slot long, score long, id long"), ["slot"], order, negatives)
    hard = hard.select((F.expr(f"slot div {positives}")).alias("anchor"), (F.col("slot") % positives + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = spark.createDataFrame(pa.table({"anchor": np.arange(len(block.ids)), "anchor_id": block.ids}))
    to = best.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = hard.join(F.broadcast(to), ["anchor", "place"]).join(F.broadcast(names), "anchor")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
