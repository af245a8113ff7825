"""Toxicity from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning.

Features are how words begin: their first bytes, up to eight, and short words whole; each once for a text that has it and
once more for one that has it twice. A bounded sample of confirmed and of unlabelled documents chooses those that
confirmed ones have more often, and a linear model over them minimises the risk of a classifier that knows no negatives:
the class prior times the positive risk, plus the unlabelled risk less the share that positives have in it, held above
zero. Scoring is one scan that looks every word up in a table; no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import ALNUM_WORDS, mix64, split_words, text_bytes, text_slices
from chatterscope.llm.language_id import held_out

#: The bounds of the sample: the documents of least hash, confirmed and of any kind; the features kept.
MAX_CONFIRMED, MAX_UNLABELLED, MAX_FEATURES = 3000, 9000, 3000
#: A feature must occur in so many confirmed documents, and of the documents that have it, so many should be toxic by the
#: prior and the sample.
MIN_CONFIRMED, MIN_SHARE = 3, 0.3
PREFIXES = (4, 5, 6, 7, 8)
BITS = 21
#: Codes, and as many features for codes that occur twice.
CODES = 2 << BITS
THRESHOLD = 0.7
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class Model(NamedTuple):
    """Hash buckets that count, their weights, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def word_codes(data: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash codes of word beginnings and the text of each, one kind of beginning after the other."""
    words = split_words(data, edges, ALNUM_WORDS)
    size = words.stop - words.start
    norm = np.zeros(len(data) + 8, np.uint8)
    norm[: len(data)] = ALNUM_WORDS.becomes[data]
    eight = np.ndarray((len(data),), "<u8", norm.tobytes(), 0, (1,))[words.start]  # eight bytes from every word's first
    for n in PREFIXES:
        fits = size >= n
        yield words.text[fits], _hashed(eight[fits] & np.uint64((1 << 8 * n) - 1), n)
    short = size < 8
    bits = (8 * size[short]).astype(np.uint64)
    yield words.text[short], _hashed(eight[short] & ((np.uint64(1) << bits) - np.uint64(1)), 0)


def _hashed(x: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(x + np.uint64(0x9E3779B97F4A7C15 * (kind + 1) % 2**64)) >> np.uint64(64 - BITS)).astype(np.int64)


def feature_pairs(text: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Sorted text * CODES + feature: each code of a text, and a second feature for codes that it has more than once."""
    pairs, times = np.unique(text * CODES + code, return_counts=True)
    twice = pairs[times > 1]
    return np.sort(np.concatenate([pairs, twice + (1 << BITS)]))


def all_features(texts: pa.Array) -> np.ndarray:
    parts = list(word_codes(*text_bytes(texts)))
    return feature_pairs(np.concatenate([t for t, _ in parts]), np.concatenate([c for _, c in parts]))


def fit(row: np.ndarray, feature: np.ndarray, n_confirmed: int, n_unlabelled: int, n_features: int, prior: float, steps: int = 300, rate: float = 0.05, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias with the least non-negative risk, logistic loss, by Adam over the whole sample.

    row, feature: the features that are present; rows are confirmed documents, then unlabelled ones. Where the risk on
    negatives falls below zero, the step undoes that alone.
    """
    n = n_confirmed + n_unlabelled
    w, first, second, mean = (np.zeros(n_features + 1) for _ in range(4))
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[feature], minlength=n) + w[-1]
        up = 1 / (1 + np.exp(-np.clip(z, -30, 30)))  # slope of the loss as a negative; less one, as a positive
        loss = np.logaddexp(0, z)
        negative = loss[n_confirmed:].mean() - prior * loss[:n_confirmed].mean()
        g = np.empty_like(z)
        if negative >= 0:
            g[:n_confirmed] = -prior / n_confirmed
            g[n_confirmed:] = up[n_confirmed:] / n_unlabelled
        else:
            g[:n_confirmed] = prior * up[:n_confirmed] / n_confirmed
            g[n_confirmed:] = -up[n_confirmed:] / n_unlabelled
        step = np.append(np.bincount(feature, weights=g[row], minlength=n_features), g.sum()) + decay * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * step, 0.999 * second + 0.001 * step**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        mean += w * (2 * t > steps) / (steps - steps // 2)  # steps that undo overshoot average out
    return mean[:-1], float(mean[-1])


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model; None where no row that is not held out is confirmed toxic."""
    own = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = own.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    if not total[0] or not total[1]:
        return None
    prior = min(0.9, total[1] / total[0])
    number = F.xxhash64("doc_id")
    p = own.where("toxic = 1").orderBy(number, "doc_id").limit(MAX_CONFIRMED).select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u"))
    u = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    u = u.orderBy(number, "doc_id").limit(MAX_UNLABELLED).select("doc_id", F.lit(0).alias("p"), F.lit(1).alias("u"))
    wanted = p.unionByName(u).groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    sample = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("text", "p", "u")  # bounded by the two limits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, CODES), np.int64)
        rows_seen = np.zeros(2, np.int64)
        for rows in text_slices(batches):
            kinds = np.stack([rows.column(c).to_numpy() for c in ("p", "u")])
            pairs = all_features(rows.column("text"))
            for k in (0, 1):
                seen[k] += np.bincount(pairs % CODES, weights=kinds[k][pairs // CODES], minlength=CODES).astype(np.int64)
            rows_seen += kinds.sum(axis=1)
        at = np.flatnonzero(seen.any(axis=0))
        columns = [np.append(at, -1), np.append(seen[0, at], rows_seen[0]), np.append(seen[1, at], rows_seen[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "p", "u"])

    counts = sample.mapInArrow(count, "bucket long, p long, u long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    sizes = F.broadcast(counts.where("bucket = -1").select(F.col("p").alias("all_p"), F.col("u").alias("all_u")))  # one row
    rated = counts.where(f"bucket >= 0 and p >= {MIN_CONFIRMED}").join(sizes)
    ratio = ((F.col("p") + 0.5) / F.col("all_p")) / ((F.col("u") + 0.5) / F.col("all_u"))
    strong = rated.where(prior * ratio >= MIN_SHARE).select("bucket", (F.col("p") * F.ln(ratio)).alias("gain"))
    rows = strong.where("gain > 0").orderBy(F.desc("gain"), "bucket").limit(MAX_FEATURES).collect()
    buckets = np.array(sorted(r.bucket for r in rows), np.int64)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(buckets)
        for rows in text_slices(batches):
            matrix = np.zeros((rows.num_rows, len(buckets)), bool)
            pairs = all_features(rows.column("text"))
            feature = lookup[pairs % CODES]
            matrix[pairs[feature >= 0] // CODES, feature[feature >= 0]] = True
            bits = pa.array([np.packbits(row).tobytes() for row in matrix], pa.binary())
            yield pa.RecordBatch.from_arrays([bits, rows.column("p"), rows.column("u")], ["bits", "p", "u"])

    found = sample.mapInArrow(present, "bits binary, p int, u int").collect()
    if not len(buckets) or not any(r.p for r in found) or not any(r.u for r in found):
        return None
    found.sort(key=lambda r: (bytes(r.bits), r.p, r.u))  # sums in the same order however tasks end
    rows, sizes = [], []
    for kind in ("p", "u"):
        own = [r.bits for r in found if r[kind]]
        rows += own
        sizes.append(len(own))
    row, feature = np.nonzero(np.unpackbits(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1), axis=1, count=len(buckets)))
    return Model(buckets, *fit(row, feature, *sizes, len(buckets), prior))


def _lookup(buckets: np.ndarray) -> np.ndarray:
    out = np.full(CODES, -1, np.int16)
    out[buckets] = np.arange(len(buckets), dtype=np.int16)
    return out


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.lookup = model, _lookup(model.buckets)
        self.known = (self.lookup >= 0).reshape(2, -1).any(axis=0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Between 0 and 1 for every text; null and empty ones get the bias alone."""
        kept = [(t[own], c[own]) for t, c in word_codes(*text_bytes(texts)) for own in [self.known[c]]]
        pairs = feature_pairs(np.concatenate([t for t, _ in kept]), np.concatenate([c for _, c in kept]))
        feature = self.lookup[pairs % CODES]
        own = feature >= 0
        z = self.model.bias + np.bincount(pairs[own] // CODES, weights=self.model.weights[feature[own]], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_BUILT: dict[int, Scorer] = {}


def _scorer(spark: SparkSession, model: Model | None):
    """What tasks call for a scorer; built once in a Python worker. Without a model all scores are 0."""
    shared, key = spark.sparkContext.broadcast(model), hash(repr(model))

    def get(texts: pa.Array) -> np.ndarray:
        if shared.value is None:
            return np.zeros(len(texts))
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Scorer(shared.value)
        return _BUILT[key].scores(texts)

    return get


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: whether it was held out, its score, and 1 if that reaches the threshold.

    Null and empty texts have a score too; without any confirmed example all scores are 0. A doc_id that is labelled
    twice is toxic if any label says so. Repeated rows are scored one by one; an empty table gives no rows. Only doc_id,
    text and toxic are read.
    """
    get = _scorer(spark, learn(spark, docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches):
            score = get(rows.column("text"))
            columns = [rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return given.mapInArrow(run, SCHEMA)


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    get = _scorer(spark, learn(spark, docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches):
            yield rows.filter(pa.array(get(rows.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)
