"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled text is learned. A text is parsed with each of them into phrases, each
as long as that language's text has it somewhere; the fewer phrases, weighted by the bits that name one, the closer the
language. Automata are dense tables, so a task parses thousands of text pieces in step; one scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import byte_table, text_bytes, text_slices
from chatterscope.llm.suffix_automaton import SuffixAutomaton

#: The bounds of the sample that is learned: documents and characters of each for a language, and languages (the commonest).
SAMPLE_DOCS, SAMPLE_CHARS, MAX_LANGUAGES = 64, 512, 200
#: All automata together have about this many bytes of text, so that their tables stay within some 100 MB.
SAMPLE_BYTES = 160_000
#: Texts are parsed in pieces of this many bytes; a phrase ends where its piece does.
PIECE = 512

LETTERS = byte_table(set(range(0x80)) - {*range(65, 91), *range(97, 123)})
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def letters_and_gaps(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters (any byte beyond ASCII counts as one), and a blank for what lies between; with new edges."""
    inside = LETTERS.inside[data]
    out = np.where(inside, LETTERS.becomes[data], np.uint8(32))
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    heads = edges[:-1][edges[:-1] < len(data)]
    keep[heads] = True
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=counts[1:])
    return out[keep], counts[edges]


class CrossParser:
    """Dense automata of several languages over one alphabet of bytes."""

    BREAK = np.int32(-(2**31))

    def __init__(self, samples: list[tuple[str, list[str]]]) -> None:
        self.languages = [lang for lang, _ in samples]
        streams = []
        for _, texts in samples:
            data, edges = letters_and_gaps(*text_bytes(pa.array(texts, pa.string())))
            # A blank between texts, so that no phrase runs across two of them unseen.
            streams.append(b" ".join(data[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True))[: SAMPLE_BYTES // len(samples)])
        seen = sorted(set(b"".join(streams)))
        self.code = np.full(256, len(seen), np.int32)  # bytes that no language has end a phrase
        self.code[seen] = np.arange(len(seen))
        self.pad, self.width = len(seen) + 1, len(seen) + 2
        tables, self.roots, at = [], [], 0
        for s in streams:
            automaton = SuffixAutomaton()
            automaton.add(self.code[np.frombuffer(s, np.uint8)].tolist())
            table = np.full((len(automaton.next), self.width), -1, np.int32)
            for state, follow in enumerate(automaton.next):
                table[state, list(follow)] = list(follow.values())
            # No way on: the phrase ends, and the byte begins the next.
            start = np.where(table[0] >= 0, table[0], 0)
            table = np.where(table >= 0, at + table * self.width, (at + start * self.width) | self.BREAK)
            table[:, self.pad] = at + np.arange(len(table)) * self.width
            tables.append(table.reshape(-1))
            self.roots.append(at)
            at += table.size
        self.table = np.concatenate(tables)
        self.bits = np.log2([max(2, len(s)) for s in streams])

    def phrases(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) by each language (columns)."""
        out = np.zeros((len(edges) - 1, len(self.languages)), np.int64)
        sizes = np.diff(edges)
        pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(sizes)), pieces)
        if not len(text):
            return out
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = edges[text] + number * PIECE
        long = np.minimum(PIECE, edges[text + 1] - begin)
        order = np.argsort(-long, kind="stable")  # pieces that have ended are a tail
        text, begin, long = text[order], begin[order], long[order]
        codes = self.code[data]
        live = np.searchsorted(-long, -np.arange(PIECE), side="left")
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(text), axis=1)
        breaks = np.ones(state.shape, np.int32)
        for t in range(int(long[0])):
            n = live[t]
            step = self.table.take(state[:, :n] + codes[begin[:n] + t])
            breaks[:, :n] -= step >> 31
            state[:, :n] = step & 0x7FFFFFFF
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(text, weights=breaks[k], minlength=len(sizes)).astype(np.int64)
        return out


def learned_sample(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """Texts by language: of each, the document with the least hash in each of `SAMPLE_DOCS` slots, a stretch of it.

    The languages are counted over all labelled rows that are not held out.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    number = F.xxhash64("doc_id")
    least = labelled.groupBy("lang", F.pmod(number, F.lit(SAMPLE_DOCS)).alias("slot")).agg(F.min(number).alias("least"), F.count("*").alias("n"))
    rows = least.groupBy("lang").agg(F.sum("n").alias("n"), F.collect_list("least").alias("least")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r.lang, x) for r in rows for x in r.least], "lang string, least long")
    own = labelled.withColumn("least", number).join(F.broadcast(wanted), ["lang", "least"])  # at most SAMPLE_DOCS * MAX_LANGUAGES rows
    begin = 1 + F.pmod(number, F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)).cast("int")
    pieces = own.select("lang", "least", F.substring("text", begin, F.lit(SAMPLE_CHARS)).alias("piece")).groupBy("lang", "least").agg(F.min("piece").alias("piece"))
    out: dict[str, list[str]] = {}
    for r in sorted(pieces.collect()):
        out.setdefault(r.lang, []).append(r.piece)
    return sorted(out.items())


_BUILT: dict[int, CrossParser] = {}


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: whether it was held out, the language, and how clearly it won (0 a tie, near 1 by far).

    Null texts and texts without a letter are `und` with score 0, as are all texts if no row has a label. Ties go to the
    language that is first by name. Repeated rows and doc_ids are judged one by one; an empty table gives no rows. Only
    doc_id and text, and lang where a label is learned, are read. Every text is parsed whole.
    """
    samples = learned_sample(docs)
    shared, key = spark.sparkContext.broadcast(samples), hash(repr(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if samples and key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = CrossParser(shared.value)
        for rows in text_slices(batches):
            texts, n = rows.column("text"), rows.num_rows
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
            names, scores = [UNKNOWN] * n, np.zeros(n)
            if samples:
                parser = _BUILT[key]
                data, edges = letters_and_gaps(*text_bytes(texts))
                cost = parser.phrases(data, edges) * parser.bits
                order = np.argsort(cost, axis=1, kind="stable")
                ranked = np.take_along_axis(cost, order, axis=1)
                rival = ranked[:, 1] if ranked.shape[1] > 1 else 2 * ranked[:, 0]
                scores = np.where(letters & (rival > 0), 1 - ranked[:, 0] / np.maximum(rival, 1e-9), 0.0)
                names = [parser.languages[k] if ok else UNKNOWN for k, ok in zip(order[:, 0], letters, strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(names), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return given.mapInArrow(run, SCHEMA)
