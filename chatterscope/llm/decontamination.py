"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words become numbers, and one automaton over them all is streamed along every document: at each word it holds
the longest run of words, ending there, that some item has. A word is hit if it lies in a run of `window` words of an
item, or in a whole item that is shorter. Spans of hit words are cut out; documents mostly made of them go.

Items are taken in blocks of bounded size, each with an automaton of its own that is broadcast; the documents are read
once per block and their hits, a few rows, are merged. One block holds all usual benchmarks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import ALNUM_WORDS, Words, split_words, text_bytes, text_slices
from chatterscope.llm.scratch import unused, written
from chatterscope.llm.suffix_automaton import SuffixAutomaton

WINDOW = 10
#: Bytes of item text in one automaton: some 100 MB of it in a Python worker.
BLOCK_BYTES = 2 << 20


class ItemAutomaton(SuffixAutomaton):
    """The runs of words of all items, with the items that have a window at the state of its words."""

    def __init__(self, window: int) -> None:
        super().__init__()
        self.window = window

    def all_added(self) -> None:
        self.items: list[set[int]] = [set() for _ in self.length]
        self.by_length = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        #: For each state of `window` words or more, that of the suffix of so many.
        self.suffix = [0] * len(self.length)
        for s in self.by_length:
            up = self.link[s]
            self.suffix[s] = self.suffix[up] if self.length[up] >= self.window else s

    def mark(self, item: int, words: list[int]) -> None:
        """Notes the item at the state of each of its windows. To be called when all items are added."""
        if len(words) < self.window:
            self.items[self._walk(words)].add(item)
            return
        for at, state, length in self.matches(words):
            if length >= self.window:
                self.items[self.suffix[state]].add(item)

    def _walk(self, words: list[int]) -> int:
        state = 0
        for w in words:
            state = self.next[state][w]
        return state

    def finish(self, short: list[list[int]]) -> None:
        """The short items that are suffixes of each state, nearest first. States whose words are a whole short item keep its length."""
        self.short_length = [0] * len(self.length)
        for words in short:
            self.short_length[self._walk(words)] = len(words)
        # To the nearest state up the links, the state itself included, that is a short item.
        self.short = [0] * len(self.length)
        for s in self.by_length:
            self.short[s] = s if self.short_length[s] else self.short[self.link[s]]

    def hits(self, words: list[int]) -> Iterator[tuple[int, int, set[int]]]:
        """Spans of words that are some item's window, with the items that have it."""
        for at, state, length in self.matches(words):
            if length >= self.window:
                s = self.suffix[state]
                yield at + 1 - self.window, at + 1, self.items[s]
                state = self.link[s]
            # A state also stands for shorter suffixes than its longest; a match may be one of them.
            s = self.short[state] if state else 0
            while s:
                if self.short_length[s] <= length:
                    yield at + 1 - self.short_length[s], at + 1, self.items[s]
                s = self.short[self.link[s]] if self.link[s] > 0 else 0


class ItemBlock:
    """The automaton of some items, and the filters that find where to run it."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int) -> None:
        words = split_words(*text_bytes(pa.array(texts, pa.string())), ALNUM_WORDS)
        coded = words.values.dictionary_encode()
        at = coded.indices.to_numpy()
        self.vocabulary, self.ids = coded.dictionary, ids
        self.size = max(1, len(self.vocabulary))
        cuts = np.concatenate([[0], np.cumsum(words.per_text)])
        rows = [at[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.automaton = ItemAutomaton(window)
        for row in rows:
            self.automaton.add(row)
        self.automaton.all_added()
        for item, row in enumerate(rows):
            if row:
                self.automaton.mark(item, row)
        self.automaton.finish([r for r in rows if 0 < len(r) < window])
        self.least = min([window, *(len(r) for r in rows if r)])
        same = words.text[1:] == words.text[:-1]
        self.pairs = np.unique(at[:-1][same].astype(np.int64) * self.size + at[1:][same])

    def hits(self, data: np.ndarray, edges: np.ndarray) -> tuple[Words, dict[int, tuple[list[tuple[int, int]], set[int]]]]:
        """The words; by text, spans of them that are hit and the items with occurring windows."""
        words = split_words(data, edges, ALNUM_WORDS)
        found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
        n = len(words.start)
        if not n or not len(self.vocabulary):
            return words, found
        at = pc.fill_null(pc.index_in(words.values, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        # Only words that follow each other somewhere in an item can lie in one window: the rest ends a run.
        ends = np.ones(n, bool)
        near = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0) & (words.text[:-1] == words.text[1:]))
        if len(near) and len(self.pairs):
            pair = at[near] * self.size + at[near + 1]
            where = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            ends[near[self.pairs[where] == pair]] = False
        stops = np.flatnonzero(ends) + 1
        starts = np.concatenate([[0], stops[:-1]])
        fits = (stops - starts >= self.least) & (at[starts] >= 0)
        for a, b in zip(starts[fits].tolist(), stops[fits].tolist(), strict=True):
            for lo, hi, items in self.automaton.hits(at[a:b].tolist()):
                spans, all_items = found.setdefault(int(words.text[a]), ([], set()))
                all_items |= items
                if spans and spans[-1][1] >= a + lo:
                    while spans and spans[-1][1] >= a + lo:  # short items may reach further back
                        lo = min(lo, spans.pop()[0] - a)
                spans.append((a + lo, a + hi))
        return words, found


Block = tuple[list[str | None], list[str]]


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[int, Iterator[Block]]:
    """How many blocks of bounded size the items have, and the blocks, one at a time on the driver. Items that repeat count once."""
    items = benchmark.selectExpr("cast(item_id as string) item_id", "coalesce(text, '') text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + 2 * total // block_bytes

    def block(k: int) -> Block:
        rows = (items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)).collect()
        return [r.item_id for r in rows], [r.text for r in rows]

    return parts, map(block, range(parts))


#: The block that a Python worker has built last.
_BUILT: dict[str, ItemBlock] = {}


def _block_of(key: str, shared) -> ItemBlock:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ItemBlock(*shared.value)
    return _BUILT[key]


def _digest(items: Iterable[str | None]) -> str:
    return hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()


def _union(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _scan(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, finish: Callable, schema) -> DataFrame:
    """Streams the documents along every block; `finish` turns rows, words, spans of words and items into output.

    With more than one block, spans and items found so far are stored with the documents between the blocks.
    """
    spans_at, items_at = (unused(docs, x) for x in ("spans", "items"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    parts, blocks = _blocks(benchmark, block_bytes)

    def step(rows_in: DataFrame, block, first: bool, last: bool) -> DataFrame:
        ids, texts = block
        key = hashlib.sha256(repr((ids, texts, window)).encode()).hexdigest()
        shared = spark.sparkContext.broadcast((ids, texts, window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = _block_of(key, shared)
            for rows in text_slices(batches):
                words, hits = block.hits(*text_bytes(rows.column("text")))
                found = {k: (spans, {block.ids[i] for i in own}) for k, (spans, own) in hits.items()}
                if not first:
                    before = zip(rows.column(spans_at).to_pylist(), rows.column(items_at).to_pylist(), strict=True)
                    for k, (flat, names) in enumerate(before):
                        if names:
                            spans, own = found.get(k, ([], set()))
                            at = int(np.searchsorted(words.text, k))
                            found[k] = _union([*spans, *((a + at, b + at) for a, b in zip(flat[::2], flat[1::2], strict=True))]), own | set(names)
                if last:
                    yield finish(rows, words, found)
                    continue
                flat = [[int(x - np.searchsorted(words.text, k)) for s in found[k][0] for x in s] if k in found else [] for k in range(rows.num_rows)]
                names = [sorted(found[k][1], key=lambda i: (i is None, i)) if k in found else [] for k in range(rows.num_rows)]
                own = {spans_at: pa.array(flat, pa.list_(pa.int32())), items_at: pa.array(names, pa.list_(pa.string()))}
                columns = {n: c for n, c in zip(rows.schema.names, rows.columns, strict=True) if n not in own}
                yield pa.RecordBatch.from_pydict(columns | own)

        if last:
            return rows_in.mapInArrow(run, schema)
        return written(spark, rows_in.mapInArrow(run, f"{fields}, `{spans_at}` array<int>, `{items_at}` array<string>"), "hits")

    for k, block in enumerate(blocks):
        docs = step(docs, block, k == 0, k == parts - 1)
    return docs


REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its words, those that are hit, and the items with occurring windows.

    Null and empty texts have no words. Repeated doc_ids and rows are judged one by one. Items without words have no
    window; an empty benchmark hits nothing. Items without an item_id hit like others and count as one together, which
    the digest leaves out. Only doc_id, text and item_id, text are read.
    """

    def report(rows: pa.RecordBatch, words: Words, found: dict) -> pa.RecordBatch:
        n = rows.num_rows
        hit, items, digest = np.zeros(n, np.int64), np.zeros(n, np.int64), [_digest([])] * n
        for k, (spans, names) in found.items():
            hit[k], items[k], digest[k] = sum(b - a for a, b in spans), len(names), _digest(names)
        columns = [rows.column("doc_id"), pa.array(words.per_text, pa.int64()), pa.array(hit), pa.array(items), pa.array(digest), pa.array(hit > 0)]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in REPORT.split(", ")])

    return _scan(spark, docs.selectExpr("cast(doc_id as long) doc_id", "text"), benchmark, window, block_bytes, report, REPORT)


def decontaminate(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without their hit spans. Those with more than `max_coverage` of their words hit are left out.

    Text around a removed span stays as it is. All columns are kept; n_chars, if there, follows a changed text. Texts
    that are null, empty or not hit are unchanged.
    """

    def cut(rows: pa.RecordBatch, words: Words, found: dict) -> pa.RecordBatch:
        if not found:
            return rows
        data, edges = text_bytes(rows.column("text"))
        texts, keep = rows.column("text").to_pylist(), np.ones(rows.num_rows, bool)
        sizes = rows.column("n_chars").to_pylist() if "n_chars" in rows.schema.names else None
        for k, (spans, _) in found.items():
            keep[k] = sum(b - a for a, b in spans) <= max_coverage * words.per_text[k]
            parts, at = [], int(edges[k])
            for a, b in spans:
                parts.append(data[at : words.start[a]].tobytes())
                at = int(words.stop[b - 1])
            texts[k] = b"".join([*parts, data[at : edges[k + 1]].tobytes()]).decode()
            if sizes:
                sizes[k] = len(texts[k])
        columns = dict(zip(rows.schema.names, rows.columns, strict=True)) | {"text": pa.array(texts, rows.schema.field("text").type)}
        if sizes:
            columns["n_chars"] = pa.array(sizes, rows.schema.field("n_chars").type)
        return pa.RecordBatch.from_pydict(columns).filter(pa.array(keep))

    return _scan(spark, docs, benchmark, window, block_bytes, cut, docs.schema)
