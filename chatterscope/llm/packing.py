"""Packing: documents are tokenised, cut and dealt into sequences of near-equal length by multiway differencing.

One pass over the corpus without a shuffle. Each task tokenises its documents and packs them in groups of bounded size;
what doesn't fill whole windows is carried into the task's next group, so only a task's last group has padding. A task
that is run again gives the same sequences, as their numbers derive from its partition.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chatterscope.llm.arrow_text import first_bytes, text_bytes, text_slices, words_at

CAPACITY = 2048
#: Tokens packed at once, and parts of words that a task remembers the ids of.
GROUP_TOKENS, CACHE_WORDS = 1 << 20, 400_000
SPECIAL = "<|"

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_sets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.arange(256)
    letter = ((at >= 65) & (at <= 90)) | ((at >= 97) & (at <= 122))
    mark = (at > 32) & (at < 127) & ~letter & ~((at >= 48) & (at <= 57)) & (at != ord("'"))
    becomes = at.astype(np.uint8)
    becomes[65:91] += 32
    return letter, mark, becomes


LETTER, MARK, LOWER = _byte_sets()
#: How byte-level vocabularies write the bytes that are no printable characters of Latin-1: in order, from U+0100 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
INSIDE = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class WordEncoder:
    """Ids of whole texts, by encoding each distinct part of a word once.

    Right for vocabularies that lower-case letters, drop white space and never merge across it nor from an ASCII letter
    to an ASCII mark other than the apostrophe; texts with a special token's opening are encoded as they are.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def _learn(self, words: list[bytes]) -> None:
        tokenize, other = self.tokenizer.model.tokenize, []
        for w in words:
            if not w.isascii():
                text = w.decode()
                if not text.isalpha() or max(text) > "ÿ":
                    other.append(text)
                    continue
                # Letters of Latin-1 are composed already and have one lower-case letter each.
                raw = text.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
            elif w.isalpha():
                raw = w.decode()
            else:
                other.append(w.decode())
                continue
            self.slots[w] = len(self.ends) - 1
            self.ids.extend([x.id for x in tokenize(raw)])
            self.ends.append(len(self.ids))
        for text, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.slots[text.encode()] = len(self.ends) - 1
            self.ids.extend(e.ids)
            self.ends.append(len(self.ids))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        data, edges = text_bytes(texts)
        inside = INSIDE[data]
        first = first_bytes(inside, edges)
        first[1:] |= LETTER[data[:-1]] & MARK[data[1:]] & inside[1:]
        words = words_at(LOWER[data], inside, first, edges)
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.slots) + len(distinct) > self.cache_words:
            self._forget()
        self._learn([w for w in distinct if w not in self.slots])
        slot = np.fromiter(map(self.slots.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        ids, stops = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        begins, long = stops[slot], stops[slot + 1] - stops[slot]
        ends = np.cumsum(long)
        all_ids = ids[np.repeat(begins - (ends - long), long) + np.arange(int(long.sum()))]
        del ids, stops  # views keep the arrays from growing
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words.per_text)])]
        out = [all_ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for k in np.flatnonzero(pc.fill_null(pc.match_substring(texts, SPECIAL), False).to_numpy(zero_copy_only=False)):
            out[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, np.uint32)
        return out


def differencing(sizes: list[int], parts: int) -> list[list[int]]:
    """Deals items into `parts` subsets of near-equal sums; gives the items' numbers by subset.

    Each partial partition is a descending list of its non-empty subsets. The two with the largest imbalance are merged,
    the largest subsets of one meeting the smallest of the other, until one is left.
    """
    if parts < 1:
        return []
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]  # a single item's imbalance is its size
    heapq.heapify(heap)
    if parts == 1 or len(heap) == 0:
        return [list(range(len(sizes)))] + [[] for _ in range(parts - 1)]
    number = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        over = max(0, len(a) + len(b) - parts)  # subsets that must meet another
        cut_a, cut_b = len(a) - over, len(b) - over
        met = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[cut_a:], reversed(b[cut_b:]), strict=True)]
        both = sorted([*a[:cut_a], *b[:cut_b], *met], key=itemgetter(0), reverse=True)
        low = both[-1][0] if len(both) == parts else 0
        heapq.heappush(heap, (low - both[0][0], number, both))
        number += 1
    out = []
    for _, tree in heap[0][2]:
        found, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += x
            else:
                found.append(x)
        out.append(found)
    return out + [[] for _ in range(parts - len(out))]


def windows_whole(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of whole items, none above capacity: the window count rises until differencing keeps it.

    Items above capacity are refused; there may then be as many windows as items.
    """
    if max(sizes, default=0) > capacity:
        raise ValueError("an item exceeds the capacity")
    parts = -(-sum(sizes) // capacity)
    while True:
        dealt = differencing(sizes, parts)
        most = max((sum(sizes[i] for i in w) for w in dealt), default=0)
        if most <= capacity:
            return dealt
        parts += max(1, (most - capacity) * parts // (8 * capacity))


class Piece:
    """Ids of one document from `start` on."""

    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id: int | None, doc_tokens: int, start: int, ids: np.ndarray) -> None:
        self.doc_id, self.doc_tokens, self.start, self.ids = doc_id, doc_tokens, start, ids

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:at]), Piece(self.doc_id, self.doc_tokens, self.start + at, self.ids[at:])


def windows_cut(pieces: list[Piece], parts: int, capacity: int = CAPACITY) -> list[list[Piece]]:
    """Differencing into `parts` windows; what stands above capacity is cut off and fills windows with room."""
    dealt = [[pieces[i] for i in w] for w in differencing([len(p.ids) for p in pieces], parts)]
    spare: list[Piece] = []
    for w in dealt:
        above = sum(len(p.ids) for p in w) - capacity
        while above > 0:
            last = w.pop()
            if len(last.ids) > above:
                keep, last = last.cut(len(last.ids) - above)
                w.append(keep)
            spare.append(last)
            above -= len(last.ids)
    for w in dealt:
        room = capacity - sum(len(p.ids) for p in w)
        while room > 0 and spare:
            p = spare.pop()
            if len(p.ids) > room:
                p, rest = p.cut(room)
                spare.append(rest)
            w.append(p)
            room -= len(p.ids)
    return dealt


def _grouped(encoded: Iterator[tuple[int | None, np.ndarray]], capacity: int, group_tokens: int) -> Iterator[list[list[Piece]]]:
    """Windows, group by group. All are full but those of the last group."""
    waiting: list[Piece] = []
    tokens = 0
    for doc_id, ids in encoded:
        whole = len(ids) // capacity * capacity
        for at in range(0, whole, capacity):
            yield [[Piece(doc_id, len(ids), at, ids[at : at + capacity])]]
        if whole < len(ids):
            waiting.append(Piece(doc_id, len(ids), whole, ids[whole:]))
            tokens += len(ids) - whole
        if tokens >= group_tokens:
            left = []
            if tokens % capacity:
                size = tokens % capacity
                while size > 0:
                    p = waiting.pop()
                    if len(p.ids) > size:
                        p, rest = p.cut(len(p.ids) - size)
                        waiting.append(p)
                        p = rest
                    left.append(p)
                    size -= len(p.ids)
            yield windows_cut(waiting, tokens // capacity, capacity)
            waiting, tokens = left, sum(len(p.ids) for p in left)
    yield windows_cut(waiting, -(-tokens // capacity), capacity)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = 1, group_tokens: int = GROUP_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence, and a checksum of its ids.

    tokenizer: a file of `public_tokenizers`, or a path that every executor has. Each document's ids are followed by
    `end_id`; a null or empty text is that id alone, and an empty table gives no rows. Documents longer than a sequence
    give whole sequences and a rest. Repeated rows and doc_ids are packed one by one. with_ids adds the ids themselves.
    Only doc_id and text are read, so other columns of any name do no harm.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
        import public_tokenizers

        encoder = WordEncoder(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
        end = np.array([end_id], np.uint32)
        for rows in text_slices(batches, limit=4 << 20):
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoder.encode(rows.column("text")), strict=True):
                yield doc_id, np.concatenate([ids, end])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        for windows in _grouped(encoded(batches), capacity, group_tokens):
            for w in windows:
                offset = 0
                for p in w:
                    raw = p.ids.astype("<u4").tobytes()
                    rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(raw), p.doc_tokens, sequence, offset, *([p.ids.astype(np.int32)] if with_ids else ())))
                    offset += len(p.ids)
                sequence += offset > 0
            if len(rows) > 4096:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = SCHEMA + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(packed, schema)
