"""Texts of Arrow batches as byte arrays and word arrays.

A task never holds more than one slice of its input in expanded form: `text_slices` cuts batches by bytes, so a
batch of long documents needs no more memory than one of short ones (a single longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in order, at most `limit` bytes of text or one row at a time."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, before = 0, 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(ends, before + limit, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at, before = to, int(ends[to - 1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each begins and the last ends; a null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    edges = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[edges[0] : edges[-1]], edges - edges[0]


class ByteTable(NamedTuple):
    """What each byte becomes, and whether it belongs to a word."""

    becomes: np.ndarray
    inside: np.ndarray


def byte_table(separators: set[int]) -> ByteTable:
    """Words are runs of bytes that are no separators; A-Z are lower-cased."""
    becomes = np.arange(256, dtype=np.uint8)
    becomes[65:91] += 32
    return ByteTable(becomes, ~np.isin(np.arange(256), list(separators)))


#: Words of any characters but blanks; words of letters, digits and whatever is not ASCII.
BLANK_WORDS = byte_table({0x20, *range(0x09, 0x0E)})
ALNUM_WORDS = byte_table(set(range(0x80)) - {*range(48, 58), *range(65, 91), *range(97, 123)})


class Words(NamedTuple):
    """Words of several texts: normalised bytes without gaps, where each word lies there and which text it is of."""

    values: pa.BinaryArray
    text: np.ndarray
    per_text: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def split_words(data: np.ndarray, edges: np.ndarray, table: ByteTable) -> Words:
    """The words of each text. start and stop are byte positions in `data`."""
    inside = table.inside[data]
    return words_at(table.becomes[data], inside, first_bytes(inside, edges), edges)


def first_bytes(inside: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Marks bytes that begin a word: not preceded by another, or first in their text."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = edges[:-1][edges[:-1] < len(inside)]
    first[heads] = inside[heads]
    return first


def words_at(norm: np.ndarray, inside: np.ndarray, first: np.ndarray, edges: np.ndarray) -> Words:
    """Words that begin where `first` says and run on while `inside` holds."""
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    stop = np.flatnonzero(last) + 1
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(stop - start, out=offsets[1:])
    values = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(norm[inside])])
    upto = np.searchsorted(start, edges)
    per_text = np.diff(upto)
    return Words(values, np.repeat(np.arange(len(per_text)), per_text), per_text, start, stop)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the public splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
