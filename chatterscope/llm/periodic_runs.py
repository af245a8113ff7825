"""Periodic runs of words by internal pattern matching.

A run of period q and at least 4 q words holds a dyadic block of L words, q <= L < 2 q, whose next or previous
occurrence is exactly q words away: a nearer one would, by Fine and Wilf, give the run a smaller period. So

1. a suffix array of the words is sorted by prefix doubling. After a round on prefixes of L words, the suffixes that
   begin with the same block are one range of the array,
2. every block that occurs often enough asks a wavelet tree over the array for the occurrences next to it, before and
   after: a range predecessor and successor. Their distance is a candidate period of the progression,
3. a candidate is extended as far as words one period apart are equal, and kept if it is long enough.

Texts are handled in slices of a few MB, each text whole. The words of different texts get different names, so no
range of the array spans texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import BLANK_WORDS, ByteTable, split_words, text_bytes, text_slices
from chatterscope.llm.scratch import unused
from chatterscope.llm.wavelet import WaveletTree

#: A run has at least so many words and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4

#: Words of any characters but blanks, their case kept.
WORDS = ByteTable(np.arange(256, dtype=np.uint8), BLANK_WORDS.inside)

RUNS = "array<struct<start: long, length: long, period: long>>"


def _refined(ids: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(L, rank, size, array) for L = 2, 4, 8...: the array sorted by prefixes of L words, for each place the first
    place of its prefix in the array, and how many suffixes share it. Ends when no prefix has two of them.

    Prefixes end with their text. The arrays are the same objects each time, sorted further. Only suffixes that share
    their prefix with another are sorted again.
    """
    n = len(ids)
    if not n:
        return
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    end = edges[1:][text]
    array = np.lexsort((ids, text)).astype(np.int32)
    rank, size = np.zeros(n, np.int32), np.zeros(n, np.int32)

    def regroup(places: np.ndarray, members: np.ndarray, changed: np.ndarray) -> None:
        """Names the members, in order at these places of the array, by the first place of their group."""
        head = np.flatnonzero(changed)
        sizes = np.diff(np.append(head, len(members)))
        rank[members], size[members] = np.repeat(places[head], sizes), np.repeat(sizes, sizes)

    key = text[array] * (int(ids.max(initial=0)) + 1) + ids[array]
    regroup(np.arange(n), array, np.concatenate([[True], key[1:] != key[:-1]]))
    length = 1
    while True:
        places = np.flatnonzero(size[array] > 1)
        members = array[places]
        follow = members + length
        inside = follow < end[members]
        second = np.zeros(len(members), np.int64)
        second[inside] = rank[follow[inside]] + 1
        key = rank[members].astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        members, key = members[order], key[order]
        array[places] = members
        if len(members):
            regroup(places, members, np.concatenate([[True], key[1:] != key[:-1]]))
        length *= 2
        if not (size > 1).any():
            return
        yield length, rank, size, array


def _blocks(ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, length, low, high) of the dyadic blocks that occur again in their text, and the array.

    A run of period q, L / 2 < q <= L, has 2 L words or more, so it holds a whole block, and that a second time.
    """
    start = np.repeat(edges[:-1], np.diff(edges))
    offset = np.arange(len(ids)) - start
    words = np.repeat(np.diff(edges), np.diff(edges))
    found, array = [], np.zeros(0, np.int32)
    for length, rank, size, array in _refined(ids, edges):
        if length > int(words.max(initial=0)) // 2:
            break
        least = MIN_WORDS if length == 2 else MIN_PERIODS * (length // 2 + 1)
        at = np.flatnonzero((offset % length == 0) & (offset + length <= words) & (size > 1) & (words >= least))
        found.append((at, np.full(len(at), length), rank[at], rank[at] + size[at]))
    if not found:
        return (np.zeros(0, np.int64),) * 4 + (array,)
    return *(np.concatenate(x) for x in zip(*found, strict=True)), array


def _candidates(ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): at the place begins a block that occurs again a period later."""
    begin, length, low, high, array = _blocks(ids, edges)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree = WaveletTree(array)
    before = tree.below(low, high, begin)  # the block itself is the next in order
    places, periods = [], []
    for step, there in ((1, before + 1 < high - low), (-1, before > 0)):
        b, l, h = begin[there], low[there], high[there]
        other = tree.smallest(l, h, before[there] + step)
        apart = np.abs(other - b)
        fits = (apart <= length[there]) & (2 * apart > np.where(length[there] > 2, length[there], 0))
        places.append(np.minimum(b, other)[fits])
        periods.append(apart[fits])
    return np.concatenate(places), np.concatenate(periods)


def _extent(ids: np.ndarray, at: int, period: int, first: int, last: int) -> tuple[int, int]:
    """How far words one period apart stay equal around a place, within a text: looked at in doubling steps."""
    high, step = at, 64
    while high < last - period:
        to = min(high + step, last - period)
        apart = np.flatnonzero(ids[high:to] != ids[high + period : to + period])
        if len(apart):
            high += int(apart[0])
            break
        high, step = to, 2 * step
    low, step = at, 64
    while low > first:
        to = max(low - step, first)
        apart = np.flatnonzero(ids[to:low] != ids[to + period : low + period])
        if len(apart):
            low = to + int(apart[-1]) + 1
            break
        low, step = to, 2 * step
    return low, high + period


def find_runs(ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """All runs of texts of word numbers, as rows (text, start in the text, length, period) in this order.

    `edges` says where each text begins, and the last ends. A run is maximal, has its smallest period q, and
    max(MIN_WORDS, MIN_PERIODS * q) words or more.
    """
    at, period = _candidates(ids, edges)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    text = np.searchsorted(edges, at, side="right") - 1
    order = np.lexsort((at, period, text))
    at, period, text = at[order], period[order], text[order]
    group = np.flatnonzero(np.concatenate([[True], (period[1:] != period[:-1]) | (text[1:] != text[:-1])]))
    least: dict[tuple[int, int, int], int] = {}
    for a, b in zip(group.tolist(), [*group[1:].tolist(), len(at)], strict=True):
        t, q = int(text[a]), int(period[a])
        while a < b:
            low, high = _extent(ids, int(at[a]), q, int(edges[t]), int(edges[t + 1]))
            if high - low >= max(MIN_WORDS, MIN_PERIODS * q):
                # A multiple of the smallest period has the same extent.
                least[t, low, high] = min(q, least.get((t, low, high), q))
            # Places before the first word that breaks it have the same extent.
            a += int(np.searchsorted(at[a:b], high - q))
    rows = [(t, low - int(edges[t]), high - low, q) for (t, low, high), q in least.items()]
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _dropped(runs: np.ndarray, edges: np.ndarray, n: int) -> np.ndarray:
    """Marks words that a run contains after its first period."""
    step = np.zeros(n + 1, np.int64)
    base = edges[runs[:, 0]] + runs[:, 1]
    np.add.at(step, base + runs[:, 3], 1)
    np.add.at(step, base + runs[:, 2], -1)
    return np.cumsum(step[:-1]) > 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The documents with three more columns: n_words, runs (sorted by start, length, period) and collapsed.

    `collapsed` is the text's words joined by one blank, without those that a run holds after its first period. Words
    are runs of characters other than blanks, numbered from 0; their case counts. Null and empty texts and texts of blanks have no words, no
    runs and an empty `collapsed`. Rows that repeat are handled one by one, an empty table gives no rows, and columns of the
    same names are replaced. Texts are handled whole; one text needs memory in proportion to its own length.
    """
    out = ("n_words", "runs", "collapsed")
    keep = [c for c in docs.columns if c.lower() not in out]
    carried = [unused(docs, f"carried_{k}") for k in range(len(keep))]
    rows = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias(carried[0])) if keep else docs.select("text")
    schema = f"`{carried[0]}` {rows.schema[carried[0]].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words = split_words(*text_bytes(part.column("text")), WORDS)
            edges = np.concatenate([[0], np.cumsum(words.per_text)])
            coded = words.values.dictionary_encode()
            ids = coded.indices.to_numpy(zero_copy_only=False)
            runs = find_runs(ids, edges)
            kept = ~_dropped(runs, edges, len(ids))
            left = np.concatenate([[0], np.cumsum(kept)])[edges]
            lists = pa.LargeListArray.from_arrays(left, coded.dictionary.take(pa.array(ids[kept])).cast(pa.string()))
            cuts = np.searchsorted(runs[:, 0], np.arange(part.num_rows + 1))
            spans = pa.StructArray.from_arrays([pa.array(runs[:, k].copy()) for k in (1, 2, 3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part.column(carried[0]), pa.array(words.per_text.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans).cast(run_type), pc.binary_join(lists, " ")],
                [carried[0], *out],
            )

    return rows.mapInArrow(run, schema).select(f"{carried[0]}.*", *out)
