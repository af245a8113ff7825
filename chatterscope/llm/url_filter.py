"""URL rules by a bit-parallel wildcard automaton.

All glob rules are packed into the bits of a few 64-bit words, one bit per character; a star is a bit that may stay set.
One shift and two masks per character move every rule over a URL at once, and a task moves thousands of URLs in step.
One scan of the url column, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.llm.arrow_text import text_bytes, text_slices

SCHEMA = "page_id long, host string, path string, rule string, verdict string"


class Rule(NamedTuple):
    """A verdict on a host with all its subdomains, where the path begins as given."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.host}#{self.path}*", f"*.{self.host}#{self.path}*"


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Blocked where no rule fits: globs over host#path; neither part has a # of its own, so a host can't run on into a path.
BLOCKED_GLOBS = ("ads.*", "*.ads.*", "*/cgi-bin/*", "*/wp-login.php*", "*.exe", "*.zip", "*.mp4")


class ShiftAnd:
    """Globs of plain characters and `*`, as bits of consecutive words; a glob's first bit is anchored to the URL's start."""

    def __init__(self, globs: Sequence[str]) -> None:
        bits: list[int] = []  # the byte that sets each bit
        first, last, anchored, floating, stays = [], [], [], [], []
        for glob in globs:
            raw = glob.encode()
            plain = [k for k, c in enumerate(raw) if c != ord("*")]
            if not plain:
                raise ValueError(f"a glob needs a character: {glob!r}")
            first.append(len(bits))
            (floating if raw[0] == ord("*") else anchored).append(len(bits))
            for k in plain:
                if raw[k + 1 : k + 2] == b"*":
                    stays.append(len(bits))
                bits.append(raw[k])
            last.append(len(bits) - 1)
        self.words = len(bits) // 64 + 1
        self.last = np.array(last, np.int64)
        self.anchored, self.floating, self.stays = map(self._mask, (anchored, floating, stays))
        self.inner = ~self._mask(first)  # a shift must not run from one glob into the next
        self.by_byte = np.array([self._mask([k for k, b in enumerate(bits) if b == c]) for c in range(256)])

    def _mask(self, at: list[int]) -> np.ndarray:
        out = [0] * self.words
        for k in at:
            out[k // 64] |= 1 << k % 64
        return np.array(out, np.uint64)

    def matches(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Whether each text (rows) is matched as a whole by each glob (columns)."""
        sizes = np.diff(edges)
        order = np.argsort(-sizes, kind="stable")  # ended texts are a tail
        begin, ordered = edges[:-1][order], -sizes[order]
        state = np.zeros((len(sizes), self.words), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(ordered, -t, side="left"))
            old = state[:n]
            moved = old << one
            moved[:, 1:] |= old[:, :-1] >> top
            moved &= self.inner
            moved |= self.floating | self.anchored if t == 0 else self.floating
            state[:n] = (moved & self.by_byte[data[begin[:n] + t]]) | (old & self.stays)
        out = np.empty((len(sizes), len(self.last)), bool)
        out[order] = (state[:, self.last // 64] >> (self.last % 64).astype(np.uint64)) & one
        return out


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, blocked: Sequence[str] = BLOCKED_GLOBS) -> DataFrame:
    """One row per page: host, path, the longest rule that fits (null if none) and the verdict.

    Of rules that are equally long the first counts. Where none fits, the page is blocked if a glob of `blocked` matches
    and allowed otherwise. A null url, or one without "://", has an empty host and path. Repeated rows are judged one by
    one; an empty table gives no rows. Only page_id and url are read.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    globs = [g for r in ranked for g in r.globs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd([*globs, *blocked])
        for rows in text_slices(batches, "canonical"):
            hit = automaton.matches(*text_bytes(rows.column("canonical")))
            fits = hit[:, : len(globs)].reshape(rows.num_rows, -1, 2).any(axis=2) if ranked else np.zeros((rows.num_rows, 0), bool)
            found = np.where(fits.any(axis=1), fits.argmax(axis=1), -1) if ranked else np.full(rows.num_rows, -1)
            other = hit[:, len(globs) :].any(axis=1)
            names = [ranked[k].name if k >= 0 else None for k in found]
            verdicts = [ranked[k].verdict if k >= 0 else "block" if b else "allow" for k, b in zip(found, other, strict=True)]
            columns = [rows.column("page_id"), rows.column("host"), rows.column("path"), pa.array(names, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.withColumn("canonical", F.concat("host", F.lit("#"), "path")).mapInArrow(run, SCHEMA)
