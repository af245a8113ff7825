"""Personal data, plain or disguised, with spans in the source text.

Plain identifiers are found by patterns. Then transducers rewrite look-alike characters, spelled digits and "at" / "dot"
disguises, keeping for every character written which source characters it came from; the same patterns run over what
they wrote, and spans are mapped back. Only texts that hold a disguise are rewritten. One scan, no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from chatterscope.llm.arrow_text import text_slices

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits matches from its first or not at all, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: to each @ that a domain follows, all characters before it that an address may have, back to the last match.

    Whether a match ends well depends on what follows the @ alone, so its leftmost start is as far back as possible.
    """
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            low = at
            while low > end and text[low - 1] in _LOCAL_CHARS:
                low -= 1
            if low < at:
                end = domain.end()
                out.append((low, end))
        at = text.find("@", at + 1)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _IP.finditer(text):
        parts = m[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            out.append(m.span())
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15]


FINDERS: dict[str, Callable[[str], list[tuple[int, int]]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


class Found(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Found]:
    has_digits = _DIGIT.search(text) is not None
    out = []
    for kind in KINDS:
        if kind == "email" or has_digits:
            out += [Found(kind, *s) for s in FINDERS[kind](text)]
    return out


# Characters that are drawn like an ASCII one, from Unicode's Cyrillic and Greek blocks.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "ο": "o", "α": "a", "ν": "v", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ο": "O", "Ρ": "P", "Τ": "T",
    "\u2024": ".", "\u3002": ".", "\ufe52": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\ufe6b": "@",
    "\u00a0": " ", "\u2007": " ", "\u202f": " ",
}
#: Full-width forms of ASCII, and digits of other scripts, by rule.
_LOOKALIKE = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)} | {
    chr(zero + d): str(d) for zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)
} | HOMOGLYPHS
_LOOKALIKE_ANY = re.compile("[" + "".join(map(re.escape, _LOOKALIKE)) + "]")
_TRANSLATE = str.maketrans(_LOOKALIKE)
#: Characters of no width that may be strewn into an identifier.
_UNSEEN = re.compile("[\u200b\u200c\u200d\u2060\ufeff\u00ad]+")

_DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_DIGIT_WORD = "(?:" + "|".join(_DIGIT_WORDS) + "|oh|[0-9])"
#: Seven or more spelled digits in a row; figures may stand between them.
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[ ,-]+)?{_DIGIT_WORD}(?:[ ,.-]+{_DIGIT_WORD}){{6,}}(?![A-Za-z0-9])", re.I)
_SPELLED_HINT = re.compile(r"(?:zero|one|two|three|four|five|six|seven|eight|nine)[ ,.-]+(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|[0-9])", re.I)
_SPELLED_PART = re.compile(rf"plus|{_DIGIT_WORD}", re.I)

_NAME = r"[A-Za-z0-9_%+-]++"
#: Names begin where no other name, or name and dot, runs on to them: from there a match would have begun.
_BEGINS = r"(?<![A-Za-z0-9_%+-])(?<![A-Za-z0-9_%+-]\.)"
_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s+@\s*|\s*@\s+|@)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\.)"
#: Ends of domain names that are no common words, for addresses in bare words.
_DOMAINS = frozenset("com org net edu gov mil info biz io ai dev app uk de fr es nl eu ca au jp br ch se".split())
#: An address with its at sign or a dot disguised. A bare "at" needs a "dot" that is spelled out as well.
_DISGUISED = re.compile(rf"{_BEGINS}({_NAME}(?:{_DOT}{_NAME})*)({_AT})({_NAME}(?:{_DOT}{_NAME})*{_DOT}[A-Za-z]{{2,}})(?![A-Za-z0-9])", re.I)
_MARKED = re.compile(r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]", re.I)
#: Every disguise above has one of these. An @ next to white space is one as well.
_MARK_HINT = re.compile(r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]|\sdot\s|\s@|@\s", re.I)
_DOTS = re.compile(_DOT, re.I)
_BRACKET_DOT = re.compile(r"(?<=[0-9])\s*(?:[\[({]\s*(?:dot|\.)\s*[\])}]|\sdot\s)\s*(?=[0-9])", re.I)


class Rewritten:
    """A rewritten text; for each of its characters, where the source characters it stands for begin and end."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces spans, in order and apart; each character written stands for the whole span it replaces."""
        if not edits:
            return
        parts, start, end, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            start += [*self.start[at:a], *[self.start[a]] * len(new)]
            end += [*self.end[at:a], *[self.end[b - 1]] * len(new)]
            at = b
        self.text = "".join([*parts, self.text[at:]])
        self.start, self.end = [*start, *self.start[at:]], [*end, *self.end[at:]]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _SPELLED.finditer(text):
        words = [p[0].lower() for p in _SPELLED_PART.finditer(text, *m.span())]
        if sum(w.isalpha() for w in words) >= 3:
            edits.append((*m.span(), "".join("+" if w == "plus" else "0" if w == "oh" else _DIGIT_WORDS.get(w, w) for w in words)))
    return edits


def _address_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _DISGUISED.finditer(text):
        bare = m[2].strip().lower() == "at"
        spelled = " dot " in m[3].lower() or _MARKED.search(m[3]) is not None
        if (bare and spelled and _DOTS.split(m[3])[-1].lower() in _DOMAINS) or (not bare and (m[2] != "@" or spelled)):
            edits.append((*m.span(), f"{_DOTS.sub('.', m[1])}@{_DOTS.sub('.', m[3])}"))
    return edits


def disguised_spans(text: str) -> list[Found]:
    """Identifiers that show only once the disguises are undone."""
    other = not text.isascii() and (_LOOKALIKE_ANY.search(text) or _UNSEEN.search(text))
    marked = _MARK_HINT.search(text)
    if not other and not marked and not _SPELLED_HINT.search(text):
        return []
    out = Rewritten(text)
    if other:
        out.text = out.text.translate(_TRANSLATE)
        out.replace([(*m.span(), "") for m in _UNSEEN.finditer(out.text)])
    if marked or other:
        out.replace([(*m.span(), ".") for m in _BRACKET_DOT.finditer(out.text)])
        out.replace(_address_edits(out.text))
    out.replace(_spelled_edits(out.text))
    if out.text == text:
        return []
    return [Found(f.kind, *out.source(f.start, f.end)) for f in base_spans(out.text)]


def all_spans(text: str) -> tuple[list[Found], list[Found]]:
    """Base spans, and these with the spans of disguised identifiers, unless they overlap one that is no part of them."""
    base = base_spans(text)
    more: list[Found] = []
    for f in disguised_spans(text):
        apart = (f.end <= g.start or g.end <= f.start or (f.kind == g.kind and f.start <= g.start and g.end <= f.end and f != g) for g in (*base, *more))
        if all(apart):
            more.append(f)
    return base, [*base, *more]


def joined(spans: list[Found]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda f: (f.start, KINDS.index(f.kind))))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: base matches by kind, a digest of their spans, and all spans.

    Spans are in code points of the source, end exclusive. Null and empty texts have none. Repeated rows and doc_ids are
    reported one by one; other columns are not read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches):
            out = []
            for text in rows.column("text").to_pylist():
                base, every = all_spans(text or "")
                counts = [sum(f.kind == k for f in base) for k in KINDS]
                out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            columns = [pa.array(c, pa.int64() if k < 4 else pa.string()) for k, c in enumerate(zip(*out, strict=True))]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
