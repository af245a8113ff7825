import hashlib
import random
import re
import time

import pytest

from chatterscope.llm import pii
from chatterscope.llm.pii import _BRACKET_DOT, _MARK_HINT, KINDS, _address_edits, all_spans, luhn, personal_data

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def holds(kind, match):
    digits = re.sub(r"\D", "", match)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")),
        "card": 14 <= len(digits) <= 19 and luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def brute(text):
    spans = [(m.start(), KINDS.index(k), f"{k}:{m.start()}:{m.end()}") for k, p in PLAIN.items() for m in p.finditer(text or "") if holds(k, m[0])]
    joined = ",".join(s[2] for s in sorted(spans))
    return (*(sum(KINDS[s[1]] == k for s in spans) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest(), joined)


def cases():
    rng = random.Random(8)
    parts = ["a.b", "@", "x-y", ".com", ".", " ", "-", "1", "255", "256.", "10.0.0.1", "+", "+1 (555) 010-9999", "4111 1111 1111 1111", "4111111111111111", "(", "é", "\n", "0"]
    return ["".join(rng.choices(parts, k=rng.randrange(20))) for _ in range(400)]


def test_base_spans_equal_the_patterns(spark, make_docs):
    texts = [*cases(), None, "", "@" * 50, "1" * 5000, "a@b.c " * 3000]
    rows = personal_data(make_docs(texts, clashing=True).repartition(3)).collect()
    for r in rows:
        expected = brute(texts[r.doc_id])
        assert tuple(r[1:6]) == expected[:5]
        assert set(expected[5].split(",")) <= set(r.spans.split(","))  # added spans never displace base ones
    assert personal_data(make_docs([])).collect() == []


@pytest.mark.parametrize("text, kind, shown", [
    ("write jane [at] example [dot] org now", "email", "jane [at] example [dot] org"),
    ("write jane (at) example.org now", "email", "jane (at) example.org"),
    ("write jane.doe at example dot co dot uk.", "email", "jane.doe at example dot co dot uk"),
    ("mail jаne@exаmple.com", "email", "jаne@exаmple.com"),
    ("mail jane＠example．com!", "email", "jane＠example．com"),
    ("mail ja​ne@example.com", "email", "ja​ne@example.com"),
    ("é call plus four four two zero seven nine four six zero nine five eight", "phone", "plus four four two zero seven nine four six zero nine five eight"),
    ("card four one one one, one one one one, one one one one, one one one one ok", "card", "four one one one, one one one one, one one one one, one one one one"),
    ("host 10[.]0[.]0[.]1 up", "ip", "10[.]0[.]0[.]1"),
    ("call ＋44 20 7946 0958", "phone", "＋44 20 7946 0958"),
])
def test_disguised_identifiers_are_found_where_they_stand(text, kind, shown):
    _, spans = all_spans(text)
    assert (kind, shown) in {(f.kind, text[f.start : f.end]) for f in spans}


@pytest.mark.parametrize("text", [
    "we met at noon and looked at the dot on the map", "look at example dot", "two three of us", "Привет, как дела", "a (b) c [d] e",
    "one two three four five", "at the end. Dot.", "meet me at home. dot matrix",
])
def test_clean_texts_have_no_spans(text):
    assert all_spans(text)[1] == []


@pytest.mark.parametrize("shown", ["john @ example.com", "john @example.com", "john@ example.com", "john\n@ example.com"])
def test_blanks_around_the_at_sign_need_no_other_disguise(shown):
    for more in ("", " 1–2", " a b"):
        text = f"write {shown} now{more}"
        assert ("email", shown) in {(f.kind, text[f.start : f.end]) for f in all_spans(text)[1]}


def test_the_hint_holds_wherever_an_address_is_rewritten():
    rng = random.Random(3)
    parts = ["jane", "example", "org", "co", " ", "\n", "@", "at", "dot", ".", "[", "]", "(", ")", "<", ">", "{", "}"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(4, 16))) for _ in range(40_000)]
    texts += [f"jane{a}{at}{b}example{c}{dot}{d}org" for at in ("at", "@", "[at]", "(@)") for dot in ("dot", ".", "[dot]") for a in ("", " ", "\n") for b in ("", " ") for c in ("", " ") for d in ("", " ")]
    edited = [t for t in texts if _address_edits(t) or _BRACKET_DOT.search(t)]
    assert len(edited) > 100 and all(_MARK_HINT.search(t) for t in edited)


def test_patterns_equal_the_plain_ones_on_random_texts():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choices("ab1.@_- ", [3, 3, 1, 3, 3, 1, 1, 1], k=rng.randrange(40)))
        assert pii.emails(text) == [m.span() for m in email.finditer(text)], text
        text = "".join(rng.choices("12. a", [4, 4, 5, 1, 1], k=rng.randrange(40)))
        expected = [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert pii.ips(text) == expected, text


@pytest.mark.parametrize("text", ["1" * 1_000_000, "a@" + "b" * 1_000_000, "x @ " + "_" * 1_000_000, "a." * 200_000, "1." * 300_000, "+1 " * 300_000, "a@" * 400_000])
def test_very_long_runs_take_time_in_proportion(text):
    start = time.monotonic()
    pii.base_spans(text)
    pii.disguised_spans(text)
    assert time.monotonic() - start < 10
