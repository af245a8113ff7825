import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from chatterscope.llm.periodic_runs import find_runs, periodic_runs
from chatterscope.llm.queries import op13_periodic_runs
from chatterscope.llm.wavelet import WaveletTree

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every period tried at every place."""
    least = {}
    for q in range(1, len(w) // 4 + 1):
        k = 0
        while k < len(w) - q:
            if w[k] != w[k + q]:
                k += 1
                continue
            j = k
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - k >= max(6, 4 * q):
                least[k, j + q] = min(q, least.get((k, j + q), q))
            k = j
    return sorted((a, b - a, q) for (a, b), q in least.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_text(rng, n, words):
    t = [rng.randrange(words) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n + 1), rng.randrange(1, 20)
        for k in range(a + p, min(n, a + int(p * rng.uniform(2, 8)))):
            t[k] = t[k - p]
    return t


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [periodic_text(rng, rng.randrange(130), rng.choice([1, 2, 3, 8, 1000])) for _ in range(rng.randrange(6))]
    edges = np.cumsum([0, *map(len, texts)])
    got = find_runs(np.array([x for t in texts for x in t], np.int64), edges)
    assert [tuple(x) for x in got.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in brute(t)]


def test_long_periods_whatever_their_place():
    """Periods just above a power of two, whose runs begin right after a block does."""
    for q in (9, 17, 33, 34, 64, 65):
        for lead in (0, 1, 31, 63, 64):
            w = [10_000 + k for k in range(lead)] + [k % q for k in range(4 * q)] + [20_000]
            assert [tuple(x[1:]) for x in find_runs(np.array(w), np.array([0, len(w)])).tolist()] == [(lead, 4 * q, q)]


def test_nested_runs():
    inner = ["a"] * 8 + ["b"]
    w = inner * 5
    ids = np.array([{"a": 0, "b": 1}[x] for x in w])
    assert [tuple(x[1:]) for x in find_runs(ids, np.array([0, len(w)])).tolist()] == brute(w)


def test_wavelet_tree_counts_and_selects():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 500, 700)
    tree = WaveletTree(values)
    low = rng.integers(0, 690, 200)
    high = low + rng.integers(1, 10, 200)
    bound = rng.integers(0, 500, 200)
    assert tree.below(low, high, bound).tolist() == [int((values[a:b] < c).sum()) for a, b, c in zip(low, high, bound, strict=True)]
    k = rng.integers(0, high - low)
    assert tree.smallest(low, high, k).tolist() == [int(np.sort(values[a:b])[j]) for a, b, j in zip(low, high, k, strict=True)]


def test_operator_on_odd_texts(spark, make_docs):
    texts = [None, "", " \n\t", "one", "a " * 6, "A a " * 4, "x y " * 50_000, "ä ö " * 9, "w" * 200_000, "la la la la la la\nno", "no\x0bblank\x0chere"]
    rows = periodic_runs(make_docs([*enumerate(texts), (4, texts[4]), (None, texts[4])], clashing=True).selectExpr("*", "'x' AS runs", "'y' AS N_words", "'z' AS carried_0").repartition(3))
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "id", "key", "kept", "spans", "component_id", "removed", "bands", "blob", "h", "n", "carried_0", "n_words", "runs", "collapsed"]
    got = rows.collect()
    assert len(got) == len(texts) + 2
    for r in got:
        w = WORD.findall(r.text or "")
        runs = brute(w) if len(w) < 1000 else [(0, 100_000, 2)]
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(w), runs, collapsed(w, runs))
    assert periodic_runs(make_docs([])).collect() == []


def test_query_equals_brute_force(spark, make_docs, tmp_path):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(40)]
    docs = [(k, None if k == 30 else " ".join(vocabulary[x] for x in periodic_text(rng, rng.randrange(200), rng.choice([1, 3, 40])))) for k in range(120)]
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    changed = 0
    for i, text in docs:
        w = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            changed += 1
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(collapsed(w, runs)))
        assert got[i] == expected
    assert changed > 5
