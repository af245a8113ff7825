import random
import re

import numpy as np
import xxhash

from chatterscope.llm import simhash_anchors as sa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k : k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints):
    """Component of each (id, fingerprint), by comparing all."""
    low = {i: i for i, _ in prints}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for x, (i, p) in enumerate(prints):
        for j, q in prints[x + 1 :]:
            if (p ^ q).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                low[b] = a
    return {i: root(i) for i, _ in prints}


def check(spark, make_docs, docs, **how):
    got = sa.simhash_duplicates(spark, make_docs(docs, **how).repartition(3)).collect()
    prints = [(i, fingerprint(t)) for i, t in docs]
    parts = brute(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", parts[i]) for i, p in prints}
    return parts


def copies(seed, families, size, changes):
    rng = random.Random(seed)
    out = []
    for _ in range(families):
        base = [f"Wort{rng.randrange(3000)}" for _ in range(rng.randrange(5, size))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.randrange(changes + 1)):
                text[rng.randrange(len(text))] = f"neu{rng.randrange(3000)}"
            out.append(" ".join(text) + rng.choice(["", "\n", " "]))
    rng.shuffle(out)
    return out


def test_documents_equal_brute_force(spark, make_docs):
    texts = [*copies(1, 25, 300, 2), None, "", " \t\n", "a", "A", "a b c", "a b c d", "Ärger hier " * 9, "word " * 30_000, "x" * 100_000]
    parts = check(spark, make_docs, list(enumerate(texts)), clashing=True)
    assert len(set(parts.values())) < len(parts) - 20


def test_every_pair_within_four_bits_meets(spark):
    """Fingerprints at all distances around each other, in all ways of sharing the bits among the halves."""
    rng = random.Random(5)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), d)) for d in (1, 2, 3, 4, 4, 4, 4, 5, 5, 6)]
    rows = list(enumerate(dict.fromkeys(prints)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for _, p in rows]
    distinct = spark.createDataFrame(signed, "print long")
    home = sa._home_keys(distinct)
    links = sa._links(sa._dealt(spark, home, sa._replicas(distinct).join(home.select("key").distinct(), "key", "left_semi")))
    ids = {p[0]: i for (i, _), p in zip(rows, signed, strict=True)}
    low = {i: i for i, _ in rows}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for r in links.collect():
        a, b = sorted((root(ids[r.a]), root(ids[r.b])))
        low[b] = a
    assert {i: root(i) for i, _ in rows} == brute(rows)


def test_a_dense_group_is_dealt_in_blocks(spark, make_docs, monkeypatch):
    """Many fingerprints around one, at anchors that are split: links as by brute force, and far fewer rows than pairs."""
    monkeypatch.setattr(sa, "BLOCK_ROWS", 16)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    docs = []
    for k in range(150):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(400)] = f"v{rng.randrange(10**6)}"
        docs.append((k, " ".join(text)))
    parts = check(spark, make_docs, docs)
    assert len(set(parts.values())) < 75


def test_code_covers_all_words_with_radius_one():
    x = np.random.default_rng(1).integers(0, 2**64, 20_000, np.uint64)
    for half in sa.HALVES:
        bits = (x >> np.uint64(half.shift)) & np.uint64(0xFFFFFFFF)
        home = sa.homes(x, half)
        assert (np.bitwise_count(home ^ bits) <= 1).all() and (sa._syndrome(home) == 0).all()
    assert sum(h.threshold + 1 for h in sa.HALVES) > sa.THRESHOLD
    assert sum(map(len, sa._errors(1))) == 33 and all(len(e) for e in sa._errors(1))


def test_spanning_forest_keeps_what_is_connected():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 250, np.uint64), rng.integers(0, 300, 250, np.uint64)
    x, y = sa.spanning_forest(a, b)

    def parts(pairs):
        low = {}
        find = lambda i: i if low.setdefault(i, i) == i else find(low[i])
        for i, j in pairs:
            p, q = sorted((find(i), find(j)))
            low[q] = p
        return {i: find(i) for i in low}

    mine, theirs = parts(zip(x.tolist(), y.tolist(), strict=True)), parts((i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i != j)
    assert mine == theirs and len(x) == len(theirs) - len(set(theirs.values()))


def test_repeated_rows_missing_ids_and_an_empty_table(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(30))
    rows = sa.simhash_duplicates(spark, make_docs([(5, text), (5, text), (3, text), (5, "other words altogether here"), (None, text), (None, "alone and without id")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 3), (3, 3), (5, 3), (5, 3), (5, 5)]
    assert sa.simhash_duplicates(spark, make_docs([])).collect() == []
