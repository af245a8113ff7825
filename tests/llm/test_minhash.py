import random
import re

import pyarrow as pa

from chatterscope.llm.minhash import _orders, near_duplicates, shingle_sets, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, size, percent):
    sets = {}
    for i, t in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                low[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def families(seed, n_words):
    """Originals with copies that differ by a few words, copies of copies among them."""
    rng = random.Random(seed)
    docs = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(n_words)]
        for _ in range(rng.randrange(1, 8)):
            if rng.random() < 0.8:
                base = list(base)
                for _ in range(rng.randrange(0, max(2, n_words // 40))):
                    base[rng.randrange(len(base))] = f"w{rng.randrange(5000)}"
            docs.append(" ".join(base) + rng.choice(["", " ", "\n"]))
    rng.shuffle(docs)
    return docs


def test_components_equal_brute_force(spark, make_docs):
    texts = [*families(1, 200), *families(2, 80), *families(3, 12), None, "", " \n", "one", "One", "one two", "tail", "x" * 50_000]
    docs = list(enumerate(texts))
    for size, percent in ((3, 85), (5, 80)):
        got = near_duplicates(spark, make_docs(docs, clashing=True).repartition(4), shingle=size, percent=percent).collect()
        assert {r.doc_id: tuple(r[1:]) for r in got} == brute(docs, size, percent)


def test_links_between_texts_that_are_no_hubs(spark, make_docs):
    """A chain in which each text is like the next only, so a hub of all alone would lose links."""
    rng = random.Random(9)
    base, chain = [f"w{k}" for k in range(300)], []
    for k in range(25):
        for _ in range(4):
            base[rng.randrange(300)] = f"v{k}-{rng.random()}"
        chain.append((1000 - 7 * k % 41 if k else 500, " ".join(base)))
    docs = [(k, t) for k, (_, t) in enumerate(sorted(chain, key=lambda x: hash(x[1]) if False else x[0]))]
    got = near_duplicates(spark, make_docs(docs), shingle=3, percent=85).collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == brute(docs, 3, 85)


def test_repeated_rows_and_missing_ids(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(30))
    rows = near_duplicates(spark, make_docs([(5, text), (5, text), (3, text), (None, text), (None, None)])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [(-1, -1, True), (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False)]


def test_empty_table(spark, make_docs):
    assert near_duplicates(spark, make_docs([])).collect() == []


def test_densified_signatures_estimate_similarity():
    words = [f"w{k}" for k in range(400)]
    texts = pa.array([" ".join(words), " ".join([*words[:360], *(f"v{k}" for k in range(40))]), "a b c d"])
    sets, cuts = shingle_sets(texts, 3)
    sig = signatures(sets, cuts, _orders(160))
    assert (sig[2] == sig[2, 0]).sum() < 160 and len(set(sig[2].tolist())) == 2  # two shingles fill all ranges
    same = len(set(sets[cuts[0] : cuts[1]].tolist()) & set(sets[cuts[1] : cuts[2]].tolist())) / len(set(sets[: cuts[2]].tolist()))
    assert abs((sig[0] == sig[1]).mean() - same) < 0.12


def test_alike_texts_are_not_all_paired(spark, make_docs, monkeypatch):
    """Copies with several changes each, which are linked with nothing or with a copy of their own, meet few others."""
    from chatterscope.llm import minhash

    rng, compared, inner = random.Random(8), [], minhash._compared

    def counting(*args):
        compared.extend(x.select("a", "b").collect() for x in args if "info_a" in getattr(x, "columns", ()))
        return inner(*args)

    base, texts = [f"w{k}" for k in range(150)], []
    for k in range(160):
        words = list(base) if k % 3 or not texts else texts[rng.randrange(len(texts))].split(" ")
        for _ in range(rng.choice([0, 1, 4, 5, 6])):
            words[rng.randrange(150)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = [(i, t) for i, t in enumerate(dict.fromkeys(texts))]
    monkeypatch.setattr(minhash, "_compared", counting)
    got = near_duplicates(spark, make_docs(docs), shingle=3, percent=85).collect()
    expected = brute(docs, 3, 85)
    assert {r.doc_id: tuple(r[1:]) for r in got} == expected
    hubs, *others = map(len, compared)
    assert 50 < sum(kept for _, _, kept in expected.values()) and sum(others) < len(docs)
