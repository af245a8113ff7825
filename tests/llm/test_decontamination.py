import hashlib
import random
import re
import time

from chatterscope.llm.decontamination import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        parts = [tuple(v[i : i + window]) for i in range(len(v) - window + 1)] if len(v) >= window else [tuple(v)] * bool(v)
        for p in set(parts):
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit)


def cases():
    rng = random.Random(3)
    vocabulary = ["a", "b", "Cc", "dé", "e5"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, text(rng.choice([1, 2, 3, 5, 8, 9, 10, 11, 15, 30])) if k % 9 else None) for k in range(40)] + [(40, "..."), (41, "a b a"), (42, "A, b. a!")]
    docs = [(k, text(rng.randrange(60)) + ". " + (rng.choice(items)[1] or "")) for k in range(60)] + [(90, None), (91, ""), (92, "!!"), (93, "a" * 10_000)]
    return docs, items


def test_contamination_equals_brute_force(spark, make_docs):
    docs, items = cases()
    bench = spark.createDataFrame(items, ITEMS)
    expected = {i: brute(t, items) for i, t in docs}
    for block_bytes in (1 << 20, 300):  # one block, and several that are merged
        got = contamination(spark, make_docs(docs, clashing=True).repartition(3), bench, block_bytes=block_bytes).collect()
        assert {r.doc_id: tuple(r[1:]) for r in got} == expected


def test_long_items_only(spark, make_docs):
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(1, item), (2, item)], ITEMS)
    texts = [f"x {item.upper()} y", item.replace(" seven", ""), f"{item} {item}", "one two three four five six seven eight nine ten zero"]
    got = {r.doc_id: (r.n_hit, r.n_items) for r in contamination(spark, make_docs(texts), bench).collect()}
    assert got == {0: (12, 2), 1: (0, 0), 2: (24, 2), 3: (10, 2)}


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    assert contamination(spark, make_docs([]), none).collect() == []
    assert [r.contaminated for r in contamination(spark, make_docs(["a b"]), none).collect()] == [False]
    assert [r.text for r in decontaminate(spark, make_docs(["a b", None]), none).collect()] == ["a b", None]


def test_decontaminate_cuts_spans_and_drops_what_is_mostly_benchmark(spark, make_docs):
    item = "one two three four five six seven eight nine ten"
    rest = "clean words " * 20
    docs = [(1, f"{rest}({item.title()}) {rest}"), (2, f"see {item}"), (3, rest), (4, None), (5, "")]
    bench = spark.createDataFrame([(1, item)], ITEMS)
    given = make_docs(docs, clashing=True)
    for block_bytes in (1 << 20, 20):
        got = decontaminate(spark, given, bench, block_bytes=block_bytes)
        assert got.columns == given.columns
        rows = {r.doc_id: r for r in got.collect()}
        assert set(rows) == {1, 3, 4, 5}
        assert rows[1].text == f"{rest}() {rest}" and rows[1].n_chars == len(rows[1].text)
        assert (rows[3].text, rows[4].text, rows[5].text) == (rest, None, "")


def test_items_without_an_id(spark, make_docs):
    bench = spark.createDataFrame([(None, "red green"), (None, "blue sky"), (7, "green blue"), (7, "green blue")], ITEMS)
    digest = hashlib.sha256(b"7").hexdigest()
    for block_bytes in (1 << 20, 5):
        got = contamination(spark, make_docs(["red green blue sky", "blue sky", "grey"]), bench, block_bytes=block_bytes).collect()
        nothing = hashlib.sha256(b"").hexdigest()
        assert sorted(tuple(r) for r in got) == [(0, 4, 4, 2, digest, True), (1, 2, 2, 1, nothing, True), (2, 1, 0, 0, nothing, False)]


def test_one_word_over_and_over_takes_time_in_proportion(spark, make_docs):
    """A text and an item of one repeated word: every place of the text matches the whole item but for its window."""
    bench = spark.createDataFrame([(1, "la " * 20_000)], ITEMS)
    start = time.monotonic()
    row = contamination(spark, make_docs(["la " * 100_000]), bench).first()
    assert (row.n_words, row.n_hit, row.n_items) == (100_000, 100_000, 1)
    assert time.monotonic() - start < 30
