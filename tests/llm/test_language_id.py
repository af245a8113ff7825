import random
import zlib

import numpy as np
import pytest

from chatterscope.llm.language_id import PIECE, CrossParser, identify, letters_and_gaps

GIVEN = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(GIVEN)
    rows = identify(spark, docs.withColumn("text", docs.text)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 300 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_rows_that_are_not_held_out_teach(spark):
    docs = spark.read.parquet(GIVEN)
    other = docs.selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 3 = 1, 'xx', lang) lang", "'s' source", "n_chars")
    a, b = (dict(identify(spark, d).select("doc_id", "lang_pred").collect()) for d in (docs, other))
    assert a == b


def naive_phrases(text, sample):
    """A phrase goes on while the sample has it; a byte the sample lacks ends one and stands before the next."""
    count = 0
    for at in range(0, len(text), PIECE):
        phrase, count = b"", count + 1
        for k in range(at, min(at + PIECE, len(text))):
            byte = text[k : k + 1]
            if phrase + byte in sample:
                phrase += byte
            else:
                phrase, count = byte if byte in sample else b"", count + 1
    return count


def test_parses_equal_a_naive_search():
    rng = random.Random(3)
    samples = [(name, ["".join(rng.choices(letters + " ", k=300))]) for name, letters in (("a", "abcd"), ("b", "cdeé"))]
    parser = CrossParser(samples)
    texts = ["".join(rng.choices("abcdeéz,. ", k=rng.choice([0, 1, 5, 700, 1500]))) for _ in range(30)]
    raw = [t.encode() for t in texts]
    edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data, edges = letters_and_gaps(np.frombuffer(b"".join(raw), np.uint8), edges)
    got = parser.phrases(data, edges)
    for k in range(len(texts)):
        own = data[edges[k] : edges[k + 1]].tobytes()
        for j, (_, sample) in enumerate(samples):
            body, ends = letters_and_gaps(np.frombuffer(sample[0].encode(), np.uint8), np.array([0, len(sample[0].encode())]))
            assert got[k, j] == naive_phrases(own, body.tobytes())


def test_odd_texts_and_tables(spark, make_docs):
    teach = [(k, "the cat and the dog went to the house " * 5) for k in range(40)]
    texts = [*teach, (100, None), (101, ""), (102, "123 !!"), (103, "the dog" * 20_000), (103, "the dog"), (None, "the cat")]
    rows = identify(spark, make_docs(texts, clashing=True)).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by[100] == by[101] == by[102] == ("und", 0.0) and by[103][0] == by[None][0] == "en"
    assert {r.doc_id: r.held_out for r in rows if r.doc_id is not None} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in texts if i is not None}
    assert identify(spark, make_docs([])).collect() == []
    unlabelled = make_docs(["the cat"]).selectExpr("doc_id", "text", "string(null) lang")
    assert [r.lang_pred for r in identify(spark, unlabelled).collect()] == ["und"]


@pytest.mark.parametrize("text, letter", [("abc", True), ("é", True), ("中", True), ("12 .", False), ("…", False)])
def test_letters_decide_und(spark, make_docs, text, letter):
    docs = make_docs([*[(k, "abc é 中 " * 9) for k in range(9)], (50, text)])
    assert (identify(spark, docs).where("doc_id = 50").first().lang_pred == "en") == letter
