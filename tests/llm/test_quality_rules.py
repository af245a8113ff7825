import random
import re

from chatterscope.llm.quality_rules import Rule, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, repeated = {}, set()
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k : k + 8]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {p + j for p in places for j in range(8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def test_measures_equal_brute_force(spark, make_docs):
    rng = random.Random(7)
    texts = ["".join(rng.choices(["a", "b ", "é", " ", "\n", "\t", "# ", "the ", "😀", "\x0b", "\u00a0", "\r\n"], k=rng.randrange(200))) for _ in range(150)]
    texts += [" ".join(rng.choices("ab", k=60)) for _ in range(20)] + [None, "", " \n ", "x y " * 5000, "a b c d e f g h " * 2, "a b c d e f g h"]
    docs = make_docs(texts, clashing=True)
    rows = {r.doc_id: r for r in quality_rules(docs.repartition(3)).collect()}
    assert {k: tuple(rows[k][1:7]) for k in rows} == {k: brute(t) for k, t in enumerate(texts)}
    assert not any(r.kept and r.base_failed for r in rows.values())
    assert quality_rules(make_docs([])).collect() == []
    assert quality_rules(make_docs([(1, "a"), (1, "a")])).count() == 2


def test_thresholds_decide(spark, make_docs):
    prose = "the cat sat on the mat and it was good to see that the dog of the house is in "
    texts = [prose * 1 + "bed now", "zq xv " * 3 + " ".join(f"zq{k}" for k in range(30)), " ".join(f"the#$%{k} the" for k in range(20))]
    docs = make_docs(texts)
    assert [r.kept for r in quality_rules(docs).orderBy("doc_id").collect()] == [True, False, False]
    assert [r.kept for r in quality_rules(docs, rules=[]).orderBy("doc_id").collect()] == [True, True, True]
    assert [r.kept for r in quality_rules(docs, rules=[Rule("n_words", 100, None)]).collect()] == [False] * 3


def test_plan_is_one_projection_without_python_or_shuffle(spark, make_docs):
    plan = quality_rules(make_docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
