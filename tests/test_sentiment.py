import math

import pytest

from chatterscope import resources as rs
from chatterscope.operators import sentiment as se


@pytest.fixture(scope="module")
def score(spark):
    def run(*texts, **options):
        rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "post_id string, _text string")
        scored = se.score_texts(rows, rs.lexicon(spark), rs.modifiers(spark), **options).collect()
        return [r for r in sorted(scored, key=lambda r: int(r.post_id))]
    return run


def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


def test_labels(score):
    good, bad, plain = score(
        "What an amazing view, we love the harbour!",
        "An awful ferry; everybody would hate that seat.",
        "The ferry leaves at nine on Mondays.",
    )
    assert good.label == "positive" and good.compound > 0.05
    assert bad.label == "negative" and bad.compound < -0.05
    assert plain.label == "neutral" and plain.compound == 0


def test_blank_texts(score):
    for r in score("", "  \n ", None):
        assert (r.compound, r.positive, r.negative, r.neutral, r.label) == (0, 0, 0, 1, "neutral")
    for r in score("", None, blank_neutral=0.0):
        assert (r.compound, r.neutral, r.label) == (0, 0, "neutral")


def test_range_and_sum(score):
    for r in score("A ferry came in.", "Nothing was said of the harbour.", "best " * 500, "worst! " * 90):
        assert -1 <= r.compound <= 1
        assert abs(r.positive + r.negative + r.neutral - 1) < 0.01


@pytest.mark.parametrize("text, strength", [
    ("good", 1.9),
    ("very good", 1.9 + 0.293),
    ("very much so good", 1.9 + 0.293 + 0.293 * 0.9),
    ("slightly bad", -2.5 + 0.293),
    ("not good", 1.9 * -0.74),
    ("not very good", (1.9 + 0.293) * -0.74),
    ("it isn't really good", (1.9 + 0.293) * -0.74),
    ("not for a second good", 1.9),
    ("the GOOD one", 1.9 + 0.733),
    ("GOOD", 1.9),
    ("good, but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("good!!!", 1.9 + 3 * 0.292),
    ("good!!!!!!", 1.9 + 4 * 0.292),
    ("bad!", -2.5 - 0.292),
    ("good??", 1.9 + 2 * 0.18),
    ("good????", 1.9 + 0.96),
    ("glad worst love!", 2.0 - 3.1 + 3.2 + 0.292),
])
def test_rules(score, text, strength):
    assert score(text)[0].compound == compound(strength)


def test_balanced_text_stays_neutral_whatever_the_marks(score):
    # 1.9 + 2.0 - 3.9 leaves a rest in floating point, which the marks would amplify.
    r = score("good glad awful useless sorry suck! hurt hope effective")[0]
    assert r.compound == compound(1.9 + 2.0 - 2.0 - 1.8 - 0.3 - 1.9 - 2.4 + 1.9 + 2.1 - 0.292)


def test_shares(score):
    r = score("a good day, a bad night")[0]
    total = 2.9 + 3.5 + 4
    assert (r.positive, r.negative, r.neutral) == (round(2.9 / total, 3), round(3.5 / total, 3), round(4 / total, 3))


def test_large_lexicon_is_not_broadcast(spark):
    from chatterscope.operators.broadcasts import is_small, small

    wide = spark.range(50).withColumnRenamed("id", "term")
    assert is_small(wide, 50) and not is_small(wide, 49)
    long = spark.range(3).selectExpr("repeat('x', 1000) term", "cast(null as double) valence", "array(id) other")
    assert is_small(long, max_bytes=3_100) and not is_small(long, max_bytes=2_999) and is_small(long.limit(0), max_bytes=0)
    assert "ResolvedHint" not in small(wide, max_rows=49)._jdf.queryExecution().logical().toString()


def test_repeated_rows_are_scored_once_and_texts_apart(spark):
    rows = spark.createDataFrame([("p", "good day")] * 3 + [("p", "bad day"), ("q", "good day")], "post_id string, _text string")
    got = se.score_texts(rows, rs.lexicon(spark), rs.modifiers(spark)).collect()
    single = compound(1.9)
    assert sorted((r.post_id, r.compound) for r in got) == [("p", compound(-2.5)), ("p", single), ("q", single)]


VALENCE = {r["term"]: float(r["valence"]) for r in rs.rows("lexicon")}
EFFECTIVE, DIE = VALENCE["effective"], VALENCE.get("die", 0)


@pytest.fixture(scope="module")
def ruled(spark, score):
    def run(*texts, **options):
        tables = {"idioms": rs.idioms(spark), "emoji": rs.emoji(spark)} | options
        return score(*texts, **tables)
    return run


@pytest.mark.parametrize("text, strength", [
    ("they live at the bus stop", 0),
    ("a broken heart and a beating heart", -2.9 + 3.1),
    ("a broken heartbeat", VALENCE["broken"]),
    ("not to die for", 3.0 * -0.74),
    ("slightly to die for", 3.0 - 0.293),
    ("to die", DIE),
    ("Very BAD ASS, they said", 1.5 + 0.733 + 0.293),
    ("yeah right broken heart", -2.0 - 2.9),
    ("good, but yeah right", 1.9 * 0.5 - 2.0 * 1.5),
    ("the least effective of all", EFFECTIVE * -0.74),
    ("least effective", EFFECTIVE * -0.74),
    ("very much least effective", (EFFECTIVE + 0.293 * 0.9) * -0.74),
    ("at least effective", EFFECTIVE),
    ("very least effective", EFFECTIVE + 0.293 * 0.95),
    ("least of all effective", EFFECTIVE),
    ("so 👍good", 1.9 + 0.293 * 0.9),
    ("one💔two", -2.9),
    ("😢😠❤\ufe0f", VALENCE["angry"]),
])
def test_idioms_least_and_emoji(ruled, text, strength):
    assert ruled(text)[0].compound == compound(strength)


def test_idioms_that_overlap(spark, ruled):
    own = spark.createDataFrame([("aa bb", 2.0), ("BB  cc", 1.0), ("cc dd", 1.0), ("aa", 0.5), ("xx yy", 1.0), ("xx yy zz", 3.0), ("", 9.0), (None, 9.0), ("nn", None)], "term string, valence double")
    texts = {"aa bb cc dd": 2.0, "bb cc dd": 1.0, "aa cc": 0.5, "xx yy": 1.0, "xx yy zz": 3.0, "xx yy zz xx yy": 4.0, "nn": 0}
    assert [r.compound for r in ruled(*texts, idioms=own)] == [compound(s) for s in texts.values()]


def test_rules_without_rows_and_odd_texts(spark, score, ruled):
    none = {"idioms": rs.idioms(spark).limit(0), "emoji": rs.emoji(spark).limit(0)}
    texts = ("a broken heart", "", None, " 💔", "😀" * 3_000, "to die for " * 3_000)
    assert score(*texts[:3], **none) == score(*texts[:3])
    got = ruled(*texts)
    assert (got[1].label, got[2].neutral, got[3].compound) == ("neutral", 1, compound(-2.9))
    assert got[4].neutral == 1 and got[5].compound == compound(9_000)


def test_too_many_idioms_are_refused(spark, score):
    many = spark.range(se.MAX_IDIOMS + 1).selectExpr("concat('w', id) term", "1D valence")
    with pytest.raises(ValueError):
        score("w1", idioms=many)


def test_only_words_that_may_be_rated_become_rows(spark):
    """Of a long text, the first word, rated ones and beginnings of idioms."""
    text = "plain " + "some nothing more nobody " * 500 + "good the bomb bad"
    posts = spark.createDataFrame([("a", text)], "post_id string, _text string")
    terms = spark.createDataFrame([("good",), ("bad",), (None,)], "term string")
    rows = se._word_rows(posts, ["post_id"], terms, {"the bomb": 3.0, "to die for": 2.0})
    got = {r.i: (r.w, r.p1, r.iv, r.inside) for r in rows.collect()}
    assert got.items() >= {0: ("plain", None, None, False), 2001: ("good", "nobody", None, False),
                           2002: ("the", "good", 3.0, False), 2004: ("bad", "bomb", None, False)}.items()
    assert len(got) < 1000  # words may share a mark
    plain = se._word_rows(posts, ["post_id"], terms, {}).collect()
    assert {(r.i, r.w, r.p1) for r in plain} >= {(0, "plain", None), (2001, "good", "nobody"), (2004, "bad", "bomb")} and len(plain) < 1000
