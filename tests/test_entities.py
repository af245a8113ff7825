import random
import re

import pytest
from pyspark.sql import functions as F

from chatterscope import resources as rs
from chatterscope.functions.text import title_case
from chatterscope.operators import entities as en


@pytest.fixture(scope="module")
def extract(spark):
    def run(text, gazetteer=None, **options):
        texts = spark.createDataFrame([("p", text)], "post_id string, _text string")
        names = rs.gazetteer(spark) if gazetteer is None else spark.createDataFrame(
            gazetteer, "phrase string, entity_type string")
        found = en.gazetteer_entities(texts, names, **options).collect()
        return {(r.entity_text, r.entity_type, r.mention_count) for r in found}
    return run


def test_organisations(extract):
    assert extract("Ferries by Apple, seats by Microsoft and no harbour.") == {("Apple", "ORG", 1), ("Microsoft", "ORG", 1)}


def test_nothing(extract):
    assert extract("") == set() and extract(None) == set()


def test_stop_entities_are_dropped(extract):
    assert extract("Google moored a ferry here.") == set()


def test_longest_match_wins(extract):
    assert extract("Google DeepMind, the GNU General Public License and the General Public License") == {
        ("Google Deepmind", "ORG", 1), ("Gnu General Public License", "PRODUCT", 1),
        ("General Public License", "PRODUCT", 1)}


def test_overlapping_phrases_of_equal_length_stay(extract):
    names = [("Aba Bcb", "ORG"), ("Bcb Cdc", "ORG"), ("Bcb", "GPE")]
    assert extract("Aba Bcb Cdc", names) == {("Aba Bcb", "ORG", 1), ("Bcb Cdc", "ORG", 1)}


def test_other_types_numbers_and_letters_are_dropped(extract):
    names = [("Mars", "PLANET"), ("747", "PRODUCT"), ("X", "PRODUCT"), ("Xé", "PRODUCT")]
    assert extract("Mars 747 X Xé", names) == {("Xé", "PRODUCT", 1)}


def test_top_n_with_ties_by_name(extract):
    text = "Apple Intel Sony IBM Intel Sony Tesla Tesla Tesla"
    assert extract(text, top_n=2) == {("Tesla", "ORG", 3), ("Intel", "ORG", 2)}


def test_phrases_of_any_length(extract):
    names = [("Bureau of the North Sea Water Survey", "ORG"), ("North Sea", "GPE")]
    assert extract("The Bureau of the North Sea Water Survey met", names) == {("Bureau Of The North Sea Water Survey", "ORG", 1)}


def test_phrases_end_with_their_sentence_and_line(extract):
    names = [("Apache License", "PRODUCT")]
    assert extract("We saw an Apache. License it! Apache\nLicense", names) == set()
    assert extract("the Apache License.", names) == {("Apache License", "PRODUCT", 1)}


def test_repeated_posts_count_once(spark):
    posts = spark.createDataFrame([("p", "Tesla Tesla", None)] * 2 + [("q", "Tesla", None)], "post_id string, title string, body string")
    got = en.extract_from_posts(posts, rs.gazetteer(spark)).collect()
    assert sorted((r.post_id, r.mention_count) for r in got) == [("p", 2), ("q", 1)]


def test_a_common_first_word_is_no_join_key(spark):
    texts = spark.createDataFrame([("p", "The Times")], "post_id string, _text string")
    names = spark.createDataFrame([(f"The {k}", "ORG") for k in range(50)], "phrase string, entity_type string")
    plan = en.mentions(texts, names)._jdf.queryExecution().optimizedPlan().toString()
    inner = [line for line in plan.splitlines() if "Join Inner" in line]
    assert inner and all("_phrase" in line and "_length" in line for line in inner)


def test_words_far_into_the_text_are_found(extract):
    assert extract("word " * 30_000 + "Tesla") == {("Tesla", "ORG", 1)}


@pytest.mark.parametrize("text, expected", [
    ("gpt-5 pro-max", "Gpt-5 Pro-Max"), ("MCDONALD'S", "Mcdonald'S"), ("éLAN vital", "Élan Vital"), ("", "")])
def test_title_case(spark, text, expected):
    assert spark.range(1).select(title_case(F.lit(text))).first()[0] == expected == text.title()


def _naive(text, phrases):
    words = re.findall(r"\w+(?:[-&'.]\w+)*|[.!?]+(?:\s|$)|[\r\n]+", text)
    spans = {(i, i + len(p)) for p in phrases for i in range(len(words)) if words[i : i + len(p)] == p}
    return sorted(s for s in spans if not any(a <= s[0] and s[1] <= b and (a, b) != s for a, b in spans))


def test_phrases_of_all_lengths_equal_a_naive_search(spark):
    rng = random.Random(4)
    names = [f"W{k}" for k in range(9)]
    phrases = [[rng.choice(names) for _ in range(n)] for n in (1, 2, 2, 3, 3, 4, 5, 7, 8, 9, 16, 17, 33, 50)]
    texts = []
    for k in range(60):
        parts = [" ".join(rng.choice(phrases)[: rng.choice([None, None, 3])]) for _ in range(rng.randrange(6))]
        texts.append((f"p{k}", " ".join([*parts, *rng.choices(names, k=rng.randrange(9))])))
    table = spark.createDataFrame([(" ".join(p), "ORG") for p in phrases], "phrase string, entity_type string")
    found = {}
    for r in en.mentions(spark.createDataFrame(texts, "post_id string, _text string"), table).collect():
        found.setdefault(r.post_id, set()).add((r.start, r.end))
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, t in texts if (v := _naive(t, phrases))}


def test_a_long_phrase_does_not_widen_other_rows(spark):
    """Words are followed as far as some phrase goes on like them, not as far as the longest phrase."""
    long = " ".join(f"L{k}" for k in range(50))
    text = "Acme met Foo Bar and Foo alone, then L0 L1 and L0 L1 L2 L3 other " + "nothing " * 200 + long
    texts = spark.createDataFrame([("a", text)], "post_id string, _text string")
    phrases = en._phrases(spark.createDataFrame([("Acme", "ORG"), ("Foo Bar", "ORG"), (long, "ORG")], "phrase string, entity_type string"))
    rows = {(r.start, r._next[0], len(r._next)) for r in en._begun(texts, phrases, 50, 3).collect()}
    assert {(w, n) for _, w, n in rows} == {("Acme", 1), ("Foo", 3), ("Foo", 1), ("L0", 3), ("L0", 7), ("L0", 50)}


def test_a_crowded_trie_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(en, "TRIE_BITS", 64)
    table = spark.createDataFrame([(f"Name{k} Part{k}", "ORG") for k in range(300)], "phrase string, entity_type string")
    texts = spark.createDataFrame([("a", "Name5 Part5, Name6 Part7 and Name299 Part299")], "post_id string, _text string")
    assert {r.entity_text for r in en.mentions(texts, table).collect()} == {"Name5 Part5", "Name299 Part299"}
