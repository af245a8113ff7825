import datetime as dt
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatterscope import resources as rs
from chatterscope.constants import CUSTOM_STOPWORDS
from chatterscope.operators import keywords as kw

NOW = dt.datetime(2024, 5, 1, 10, 20)
SCHEMA = "post_id string, subreddit string, title string, body string, created_utc timestamp_ntz"


def posts_of(spark, titles, subreddit="technology", at=NOW):
    return spark.createDataFrame(
        [(f"{subreddit}{i}", subreddit, t, "", at) for i, t in enumerate(titles)], SCHEMA
    )


def by_hand(titles, max_features=500, top_n=20):
    """TF-IDF of one bucket, the long way."""
    english = set(rs.english_stopwords()) | set(CUSTOM_STOPWORDS)
    cleaned = [" ".join(re.sub("[^a-z]", " ", re.sub(r"https?://\S+", " ", t.lower())).split()) for t in titles]
    docs = []
    for text in cleaned:
        tokens = [w for w in text.split() if len(w) >= 3 and w not in english]
        docs.append(Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]))
    total = sum(docs, Counter())
    vocab = sorted(total, key=lambda t: (-total[t], " " in t, t))[:max_features]
    n, scores = len(docs), Counter()
    idf = {t: math.log((1 + n) / (1 + sum(t in d for d in docs))) + 1 for t in vocab}
    for d in docs:
        weights = {t: d[t] * idf[t] for t in vocab if d[t]}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        for t, w in weights.items():
            scores[t] += w / norm
    words = Counter(" ".join(cleaned).split())
    best = sorted(vocab, key=lambda t: (-round(scores[t], 8), t))[:top_n]
    return {(t, sum(words[w] for w in t.split()), round(scores[t] / n, 4)) for t in best}


def rows(df):
    return {(r.keyword, r.frequency, r.tfidf_score) for r in df.collect()}


def test_three_posts(spark):
    titles = [
        "A model of the harbour model https://x.io/a,b",
        "The model model debate heats up",
        "New model beats the old model on reasoning tasks",
    ]
    assert rows(kw.tfidf_keywords(posts_of(spark, titles))) == by_hand(titles)


def test_random_bucket_with_a_cut_vocabulary(spark):
    rng = random.Random(7)
    names = [a + b for a in ("bar", "fen", "gol", "hut", "kim") for b in ("da", "lo", "mi", "nu", "ra", "se")]
    titles = [" ".join(rng.choices(names, k=rng.randint(0, 60))) for _ in range(40)]
    got = kw.tfidf_keywords(posts_of(spark, titles), max_features=25, top_n=10)
    assert rows(got) == by_hand(titles, 25, 10)


def test_repeated_title_gives_rows(spark):
    got = kw.keyword_trends(posts_of(spark, ["Rain over the harbour, rain over all hills"] * 6)).collect()
    assert got and {"keyword", "frequency", "subreddit", "hour_bucket"} <= set(got[0].asDict())
    assert {r.keyword for r in got} == {
        "rain", "harbour", "hills", "rain harbour", "harbour rain", "rain hills"}
    assert {r.frequency for r in got if r.keyword == "rain harbour"} == {18}
    assert not any(r.is_trending for r in got)
    assert {r.hour_bucket for r in got} == {dt.datetime(2024, 5, 1, 10)}


def test_no_posts_no_rows(spark):
    assert kw.keyword_trends(posts_of(spark, [])).count() == 0


def test_only_stop_words_no_rows(spark):
    assert kw.keyword_trends(posts_of(spark, ["the and of", "it is", ""])).count() == 0


def test_subreddits_apart(spark):
    both = posts_of(spark, ["ferries leave"]).union(posts_of(spark, ["harbour dues"], "stocks"))
    got = kw.keyword_trends(both).collect()
    assert {(r.subreddit, r.keyword) for r in got} == {
        ("technology", "ferries"), ("technology", "leave"), ("stocks", "harbour"), ("stocks", "dues")}


def test_small_bucket_counts_words_and_keeps_english_ones(spark):
    got = rows(kw.keyword_trends(posts_of(spark, ["the cat and the dog like it", "the end"])))
    assert got == {("the", 3, 3.0), ("and", 1, 1.0), ("cat", 1, 1.0), ("dog", 1, 1.0), ("end", 1, 1.0)}


def test_small_bucket_keeps_top_words_behind_many_pairs(spark):
    rng = random.Random(3)
    words = [a + b + c for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    titles = [" ".join(rng.choices(words, k=3000)), " ".join(rng.choices(words[:40], k=500))]
    count = Counter(" ".join(titles).split())
    expected = {(w, n, float(n)) for w, n in sorted(count.items(), key=lambda e: (-e[1], e[0]))[:20]
                if w not in CUSTOM_STOPWORDS}
    assert rows(kw.frequency_keywords(posts_of(spark, titles))) == expected
    assert rows(kw.keyword_trends(posts_of(spark, titles))) == expected


def test_missing_subreddit_is_unknown(spark):
    posts = spark.createDataFrame([("a", None, "robots", None, NOW)], SCHEMA)
    assert [r.subreddit for r in kw.keyword_trends(posts).collect()] == ["unknown"]


def test_hot_bucket_is_cut_down_before_it_meets_in_one_task(spark):
    stop = [f"stop{k}" for k in range(2000)]
    plan = kw.keyword_trends(posts_of(spark, ["robots rise"] * 3), stop)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 501, Partial" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.mark.parametrize("posts, uses", [(2, False), (3, True)])
def test_bucket_size(spark, posts, uses):
    row = kw.post_buckets(posts_of(spark, ["x"] * posts)).first()
    assert (row.posts, row.uses_tfidf) == (posts, uses)


def test_hot_bucket_can_be_split_in_the_join_and_is_summed_before_it_meets(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = kw.tfidf_keywords(posts_of(spark, ["robots rise"] * 3))
        plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_bucket], [_bucket]" in plan
    # One row per bucket for pairs and one for the vocabulary meet the same shuffle of the posts.
    assert plan.count("Exchange hashpartitioning(_bucket,") == 2 * plan.count("SortMergeJoin [_bucket], [_bucket]") > 2
    assert "Exchange hashpartitioning(subreddit, hour_bucket, k" in plan


@pytest.mark.parametrize("features", [3, 8, 15])
def test_pairs_that_cannot_enter_are_not_built(spark, features):
    """Frequent and rare words mixed, so that pairs of rare ones fall out before they are counted."""
    rng = random.Random(features)
    names = [a + b for a in ("bar", "fen", "gol", "hut", "kim", "lum") for b in ("da", "lo", "mi", "nu", "ra")]
    weights = [1 / (k + 1) ** 1.5 for k in range(len(names))]
    titles = [" ".join(rng.choices(names, weights, k=rng.randint(1, 50))) for _ in range(12)]
    posts = posts_of(spark, titles)
    leading = kw.leading_words(kw.word_counts(posts), features, 3)
    pairs = kw.pair_counts(kw.bucketed(posts), leading, rs.english_stopwords(), 10_000).first().pairs
    every = {p for t in titles for p in map(" ".join, zip(t.split(), t.split()[1:]))}
    assert len({p.term for p in pairs}) < 0.8 * len(every)
    assert rows(kw.tfidf_keywords(posts, max_features=features, top_n=5)) == by_hand(titles, features, 5)


def test_counts_of_batches_make_the_same_keywords(spark):
    titles = ["ferry harbour ferry", "harbour dues", "ferry leaves harbour", "storm harbour", "ferry storm"]
    posts = posts_of(spark, titles)
    parts = [kw.word_counts(posts.where(f"post_id {where} 'technology2'")) for where in ("<", ">=")]
    merged = kw.merged_counts(parts[0].unionByName(parts[1]))
    assert rows(kw.tfidf_keywords(posts, counts=merged)) == rows(kw.tfidf_keywords(posts)) == by_hand(titles)


def test_places_of_names_by_hash(spark):
    """Every name is found where it stands, also where names share a bit; other terms are no names."""
    names = [f"name{k}" for k in range(500)] + ["one two"]
    sides = spark.createDataFrame([(names,), ([],)], "names array<string>")
    rows = kw._with_places(sides).where("size(names) > 0").select("names", "places", F.explode("names").alias("name"))
    got = rows.select("name", kw._place(F.col("name")).alias("k"), kw._bit(F.col("name")).alias("bit")).collect()
    assert [r.k for r in got] == list(range(1, 502)) and len({r.bit for r in got}) < 501
    assert kw._with_places(sides).select(F.size("places").alias("n")).where("n = 0").count() == 1


def test_staged_vocabularies_are_worked_out_once(spark, tmp_path):
    """With a stage the stored counts are ranked once, so the rows no longer depend on them, and are the same."""
    texts = [(f"p{i}", "s", "harbour ferry", f"ferry{i % 4} lights harbour word{'abcdefgh'[i % 8]} ferry", i // 5) for i in range(20)]
    posts = spark.createDataFrame(texts, "post_id string, subreddit string, title string, body string, h int").withColumn(
        "created_utc", F.expr("TIMESTAMP_NTZ'2024-01-01 00:10:00' + make_dt_interval(0, h)"))
    for k in (0, 1):
        kw.word_counts(posts.where(f"hash(post_id) % 2 {'=' if k else '!='} 0")).write.parquet(str(tmp_path / f"counts/batch={k}"))
    counts = kw.merged_counts(spark.read.parquet(str(tmp_path / "counts")))
    got = kw.keyword_trends(posts, counts=counts, stage=str(tmp_path / "stage"))
    assert not any("/counts/" in f for f in got.inputFiles())
    expected = kw.keyword_trends(posts)
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count() and got.count() > 0


def test_names_that_share_a_bit_keep_their_own_places(spark):
    words = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("w")).withColumn("bit", kw._bit(F.col("w")))
    shared = words.groupBy("bit").agg(F.sort_array(F.collect_list("w")).alias("ws")).where("size(ws) >= 3").orderBy("bit").first()
    one, two, absent = shared.ws[:3]
    other = words.where(F.col("bit") != shared.bit).orderBy("w").first().w
    sides = kw._with_places(spark.createDataFrame([([two, other, one],)], "names array<string>"))
    found = sides.select(*[F.coalesce(kw._place(F.lit(w)), F.lit(0)) for w in (two, other, one, absent, "none of these")]).first()
    assert tuple(found) == (1, 2, 3, 0, 0)
