"""Hourly keywords: TF-IDF for buckets with enough posts, plain counts for the others.

A bucket is one subreddit in one hour. Posts are never gathered per bucket: terms are counted
inside each post, combined on the map side by (bucket, term), and only then shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from chatterscope.constants import (
    CUSTOM_STOPWORDS, MAX_FEATURES, MIN_DOCS, TOP_KEYWORDS, UNKNOWN_SUBREDDIT,
)
from chatterscope.functions.arrays import repeats, run_starts, settled, unnest, unnest_structs
from chatterscope.functions.numbers import round_half_up
from chatterscope.functions.text import bigrams, clean, keep_words, post_text, words
from chatterscope.functions.times import hour_of
from chatterscope.operators.broadcasts import small
from chatterscope.operators.toplists import top_n_per_group
from chatterscope.resources import english_stopwords

BUCKET = ["subreddit", "hour_bucket"]

#: Weights of terms are added up as whole numbers of this part.
SCORE_UNITS = 1e9


def bucketed(posts: DataFrame) -> DataFrame:
    """Posts with their bucket and cleaned text; posts without a time belong to no bucket.

    Stated here, the null check is the same in all plans, so they can share a shuffle. Otherwise
    Spark adds it below the join alone.
    """
    return posts.select(
        F.coalesce("subreddit", F.lit(UNKNOWN_SUBREDDIT)).alias("subreddit"),
        hour_of(F.col("created_utc")).alias("hour_bucket"),
        "post_id",
        clean(post_text(F.col("title"), F.col("body"))).alias("cleaned"),
    ).where(F.col("hour_bucket").isNotNull())


def post_buckets(posts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Bucket sizes and whether a bucket is large enough for TF-IDF."""
    return (
        posts.groupBy(
            F.coalesce("subreddit", F.lit(UNKNOWN_SUBREDDIT)).alias("subreddit"),
            hour_of(F.col("created_utc")).alias("hour_bucket"),
        )
        .agg(F.count(F.lit(1)).alias("posts"))
        .withColumn("uses_tfidf", F.col("posts") >= min_docs)
    )


def word_frequency(posts: DataFrame) -> DataFrame:
    """How often each word of the cleaned texts occurs per bucket."""
    return (
        unnest(bucketed(posts), BUCKET, words(F.col("cleaned")))
        .groupBy(*BUCKET, F.col("item").alias("word"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def word_counts(posts: DataFrame, stopwords: list[str] | None = None) -> DataFrame:
    """Total count and number of posts of each word that is no stop word, per bucket.

    Under the empty word it holds the number of posts. Rows of several batches of posts are made one by
    ``merged_counts``, so a stored table of them is all that a late post has to be added to.

    Each post emits its distinct words and apart from them its repeats. Both combine on the map
    side, and no shuffle by post is needed to count posts.
    """
    english = english_stopwords() if stopwords is None else list(stopwords)
    return _counted(_kept(bucketed(posts), english), F.concat(F.array(F.lit("")), "_kept"))


def _kept(cleaned: DataFrame, english: list[str]) -> DataFrame:
    return settled(cleaned, "_kept", keep_words(F.col("cleaned"), [*CUSTOM_STOPWORDS, *english])).select(*BUCKET, "_kept")


def _counted(posts: DataFrame, terms: Column) -> DataFrame:
    """How often each term occurs per bucket, and in how many posts."""
    ordered = posts.select(*BUCKET, F.sort_array(terms).alias("_terms"))
    return (
        ordered.select(
            *BUCKET,
            F.posexplode(F.array(F.array_distinct("_terms"), repeats("_terms")))
            .alias("_again", "_part"),
        )
        .select(*BUCKET, "_again", F.explode("_part").alias("term"))
        .groupBy(*BUCKET, "term")
        .agg(F.count(F.lit(1)).alias("count"), F.sum(1 - F.col("_again")).alias("df"))
    )


def merged_counts(parts: DataFrame) -> DataFrame:
    """Counts of several batches of posts as one."""
    return parts.groupBy(*BUCKET, "term").agg(F.sum("count").alias("count"), F.sum("df").alias("df"))


def _ranking() -> WindowSpec:
    """Terms of a bucket, most frequent first, then by name. The empty term leads."""
    return Window.partitionBy("hour_bucket", "subreddit").orderBy(
        F.desc(F.col("term") == ""), F.desc("count"), "term"
    )


def leading_words(counts: DataFrame, max_features: int, min_docs: int) -> DataFrame:
    """One row per large bucket: its number of posts, its leading words, and which words pairs are made of.

    Among equals single words rank before pairs. So a pair that does not occur more often than the last of
    ``max_features`` words can't be in the vocabulary, nor can one with a word that does not. ``pairable`` has a bit
    for the hash of each word that does. It is null if the bucket has fewer words, where any pair may count.

    Each task hands on at most that many rows of a bucket, so a hot bucket is small from here on,
    however long the stop lists are.
    """
    whole = Window.partitionBy("hour_bucket", "subreddit")
    ranked = (
        counts.withColumn("_rank", F.row_number().over(_ranking()))
        .where(F.col("_rank") <= max_features + 1)
        .withColumn("posts", F.max(F.when(F.col("term") == "", F.col("count"))).over(whole))
        .where((F.col("term") != "") & (F.col("posts") >= min_docs))
    )
    rows = ranked.groupBy("hour_bucket", "subreddit", "posts").agg(
        F.collect_list(F.struct("term", "count", "df")).alias("words"),
        F.max(F.when(F.col("_rank") == max_features + 1, F.col("count"))).alias("least"),
    )
    common = F.transform(F.filter("words", lambda w: w["count"] > F.col("least")), lambda w: _bit(w["term"]))

    def lane(i):
        own = F.filter("_bits", lambda bit: F.shiftright(bit, 6) == i)
        return F.aggregate(own, F.lit(0).cast("long"), lambda all_, bit: all_.bitwiseOR(_one_at(bit)))

    lanes = F.transform(F.sequence(F.lit(0), F.lit(_LANES - 1)), lane)
    rows = settled(rows, "_bits", common)
    return rows.withColumn("pairable", F.when(F.col("least").isNotNull(), lanes)).drop("_bits")


#: Longs in the bit set of a bucket's words.
_LANES = 64


def _bit(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(64 * _LANES)).cast("int")


def _one_at(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit % 64)


def pair_counts(cleaned: DataFrame, leading: DataFrame, english: list[str], max_features: int) -> DataFrame:
    """One row per large bucket with the pairs of words that may be in its vocabulary, ``max_features`` at most.

    Pairs are built after the removal of stop words, so they bridge removed words. Only those that can still enter
    are built and shuffled, with a few whose words share the bit of another; these rank behind all words.
    """
    sides = leading.select(F.struct(*BUCKET).alias("_bucket"), "pairable")
    kept = _kept_in_buckets(cleaned, sides, english, "pairable")
    def known(word, bit):
        return F.when(F.get("pairable", F.shiftright(bit, 6)).bitwiseAND(_one_at(bit)) != 0, word)

    hashed = settled(kept, "_bits", F.when(F.col("pairable").isNotNull(), F.transform("_kept", _bit)))
    words = F.coalesce(F.zip_with("_kept", "_bits", known), F.col("_kept"))
    pairs = hashed.select(*BUCKET, words.alias("_word"))
    counts = _counted(settled(pairs, "_pairs", bigrams(F.col("_word"))), F.col("_pairs"))
    by_count = Window.partitionBy("hour_bucket", "subreddit").orderBy(F.desc("count"), "term")
    ranked = counts.withColumn("_rank", F.row_number().over(by_count)).where(F.col("_rank") <= max_features)
    return ranked.groupBy("hour_bucket", "subreddit").agg(F.collect_list(F.struct("term", "count", "df")).alias("pairs"))


def vocabulary(leading: DataFrame, pairs: DataFrame, max_features: int) -> DataFrame:
    """One row per large bucket with the terms TF-IDF weighs: their names, counts and idfs.

    Plain arrays, as Spark would otherwise take a field out of an array of structs again for every
    term that looks into it.
    """
    both = leading.select(*BUCKET, "posts", "words").join(pairs, BUCKET, "left")

    def ranked(terms: str, pair: bool) -> Column:
        return F.transform(terms, lambda t: F.struct(
            (-t["count"]).alias("order"), F.lit(pair).alias("pair"), t["term"].alias("term"),
            (F.log((1 + F.col("posts")) / (1 + t["df"])) + 1).alias("idf"),
        ))

    every = F.concat(ranked("words", False), F.when(F.col("pairs").isNull(), F.array()).otherwise(ranked("pairs", True)))
    terms = both.select(*BUCKET, "posts", F.slice(F.sort_array(every), 1, max_features).alias("_vocab"))
    return terms.select(
        *BUCKET, "posts",
        F.col("_vocab.term").alias("names"),
        F.transform("_vocab.order", lambda n: -n).alias("counts"),
        F.col("_vocab.idf").alias("idfs"),
    )


def _kept_in_buckets(cleaned: DataFrame, sides: DataFrame, english: list[str], *carried: str) -> DataFrame:
    """The words of the posts of some buckets, next to columns of their bucket.

    Posts meet the row of their bucket as whole rows: words are shuffled once, and both joins of the job read the
    same shuffle. A hot bucket is split by Spark's skew join, as its other side is a single row. The bucket as a struct
    is a key of its own. It makes Spark shuffle both sides for the join, which is what its skew join can split, and
    shuffle again for the sums after it, so that a hot bucket stays spread over many tasks until it is added up.
    """
    rows = _kept(cleaned, english).select(F.struct(*BUCKET).alias("_bucket"), *BUCKET, "_kept")
    return rows.join(sides.hint("merge"), "_bucket").select(*BUCKET, *carried, "_kept")


def _with_places(sides: DataFrame) -> DataFrame:
    """Adds ``places``: for each bit of a name's hash, which name it is, from 1; below 0 if several names share the bit."""
    entries = F.array_sort(F.transform("names", lambda name, i: F.struct(_bit(name).alias("bit"), (i + 1).alias("k"))))
    every = settled(sides, "_all", entries)
    signed = F.transform("_all", lambda e, i: F.struct(
        e["bit"].alias("bit"), F.when(F.get(F.col("_all"), i + 1)["bit"] == e["bit"], -e["k"]).otherwise(e["k"]).alias("k"),
    ))
    once = F.filter(signed, lambda e, i: (i == 0) | (e["bit"] != F.get(F.col("_all"), i - 1)["bit"]))

    def filled(entry, i):
        before = F.coalesce(F.get(F.col("_once"), i - 1)["bit"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0), entry["bit"] - before - 1), F.array(entry["k"]))

    own = settled(every, "_once", once)
    return own.withColumn("places", F.flatten(F.transform("_once", filled))).drop("_all", "_once")


def _place(term: Column) -> Column:
    """Where a term of the vocabulary stands in it, from 1; 0 or null for others. Only names that share a bit are searched for."""
    found = F.get("places", _bit(term))
    alone = F.when(F.get("names", found - 1) == term, found)
    return F.when(found > 0, alone).when(found < 0, F.array_position("names", term).cast("int"))


def _tfidf(cleaned: DataFrame, vocab: DataFrame, english: list[str], top_n: int) -> DataFrame:
    """Scores the vocabulary of each large bucket.

    Weights and norm are worked out inside the post, from the few terms it shares with the vocabulary, so
    what follows is a sum that combines on the map side.
    """
    sides = _with_places(vocab.select(F.struct(*BUCKET).alias("_bucket"), "names", "idfs"))
    kept = _kept_in_buckets(cleaned, sides, english, "names", "idfs", "places")
    # Both words of a pair are in the vocabulary if the pair is, so the others go before pairs are built.
    may_be = F.transform("_kept", lambda w: F.when(F.get("places", _bit(w)) != 0, w))
    known = settled(kept, "_known", may_be).drop("_kept")
    places = F.transform(F.concat(F.array_compact("_known"), bigrams(F.col("_known"))), _place)
    # From here on terms are numbers, which sort and compare much faster than their names.
    sorted_ = settled(known, "_ks", F.sort_array(F.filter(places, lambda k: k > 0))).select(*BUCKET, "idfs", "_ks")
    runs = settled(sorted_, "_starts", run_starts("_ks"))

    def counted(start, i):
        end = F.coalesce(F.get(F.col("_starts"), i + 1), F.size("_ks"))
        return F.struct(F.get(F.col("_ks"), start).alias("k"), (end - start).alias("tf"))

    def weighed(entry):
        return F.struct(entry["k"].alias("k"), (entry["tf"] * F.get("idfs", entry["k"] - 1)).alias("w"))

    counts = runs.select(*BUCKET, "idfs", F.transform("_starts", counted).alias("_counts"))
    weights = counts.select(*BUCKET, F.transform("_counts", weighed).alias("_weights"))
    norm = F.sqrt(F.aggregate("_weights", F.lit(0.0), lambda sum_, e: sum_ + e["w"] * e["w"]))
    sums = (
        unnest_structs(
            weights.select(*BUCKET, "_weights", norm.alias("_norm")), [*BUCKET, "_norm"], F.col("_weights")
        )
        .groupBy(*BUCKET, "k")
        .agg(F.sum(F.round(F.col("w") / F.col("_norm") * SCORE_UNITS).cast("long")).alias("sum"))
        .groupBy(*BUCKET)
        .agg(F.collect_list(F.struct("k", "sum")).alias("_sums"))
    )
    return _best_with_frequency(sums.join(vocab, BUCKET), top_n)


def _best_with_frequency(buckets: DataFrame, top_n: int) -> DataFrame:
    """The best terms of each bucket by mean score, ties by name, with their frequency. Scores are whole units, so
    that neither order nor rounding depends on the order in which posts are added up.

    Frequency is the sum of the bucket-wide counts of a term's words. These are in the vocabulary
    whenever a pair of them is: a word is at least as frequent as its pairs and ranks first among
    equals.
    """
    scored = F.transform(
        "_sums",
        lambda s: F.struct(
            (-s["sum"]).alias("order"),
            F.get("names", s["k"] - 1).alias("term"),
        ),
    )
    ordered = buckets.select(*BUCKET, "posts", "names", "counts", F.slice(F.sort_array(scored), 1, top_n).alias("_best"))

    def count_of(word):
        return F.get("counts", F.array_position("names", word).cast("int") - 1)

    best = F.transform(
        "_best",
        lambda entry: F.struct(
            entry["term"].alias("keyword"),
            F.aggregate(
                F.split(entry["term"], " "), F.lit(0).cast("long"), lambda sum_, w: sum_ + count_of(w)
            ).alias("frequency"),
            round_half_up(-entry["order"] / F.col("posts") / SCORE_UNITS, 4).alias("tfidf_score"),
        ),
    )
    return unnest_structs(ordered, BUCKET, best)


def tfidf_keywords(
    posts: DataFrame,
    stopwords: list[str] | None = None,
    top_n: int = TOP_KEYWORDS,
    max_features: int = MAX_FEATURES,
    min_docs: int = MIN_DOCS,
    counts: DataFrame | None = None,
    stage: str | None = None,
) -> DataFrame:
    """The ``top_n`` terms by mean normalised TF-IDF of each bucket of at least ``min_docs`` posts.

    ``counts`` are the ``word_counts`` of these posts, if they are known already. Leading words and vocabularies are
    looked at twice each; with a folder to ``stage`` them in they are worked out once. It may go once the rows are stored.
    """
    english = english_stopwords() if stopwords is None else list(stopwords)
    cleaned = bucketed(posts)
    leading = leading_words(word_counts(posts, english) if counts is None else counts, max_features, min_docs)
    if stage is not None:
        leading = _staged(leading, f"{stage}/leading")
    vocab = vocabulary(leading, pair_counts(cleaned, leading, english, max_features), max_features)
    if stage is not None:
        vocab = _staged(vocab, f"{stage}/vocabulary")
    return _tfidf(cleaned, vocab, english, top_n)


def _staged(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def frequency_keywords(
    posts: DataFrame, top_n: int = TOP_KEYWORDS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The ``top_n`` words by count of each bucket of fewer than ``min_docs`` posts, ties by name.

    Only the short custom stop list applies here. Bucket sizes come first, so the texts of large
    buckets are not taken apart.
    """
    sizes = post_buckets(posts, min_docs).where(~F.col("uses_tfidf") & F.col("hour_bucket").isNotNull())
    texts = bucketed(posts).join(small(sizes.select(*BUCKET)), BUCKET, "left_semi")
    counts = (
        unnest(texts, BUCKET, keep_words(F.col("cleaned"), CUSTOM_STOPWORDS))
        .groupBy(*BUCKET, F.col("item").alias("keyword"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    best = top_n_per_group(counts, BUCKET, [F.desc("frequency"), F.col("keyword")], top_n).drop("rank")
    return best.withColumn("tfidf_score", F.col("frequency").cast("double"))


def keyword_trends(
    posts: DataFrame,
    stopwords: list[str] | None = None,
    top_n: int = TOP_KEYWORDS,
    max_features: int = MAX_FEATURES,
    min_docs: int = MIN_DOCS,
    counts: DataFrame | None = None,
    stage: str | None = None,
) -> DataFrame:
    """Keyword rows of all buckets, by TF-IDF or by count depending on the bucket's size.

    ``is_trending`` is written as false; the trend view derives the flag.
    """
    return (
        tfidf_keywords(posts, stopwords, top_n, max_features, min_docs, counts, stage)
        .unionByName(frequency_keywords(posts, top_n, min_docs))
        .withColumn("is_trending", F.lit(False))
    )
