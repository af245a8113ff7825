"""Every operator as a named query over the given tables.

Each takes the session and the folder of the tables and runs over whole tables and texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chatterscope import fixtures as fx, resources as rs
from chatterscope.functions import text as tx
from chatterscope.functions.times import from_epoch, latest, on_day, recent
from chatterscope.operators import (
    entities as en, keywords as kw, orders, plugins, sentiment as se, summaries as su, toplists, trends as tr,
)
from chatterscope.session import scratch_dir
from chatterscope.sinks import tables as sk
from chatterscope.schemas import LANDED_POST, RSS_ITEM
from chatterscope.sources import posts as ps, rss
from chatterscope.sources.isolated import read_isolated
from chatterscope.streaming.live import start_exact_dedup, stream_dedup, stream_hourly_sentiment
from chatterscope.streaming.metrics import ATTEMPTED, INSERTED, MetricsListener, counted, stored_metrics
from chatterscope.streaming.pipeline import SideTables, Tables, delete_stored_posts, run_batch, run_rss_batch, start_feeds, start_pipeline

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _as_of(posts: DataFrame):
    return latest(posts, "created_utc")


def _tk(spark, d):
    return tr.trending_keywords(fx.keyword_trends(spark, d))


def _tk_as_of(spark, d):
    return latest(fx.keyword_trends(spark, d), "hour_bucket")


def _surge(spark, d):
    return su.entity_surge(fx.entities(spark, d), fx.wide_posts(spark, d), fx.sentiment(spark, d))


def _by_hour(spark, d):
    return su.sentiment_by_hour(fx.wide_posts(spark, d), fx.sentiment(spark, d))


def _tables(spark) -> Tables:
    """New tables for a query; few keys need few buckets."""
    return Tables(scratch_dir(spark, "tables"), key_buckets=4)


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows already stored and rows still arriving, by a hash of the key; they overlap."""
    part = F.conv(F.left(F.md5("post_id"), F.lit(4)), 16, 10).cast("long") % 4
    return df.where(part <= 2), df.where(part >= 2)


# Sources


@query
def read_posts(spark, d):
    path = scratch_dir(spark, "landed")
    fx.landed_posts(spark, d).write.json(path)
    return ps.parsed(ps.read_posts(spark, path))


@query
def normalize_post(spark, d):
    return ps.normalize_post(fx.landed_posts(spark, d))


@query
def select_listing(spark, d):
    posts = fx.raw_posts(spark, d).select("post_id", "subreddit", "score", "created_utc")
    return ps.union_sources(*[
        ps.select_listing(posts, sort).withColumn("listing", F.lit(sort)) for sort in ("new", "top", "hot")
    ])


@query
def read_targets(spark, d):
    posts = fx.raw_posts(spark, d).select("post_id", "subreddit", "created_utc", "score")
    return ps.read_targets(posts, "en, fr", limit=50)


@query
def read_rss(spark, d):
    path = scratch_dir(spark, "feeds")
    fx.rss_items(spark, d).write.partitionBy("feed").format("xml").option("rowTag", "item").option(
        "rootTag", "channel"
    ).save(path)
    return rss.read_rss(spark, path, rs.feed_map(spark), "2024-01-31 00:00:00")


@query
def rss_key(spark, d):
    return rss.rss_key(fx.rss_items(spark, d)).select("link", "post_id", "legacy_key")


@query
def feed_topic_join(spark, d):
    return rss.feed_topic_join(fx.rss_items(spark, d), rs.feed_map(spark)).select("feed", "topic", "link")


@query
def rss_pipeline(spark, d):
    """Landed feeds to stored posts and title scores, all items delivered twice."""
    path, tables = scratch_dir(spark, "feeds"), _tables(spark)
    fx.rss_items(spark, d).write.partitionBy("feed").format("xml").option("rowTag", "item").option(
        "rootTag", "channel"
    ).save(path)
    sides = SideTables.shipped(spark)
    for batch in ("b0", "b1"):
        items = rss.read_items(spark, path)
        run_rss_batch(items, batch, tables, sides, rs.feed_map(spark), "2024-01-31 00:00:00")
    posts = tables.raw_posts(spark).select("post_id", "subreddit", "title", "created_utc")
    return posts.join(tables.sentiment_scores(spark).drop("dt", "batch"), "post_id")


def _dated_items(spark, d):
    """Feed items with a date of their own, in one of five spellings; every sixth has none that is known."""
    made = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("page_id"))

    def later(hours, pattern):
        return F.date_format(made + F.make_dt_interval(hours=F.lit(hours)), pattern)

    spelled = F.array(
        F.concat(later(0, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")), F.concat(later(1, "d MMM yyyy HH:mm"), F.lit(" +0100")),
        F.concat(later(0, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), F.concat(later(-5, "yyyy-MM-dd HH:mm"), F.lit("-05:00")),
        F.concat(later(-4, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" EDT")), F.lit("soon"),
    )
    pages = fx.table(spark, d, "pages").select(F.col("url").alias("link"), F.get(spelled, (F.col("page_id") % 6).cast("int")).alias("pubDate"))
    return fx.rss_items(spark, d).join(pages, "link")


@query
def rss_stream(spark, d):
    """Feeds with dates, landed twice and worked off as a stream into the tables that a stream of posts shares."""
    path, tables = scratch_dir(spark, "feeds"), _tables(spark)
    for _ in range(2):
        _dated_items(spark, d).write.mode("append").partitionBy("feed").format("xml").option("rowTag", "item").option(
            "rootTag", "channel"
        ).save(path)
        start_feeds(
            rss.stream_items(spark, path), tables.root, f"{tables.root}-feeds", rs.feed_map(spark), "2024-01-31 00:00:00",
            use_published=True, tables=tables,
        ).awaitTermination()
    posts = tables.raw_posts(spark).select("post_id", "subreddit", "title", "created_utc")
    return posts.join(tables.sentiment_scores(spark).drop("dt", "batch"), "post_id")


@query
def isolated_sources(spark, d):
    """Posts as lines and as Parquet and feeds as XML, each with something broken among it: what is read, and why the rest is not."""
    lines, columns, feeds = (scratch_dir(spark, name) for name in ("lines", "columns", "feeds"))
    posts = fx.landed_posts(spark, d)
    posts.write.json(lines)
    pages = fx.table(spark, d, "pages")
    pages.where("page_id % 7 = 0").select(F.concat(F.lit('{"post_id": '), F.col("page_id"), F.lit(" oops"))).write.mode("append").text(lines)
    posts.write.parquet(f"{columns}/whole")
    one = pages.where("page_id = 0")
    one.select(F.lit("PAR1 and no more")).coalesce(1).write.text(f"{columns}/broken")
    items = fx.rss_items(spark, d).drop("feed")
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(f"{feeds}/whole")
    one.select(F.lit("<channel><item><title>cut off")).coalesce(1).write.text(f"{feeds}/broken")
    found = []
    for kind, path, schema, key, options in (
        ("json", lines, LANDED_POST, "post_id", {}),
        ("parquet", columns, LANDED_POST, "post_id", {"recursiveFileLookup": "true"}),
        ("xml", feeds, RSS_ITEM, "link", {"recursiveFileLookup": "true", "rowTag": "item"}),
    ):
        rows, refused = read_isolated(spark, path, kind, schema, **options)
        found += [rows.select(F.col(key).alias("key")), refused.select("reason")]
        found[-2:] = [t.withColumn("kind", F.lit(kind)) for t in found[-2:]]
    return ps.union_sources(*found)


@query
def quarantine_rows(spark, d):
    """Pages landed as posts, some without a title and some as lines that do not parse, by reason."""
    path, tables = scratch_dir(spark, "landed"), _tables(spark)
    pages = fx.table(spark, d, "pages")
    posts = F.to_json(F.struct(
        F.concat(F.lit("p"), F.col("page_id")).alias("post_id"), F.lit("web").alias("source"),
        F.when(F.col("page_id") % 5 != 0, F.col("url")).alias("title"), F.lit(0.0).alias("created_epoch"),
    ))
    broken = pages.where("page_id % 7 = 0").select(F.concat(F.lit('{"post_id": '), F.col("page_id"), F.lit(" oops")))
    pages.select(posts).union(broken).write.text(path)
    run_batch(ps.read_posts(spark, path), "b0", tables, SideTables.shipped(spark))
    refused = spark.read.parquet(tables.path("quarantine"))
    return refused.groupBy(F.array_join("violations", "; ").alias("violations")).agg(F.count(F.lit(1)).alias("rows"))


@query
def scan_tables(spark, d):
    """A table written by day and read back."""
    path = scratch_dir(spark, "posts")
    posts = fx.wide_posts(spark, d)
    posts.withColumn("dt", F.to_date("created_utc")).hint("rebalance", "dt").write.partitionBy(
        "dt"
    ).parquet(path)
    return spark.read.parquet(path).groupBy("dt", "subreddit").agg(
        F.count(F.lit(1)).alias("posts")
    )


@query
def union_sources(spark, d):
    posts = fx.raw_posts(spark, d).select("post_id", "source", "subreddit", "title", "body", "created_utc")
    feeds = rss.items_to_posts(fx.rss_items(spark, d), rs.feed_map(spark), "2024-01-31 00:00:00")
    return ps.union_sources(posts, feeds)


# Sinks


@query
def append_new_posts(spark, d):
    """Twice the stored posts and the arriving ones, offered against the stored ones."""
    path = scratch_dir(spark, "raw_posts")
    posts = fx.raw_posts(spark, d)
    stored, arriving = _split(posts)
    stored.write.parquet(path)
    offered = arriving.unionByName(arriving)
    order = [F.col("created_utc"), F.col("title")]
    sk.append_counted(offered, spark.read.parquet(path), "raw_posts", order, path)
    return spark.read.parquet(path).select("post_id", "subreddit", "title", "created_utc")


def _appended(spark, table, rows, order):
    """What a stored table holds after twice the arriving rows were offered to it."""
    path = scratch_dir(spark, table)
    stored, arriving = _split(rows)
    stored.write.parquet(path)
    sk.append_counted(arriving.unionByName(arriving), spark.read.parquet(path), table, order, path)
    return spark.read.parquet(path)


@query
def append_sentiment(spark, d):
    return _appended(spark, "sentiment_scores", fx.sentiment(spark, d), [F.col("compound")])


@query
def append_entities(spark, d):
    return _appended(spark, "extracted_entities", fx.entities(spark, d), [F.col("mention_count")])


@query
def write_keyword_trends(spark, d):
    """All days written, then the second half of the month written again with the same rows."""
    path = scratch_dir(spark, "keyword_trends")
    trends = fx.keyword_trends(spark, d)
    sk.write_keyword_trends(trends, path)
    sk.write_keyword_trends(trends.where("hour_bucket >= TIMESTAMP_NTZ'2024-01-16 00:00:00'"), path)
    return spark.read.parquet(path).select("subreddit", "keyword", "hour_bucket", "frequency")


@query
def upsert_daily_summary(spark, d):
    """All days written with half the posts, then the last day replaced from all of them."""
    path = scratch_dir(spark, "daily_summary")
    posts, scores = fx.wide_posts(spark, d), fx.sentiment(spark, d)
    stored, _ = _split(posts)
    sk.upsert_daily_summary(su.daily_summary(stored, scores), path)
    sk.upsert_daily_summary(su.daily_summary(posts, scores, as_of=_as_of(posts)), path)
    return spark.read.parquet(path)


@query
def write_metrics(spark, d):
    path = scratch_dir(spark, "sentiment_scores")
    stored, arriving = _split(fx.sentiment(spark, d))
    stored.write.parquet(path)
    counts = sk.append_counted(
        arriving, spark.read.parquet(path), "sentiment_scores", [F.col("compound")], path
    )
    return spark.read.parquet(path).agg(
        F.lit(counts["attempted"]).cast("long").alias("attempted"),
        F.lit(counts["inserted"]).cast("long").alias("inserted"),
        F.count(F.lit(1)).alias("stored"),
    )


@query
def validate_contract(spark, d):
    """Pages as posts: long addresses as keys and missing titles break the contract."""
    posts = fx.table(spark, d, "pages").select(
        F.col("url").alias("post_id"), F.lit("rss").alias("source"),
        F.when(F.col("page_id") % 5 != 0, F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"),
        F.lit(None).cast("int").alias("score"),
        F.lit("2024-01-31 00:00:00").cast("timestamp_ntz").alias("created_utc"),
    )
    checked = sk.validate_contract(posts, "raw_posts")
    return checked.select("post_id", "score", F.array_join("violations", "; ").alias("violations"))


@query
def anti_existing(spark, d):
    stored, arriving = _split(fx.sentiment(spark, d))
    return sk.anti_existing(arriving, stored, ["post_id"])


@query
def fk_semi(spark, d):
    posts = fx.raw_posts(spark, d)
    scores = fx.sentiment(spark, d).select("post_id", "label")
    return sk.fk_semi(scores, posts).withColumn("state", F.lit("valid")).unionByName(
        sk.orphans(scores, posts).withColumn("state", F.lit("orphan"))
    )


@query
def delete_posts_cascade(spark, d):
    """Posts, scores and entities stored by day and batch, less the posts of one subreddit: the rows that remain."""
    tables = _tables(spark)
    posts = fx.wide_posts(spark, d)
    batch = F.when(F.col("subreddit") == "error", F.lit("b1")).when(F.hour("created_utc") < 12, F.lit("b2")).otherwise(F.lit("b3"))
    # Each third of the other posts shares its batch with those to be deleted.
    batch = F.when(F.col("title").endswith("3}"), F.lit("b1")).otherwise(batch)
    own = posts.select("post_id", F.to_date("created_utc").alias("dt"), batch.alias("batch"))
    stored = {"raw_posts": posts, "sentiment_scores": fx.sentiment(spark, d), "extracted_entities": fx.entities(spark, d)}
    for name, rows in stored.items():
        sk.overwrite_partitions(rows.join(own, "post_id"), tables.path(name), "dt", "batch")
    delete_stored_posts(posts.where("subreddit = 'error'"), tables)
    items = {"raw_posts": "subreddit", "sentiment_scores": "label", "extracted_entities": "entity_text"}
    return ps.union_sources(*[
        spark.read.parquet(tables.path(name)).select(F.lit(name).alias("name"), "post_id", F.col(item).alias("item"))
        for name, item in items.items()
    ])


# Projections and filters


@query
def combined_text(spark, d):
    title, body = F.col("title"), F.col("body")
    return fx.raw_posts(spark, d).select(
        "post_id",
        tx.sentiment_text(title, body).alias("sentiment_text"),
        tx.post_text(title, body).alias("post_text"),
    )


@query
def recent_window(spark, d):
    posts = fx.wide_posts(spark, d)
    return recent(posts, "created_utc", _as_of(posts), hours=24)


@query
def today_only(spark, d):
    posts = fx.wide_posts(spark, d)
    return on_day(posts, "created_utc", _as_of(posts))


@query
def entity_type_in(spark, d):
    return su.entity_type_in(fx.entities(spark, d))


@query
def is_trending_only(spark, d):
    return tr.is_trending_only(_tk(spark, d))


@query
def slicers(spark, d):
    return tr.slicers(
        _tk(spark, d), ["u0", "u2"],
        F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-20 23:00:00").cast("timestamp_ntz"),
    )


@query
def empty_text_guard(spark, d):
    """Bodies alone, many of which are missing, scored with the rule for blank texts."""
    texts = fx.raw_posts(spark, d).select("post_id", F.col("body").alias("_text"))
    scores = se.score_texts(texts, rs.lexicon(spark), rs.modifiers(spark))
    blank = texts.where(tx.is_blank(F.col("_text"))).select("post_id")
    return scores.join(blank, "post_id", "left_semi")


# Joins and summaries


@query
def posts_join_sentiment(spark, d):
    return su.posts_join_sentiment(
        fx.wide_posts(spark, d).select("post_id", "subreddit", "created_utc"), fx.sentiment(spark, d)
    )


@query
def entities_posts_sentiment(spark, d):
    return su.entities_posts_sentiment(
        fx.entities(spark, d), fx.wide_posts(spark, d).select("post_id", "subreddit", "created_utc"),
        fx.sentiment(spark, d).select("post_id", "compound", "label"),
    )


@query
def sentiment_by_hour(spark, d):
    return _by_hour(spark, d)


@query
def label_pct(spark, d):
    posts = fx.wide_posts(spark, d).select("post_id", "subreddit")
    return su.label_pct(su.posts_join_sentiment(posts, fx.sentiment(spark, d)), "subreddit")


@query
def entity_surge(spark, d):
    return _surge(spark, d)


@query
def sentiment_gauge(spark, d):
    posts = fx.wide_posts(spark, d)
    return su.sentiment_gauge(posts, fx.sentiment(spark, d), _as_of(posts))


@query
def pct_of_total(spark, d):
    counts = fx.wide_posts(spark, d).groupBy("subreddit").agg(F.count(F.lit(1)).alias("count"))
    return su.pct_of_total(counts, "count")


@query
def top_entities(spark, d):
    posts = fx.wide_posts(spark, d)
    return su.top_entities(fx.entities(spark, d), posts, fx.sentiment(spark, d), _as_of(posts))


@query
def daily_summary(spark, d):
    return su.daily_summary(fx.wide_posts(spark, d), fx.sentiment(spark, d))


@query
def daily_top_terms(spark, d):
    return su.daily_summary(
        fx.wide_posts(spark, d), fx.sentiment(spark, d),
        entities=fx.entities(spark, d), keywords=fx.keyword_trends(spark, d),
    ).select("summary_date", "subreddit", "total_posts", "top_entity", "top_keyword")


@query
def kpi_cards(spark, d):
    return su.kpi_cards(_by_hour(spark, d))


@query
def label_donut(spark, d):
    return su.label_donut(fx.sentiment(spark, d))


@query
def sentiment_line(spark, d):
    posts = fx.wide_posts(spark, d)
    return su.sentiment_line(posts, fx.sentiment(spark, d), _as_of(posts))


@query
def entity_table(spark, d):
    return su.entity_table(_surge(spark, d))


@query
def entity_type_breakdown(spark, d):
    return su.entity_type_breakdown(_surge(spark, d))


# Trends


@query
def trending_keywords(spark, d):
    return _tk(spark, d)


@query
def trending_keywords_strict_time(spark, d):
    return tr.trending_keywords(fx.keyword_trends(spark, d), strict_time=True)


@query
def rolling_avg_7d(spark, d):
    return tr.rolling_avg_7d(fx.keyword_trends(spark, d))


@query
def cumulative_total(spark, d):
    return tr.cumulative_total(fx.keyword_trends(spark, d))


@query
def top_keywords_now(spark, d):
    return tr.top_keywords_now(_tk(spark, d), _tk_as_of(spark, d))


@query
def trend_alerts(spark, d):
    return tr.trend_alerts(_tk(spark, d), _tk_as_of(spark, d))


@query
def alert_bands(spark, d):
    """Every keyword hour with its band; those without a ratio or below all bands have none."""
    return tr.alert_bands(_tk(spark, d)).select("subreddit", "keyword", "hour_bucket", "spike_ratio", "band")


@query
def trending_word_cloud(spark, d):
    return tr.trending_word_cloud(_tk(spark, d))


@query
def top15_keywords(spark, d):
    """The fixture has three keywords, so the series of each subreddit counts as one here."""
    trends = fx.keyword_trends(spark, d)
    return tr.top_keywords(trends.withColumn("keyword", F.concat_ws("/", "subreddit", "keyword")))


@query
def keyword_timeline(spark, d):
    return tr.keyword_timeline(_tk(spark, d), _tk_as_of(spark, d), ["u1"])


@query
def trend_view_order(spark, d):
    """The trend view as it is shown, with places: hours without a ratio come last in their hour."""
    return orders.with_positions(_tk(spark, d), orders.trend_view_order())


@query
def timeline_order(spark, d):
    """The week's keyword lines as they are shown, with places: hours without a ratio come first in their hour."""
    line = tr.keyword_timeline(_tk(spark, d), F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    return orders.with_positions(line, orders.timeline_order())


@query
def display_orders(spark, d):
    """The gauge by count and the sentiment line by hour, with places."""
    posts, scores = fx.wide_posts(spark, d), fx.sentiment(spark, d)
    gauge = su.sentiment_gauge(posts, scores, _as_of(posts)).select(F.col("label").alias("item"), F.col("count").alias("value"))
    line = su.sentiment_line(posts, scores, _as_of(posts))
    line = line.select("hour_bucket", F.col("subreddit").alias("item"), F.col("total_posts").alias("value"))
    return ps.union_sources(
        orders.with_positions(gauge, [F.desc("value"), F.col("item")]).withColumn("tile", F.lit("gauge")),
        orders.with_positions(line, [F.col("hour_bucket"), F.col("item")]).drop("hour_bucket").withColumn("tile", F.lit("line")),
    )


@query
def top_n_per_group(spark, d):
    order = [F.desc("frequency"), F.desc("hour_bucket"), F.col("keyword")]
    return toplists.top_n_per_group(fx.keyword_trends(spark, d), ["subreddit"], order, 20)


# Texts


@query
def clean_text(spark, d):
    return fx.raw_posts(spark, d).select(
        "post_id", tx.clean(tx.post_text(F.col("title"), F.col("body"))).alias("cleaned")
    )


@query
def post_buckets(spark, d):
    return kw.post_buckets(fx.raw_posts(spark, d))


@query
def word_frequency(spark, d):
    return kw.word_frequency(fx.raw_posts(spark, d))


@query
def tfidf_keywords(spark, d):
    return kw.tfidf_keywords(fx.raw_posts(spark, d))


@query
def frequency_keywords(spark, d):
    return kw.frequency_keywords(fx.raw_posts(spark, d))


@query
def keyword_trends(spark, d):
    return kw.keyword_trends(fx.raw_posts(spark, d))


@query
def lexicon_sentiment(spark, d):
    return se.lexicon_sentiment(fx.raw_posts(spark, d), rs.lexicon(spark), rs.modifiers(spark))


@query
def lexicon_sentiment_repeats(spark, d):
    """Every post twice; each has one score."""
    posts = fx.raw_posts(spark, d)
    return se.lexicon_sentiment(posts.unionByName(posts), rs.lexicon(spark), rs.modifiers(spark))


@query
def sentiment_rules(spark, d):
    """Posts whose titles go on with a phrase for each rule of idioms, emoji and "least"."""
    posts = fx.phrased_posts(spark, d, fx.RULE_PHRASES)
    return se.lexicon_sentiment(posts, rs.lexicon(spark), rs.modifiers(spark), idioms=rs.idioms(spark), emoji=rs.emoji(spark))


@query
def flatten_sentiment(spark, d):
    return se.flatten_sentiment(se.nested(fx.sentiment(spark, d)))


@query
def rss_title_sentiment(spark, d):
    items = rss.rss_key(fx.rss_items(spark, d)).select("post_id", "title")
    return se.title_sentiment(items, rs.lexicon(spark), rs.modifiers(spark))


def _texts(spark, d):
    return fx.raw_posts(spark, d).select(
        "post_id", tx.post_text(F.col("title"), F.col("body")).alias("_text")
    )


@query
def entity_counts(spark, d):
    return en.entity_counts(en.mentions(_texts(spark, d), rs.gazetteer(spark)))


@query
def gazetteer_entities(spark, d):
    """Entities of the raw documents."""
    documents = fx.table(spark, d, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("post_id"), F.col("text").alias("_text")
    )
    return en.gazetteer_entities(documents, rs.gazetteer(spark))


@query
def entity_cleanup(spark, d):
    """Titles as if they were entity texts."""
    return en.entity_cleanup(
        fx.raw_posts(spark, d).select("post_id", F.col("title").alias("entity_text")), "entity_text"
    )


@query
def extract_from_posts(spark, d):
    return en.extract_from_posts(fx.raw_posts(spark, d), rs.gazetteer(spark))


@query
def entity_rules(spark, d):
    """Posts whose titles go on with stop entities, overlapping phrases, broken phrases or many ties."""
    return en.extract_from_posts(fx.phrased_posts(spark, d, fx.ENTITY_PHRASES), rs.gazetteer(spark))


@query
def entity_cleanup_rules(spark, d):
    """Each title follows an entity text with something to clean, in rows of their own; some of these are dropped."""
    posts = fx.raw_posts(spark, d)
    texts = posts.select("post_id", F.explode(F.array(fx.chosen(fx.ENTITY_TEXTS), F.col("title"))).alias("entity_text"))
    return en.entity_cleanup(texts, "entity_text")


@query
def entity_repeats(spark, d):
    """Every post twice; mentions count once."""
    posts = fx.raw_posts(spark, d)
    return en.extract_from_posts(posts.unionByName(posts), rs.gazetteer(spark))


@query
def custom_scorer(spark, d):
    """A scorer of one's own: the share of exclamation marks."""
    def load():
        def score(batch):
            share = (batch["_text"].str.count("!") / batch["_text"].str.len().clip(lower=1)).round(3)
            return batch[["post_id"]].assign(
                compound=share, positive=share, negative=0.0, neutral=(1 - share).round(3), label="neutral"
            )
        return score

    return plugins.custom_batches(_texts(spark, d), load, plugins.SCORES)


# Streams


def _land(spark, d, name: str) -> str:
    """The posts in two writes. Files are as many as their join has partitions, so none grows with the input."""
    path = scratch_dir(spark, name)
    posts = fx.landed_posts(spark, d)
    for half in (0, 1):
        posts.where(F.pmod(F.xxhash64("post_id"), F.lit(2)) == half).write.mode("append").json(path)
    return path


def _work_off(stream: DataFrame, path: str) -> None:
    stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", f"{path}-checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()


@query
def hourly_pipeline(spark, d):
    """Landed files worked off in two batches; the resulting daily summary."""
    landed, tables = _land(spark, d, "landed"), _tables(spark)
    files = len(ps.read_posts(spark, landed).inputFiles())
    stream = ps.stream_posts(spark, landed, files_per_batch=(files + 1) // 2)
    start_pipeline(stream, tables.root, f"{tables.root}-checkpoint", tables=tables).awaitTermination()
    return tables.daily_summary(spark)


@query
def stream_dedup_posts(spark, d):
    """The same files landed twice; every post comes out once."""
    landed = _land(spark, d, "landed")
    fx.landed_posts(spark, d).write.mode("append").json(landed)
    out = scratch_dir(spark, "deduplicated")
    posts = ps.normalize_post(ps.parsed(ps.stream_posts(spark, landed)), None)
    _work_off(stream_dedup(posts).select("post_id", "subreddit", "created_utc"), out)
    return spark.read.parquet(out)


@query
def stream_dedup_exact(spark, d):
    """The later half of the posts, then the earlier half weeks behind the watermark, then all of them again; every
    post comes out once."""
    landed, out = scratch_dir(spark, "landed"), scratch_dir(spark, "once")
    posts = fx.landed_posts(spark, d)
    early = F.col("created_epoch") < posts.agg(F.avg("created_epoch")).scalar()
    for part in (posts.where(~early), posts.where(early), posts):
        part.write.mode("append").json(landed)
        arriving = ps.normalize_post(ps.parsed(ps.stream_posts(spark, landed))).select("post_id", "subreddit", "created_utc")
        start_exact_dedup(arriving, out, f"{out}-checkpoint", key_buckets=4).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query
def stream_metrics(spark, d):
    """Counts of two micro-batches: the later half of the posts, then all of them, most of which come too late."""
    landed, out, path = (scratch_dir(spark, name) for name in ("landed", "once", "metrics"))
    posts = fx.landed_posts(spark, d)
    late = F.col("created_epoch") < posts.agg(F.avg("created_epoch")).scalar()
    listener = MetricsListener(spark, path)
    spark.streams.addListener(listener)
    try:
        for part in (posts.where(~late), posts):
            part.write.mode("append").json(landed)
            arriving = counted(ps.normalize_post(ps.parsed(ps.stream_posts(spark, landed))), ATTEMPTED)
            kept = counted(stream_dedup(arriving), INSERTED)
            run = kept.writeStream.format("parquet").option("path", out).option(
                "checkpointLocation", f"{out}-checkpoint"
            ).trigger(availableNow=True).start()
            listener.flush(run)
    finally:
        spark.streams.removeListener(listener)
    # Batches without rows only move the watermark on.
    found = stored_metrics(spark, path).where("attempted > 0 and duration_ms >= 0")
    number = F.row_number().over(Window.partitionBy("query").orderBy("batch_id")).cast("long")
    return found.select(number.alias("batch"), "attempted", "inserted", "dropped_late")


def _scored_stream(spark, d, name: str) -> DataFrame:
    path = scratch_dir(spark, name)
    su.posts_join_sentiment(
        fx.wide_posts(spark, d).select("post_id", "subreddit", "created_utc"),
        fx.sentiment(spark, d).select("post_id", "compound", "label"),
    ).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query
def stream_hourly_sentiment_closed(spark, d):
    """Hours the watermark has closed."""
    out = scratch_dir(spark, "hourly")
    _work_off(stream_hourly_sentiment(_scored_stream(spark, d, "scored")), out)
    return spark.read.parquet(out)


@query
def late_posts(spark, d):
    """Posts that arrive day by day backwards, so all but the first day are late; the pipeline's
    keyword rows come out as if they had arrived in order. Each day is a run of the stream of its own; posts without a
    time come last."""
    landed, by_day, tables = scratch_dir(spark, "landed"), scratch_dir(spark, "by_day"), _tables(spark)
    own_day = F.to_date(from_epoch(F.col("created_epoch")))
    fx.landed_posts(spark, d).withColumn("day", own_day).write.partitionBy("day").parquet(by_day)
    posts, sides = spark.read.parquet(by_day), SideTables.shipped(spark)
    for (day,) in posts.select("day").distinct().orderBy(F.desc_nulls_last("day")).collect():
        posts.where(F.col("day").eqNullSafe(F.lit(day))).drop("day").write.mode("append").json(landed)
        stream = ps.stream_posts(spark, landed)
        start_pipeline(stream, tables.root, f"{tables.root}-checkpoint", sides, tables=tables).awaitTermination()
    return tables.keyword_trends(spark).drop("dt")


REGISTRY["stream_dedup"] = stream_dedup_posts
REGISTRY["stream_hourly_sentiment"] = stream_hourly_sentiment_closed
