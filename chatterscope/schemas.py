"""Table schemas and the column contract (nullability, lengths, defaults)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS, _DATE, _L = T.TimestampNTZType(), T.DateType(), T.LongType()


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


RAW_POSTS = _schema(
    ("post_id", _S, False), ("source", _S, False), ("subreddit", _S, True),
    ("title", _S, False), ("body", _S, True), ("author", _S, True), ("url", _S, True),
    ("score", _I, True), ("num_comments", _I, True),
    ("created_utc", _TS, False), ("collected_at", _TS, True),
)
SENTIMENT_SCORES = _schema(
    ("post_id", _S, False), ("compound", _D, False), ("positive", _D, False),
    ("negative", _D, False), ("neutral", _D, False), ("label", _S, False),
    ("scored_at", _TS, True),
)
EXTRACTED_ENTITIES = _schema(
    ("post_id", _S, False), ("entity_text", _S, False), ("entity_type", _S, False),
    ("mention_count", _L, True), ("extracted_at", _TS, True),
)
KEYWORD_TRENDS = _schema(
    ("subreddit", _S, False), ("keyword", _S, False), ("hour_bucket", _TS, False),
    ("frequency", _L, False), ("tfidf_score", _D, True), ("is_trending", _B, True),
    ("recorded_at", _TS, True),
)
WORD_COUNTS = _schema(
    ("subreddit", _S, False), ("hour_bucket", _TS, False), ("term", _S, False), ("count", _L, False), ("df", _L, False),
)
DAILY_SUMMARY = _schema(
    ("summary_date", _DATE, False), ("subreddit", _S, True), ("total_posts", _L, True),
    ("avg_sentiment", _D, True), ("positive_pct", _D, True), ("negative_pct", _D, True),
    ("neutral_pct", _D, True), ("top_entity", _S, True), ("top_keyword", _S, True),
    ("created_at", _TS, True),
)

# A listing as it lands in files: epoch seconds, everything optional.
LANDED_POST = _schema(
    ("post_id", _S, True), ("source", _S, True), ("subreddit", _S, True),
    ("title", _S, True), ("body", _S, True), ("author", _S, True), ("url", _S, True),
    ("score", _I, True), ("num_comments", _I, True), ("created_epoch", _D, True),
    ("_corrupt_record", _S, True),
)

# An RSS <item>; guid carries attributes, so its text sits in guid._VALUE.
RSS_ITEM = T.StructType([
    T.StructField("guid", T.StructType([
        T.StructField("_VALUE", _S), T.StructField("_isPermaLink", _S)])),
    T.StructField("link", _S),
    T.StructField("title", _S),
    T.StructField("pubDate", _S),
    T.StructField("_corrupt_record", _S),
])

# Longest accepted string per column.
MAX_LENGTHS = {
    "raw_posts": {"post_id": 20, "source": 20, "subreddit": 100, "author": 100},
    "sentiment_scores": {"post_id": 20, "label": 10},
    "extracted_entities": {"post_id": 20, "entity_text": 255, "entity_type": 20},
    "keyword_trends": {"subreddit": 100, "keyword": 255},
    "daily_summary": {"subreddit": 100, "top_entity": 255, "top_keyword": 255},
}
# What a missing value becomes.
DEFAULTS = {
    "raw_posts": {"score": 0, "num_comments": 0},
    "sentiment_scores": {},
    "extracted_entities": {"mention_count": 1},
    "keyword_trends": {"is_trending": False},
    "daily_summary": {"total_posts": 0},
}
SCHEMAS = {
    "raw_posts": RAW_POSTS,
    "sentiment_scores": SENTIMENT_SCORES,
    "extracted_entities": EXTRACTED_ENTITIES,
    "keyword_trends": KEYWORD_TRENDS,
    "daily_summary": DAILY_SUMMARY,
}
KEYS = {
    "raw_posts": ["post_id"],
    "sentiment_scores": ["post_id"],
    "extracted_entities": ["post_id", "entity_text", "entity_type"],
    "keyword_trends": ["subreddit", "keyword", "hour_bucket"],
    "daily_summary": ["summary_date", "subreddit"],
}
