"""Times the headline queries and prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each query runs to the end
into a sink that drops its rows, after one warm-up of the session on the relational queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from chatterscope.plans.queries import REGISTRY
from chatterscope.session import local_session

HEADLINE = [
    "trending_keywords", "trend_alerts", "top_keywords_now", "keyword_timeline",
    "sentiment_by_hour", "sentiment_gauge", "daily_summary", "daily_top_terms",
    "entity_surge", "top_entities",
    "clean_text", "word_frequency", "tfidf_keywords", "frequency_keywords", "keyword_trends",
    "lexicon_sentiment", "rss_title_sentiment", "extract_from_posts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench", memory="12g")
    REGISTRY["trending_keywords"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
