import __spark_entry__ as entry


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 960
    assert df.columns == [
        "subreddit", "keyword", "hour_bucket", "frequency", "rolling_avg_7d", "spike_ratio", "is_trending"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
