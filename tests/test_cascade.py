import pytest
from pyspark.sql import functions as F

from chatterscope.sinks import cascade
from chatterscope.sinks.keys import KeyIndex


def stamps(folder):
    return {f.relative_to(folder).as_posix(): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


@pytest.fixture
def stored(spark, tmp_path):
    """Posts a..i on three days in two batches, each with two children."""
    rows = [(p, f"2024-01-0{k % 3 + 1}", f"q-{k // 5}") for k, p in enumerate("abcdefghi")]
    posts = spark.createDataFrame(rows, "post_id string, dt string, batch string").withColumn("dt", F.to_date("dt"))
    children = posts.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    for name, table in (("posts", posts), ("children", children)):
        table.repartition(1).write.partitionBy("dt", "batch").parquet(str(tmp_path / name))
    return tmp_path


def keys(spark, names):
    return spark.createDataFrame([(k,) for k in names], "post_id string")


def left(spark, stored):
    children = spark.read.parquet(str(stored / "children"))
    return ["".join(sorted(r.post_id for r in t.collect())) for t in (spark.read.parquet(str(stored / "posts")), children)]


def test_only_touched_partitions_are_written(spark, stored):
    before = stamps(stored)
    touched = cascade.delete_posts(spark, keys(spark, ["a", "a", "zz"]), str(stored / "posts"), str(stored / "children"))
    assert [(str(day), batch) for day, batch in touched] == [("2024-01-01", "q-0")]
    assert left(spark, stored) == ["bcdefghi", "bbccddeeffgghhii"]
    after = stamps(stored)
    own = "/dt=2024-01-01/batch=q-0/"
    assert {f: t for f, t in after.items() if own not in f} == {f: t for f, t in before.items() if own not in f}
    assert not {f for f in after if own in f} & set(before) and any(own in f for f in after)


def test_a_partition_of_which_nothing_remains_is_gone(spark, stored):
    cascade.delete_posts(spark, keys(spark, "ad"), str(stored / "posts"), str(stored / "children"))
    assert left(spark, stored) == ["bcefghi", "bbcceeffgghhii"]
    assert not any((stored / t / "dt=2024-01-01" / "batch=q-0").exists() for t in ("posts", "children"))


def test_a_lost_job_can_be_run_again(spark, stored, monkeypatch):
    calls = []

    def lose_the_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        overwrite(*args)

    overwrite = cascade.overwrite_partitions
    with monkeypatch.context() as broken:
        broken.setattr(cascade, "overwrite_partitions", lose_the_second)
        with pytest.raises(RuntimeError):
            cascade.delete_posts(spark, keys(spark, "be"), str(stored / "posts"), str(stored / "children"))
    assert left(spark, stored) == ["abcdefghi", "aaccddffgghhii"]
    cascade.delete_posts(spark, keys(spark, "be"), str(stored / "posts"), str(stored / "children"))
    assert left(spark, stored) == ["acdfghi", "aaccddffgghhii"]


def test_unknown_keys_touch_nothing(spark, stored):
    before = stamps(stored)
    assert cascade.delete_posts(spark, keys(spark, ["zz"]), str(stored / "posts"), str(stored / "children")) == []
    assert stamps(stored) == before


def test_other_partitions_are_not_read(spark, stored):
    table = spark.read.parquet(str(stored / "children"))
    plan = table.where(cascade._within([(__import__("datetime").date(2024, 1, 1), "q-0")]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "DataFilters: []" in plan


def test_deleted_keys_count_as_new_again(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), buckets=2)
    index.add(keys(spark, "abc"), "b0")
    index.forget(keys(spark, "bz"))
    assert sorted(r.post_id for r in index.known(keys(spark, "abcd")).collect()) == ["a", "c"]
