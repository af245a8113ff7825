import gzip
import os

from chatterscope import resources as rs
from chatterscope.schemas import LANDED_POST, RSS_ITEM
from chatterscope.sources.isolated import read_isolated
from chatterscope.sources.rss import read_feeds


def outcome(rows, refused, key):
    return (
        sorted(str(r[key]) for r in rows.collect()),
        sorted((os.path.basename(r.file), r.line, r.reason) for r in refused.collect()),
    )


def test_lines_and_packed_files(spark, tmp_path):
    (tmp_path / "a b.json").write_text('{"post_id":"a","title":"t"}\n{"post_id": oops\n{"post_id":"b"}\n')
    (tmp_path / "cut.json.gz").write_bytes(gzip.compress(b'{"post_id":"z"}\n' * 1000)[:40])
    (tmp_path / "blank.json").write_text("\n \n")
    (tmp_path / "empty.json").write_text("")
    got = outcome(*read_isolated(spark, str(tmp_path), "json", LANDED_POST), "post_id")
    assert got == (["a", "b"], [("a%20b.json", '{"post_id": oops', "does not parse"), ("cut.json.gz", None, "no readable json file")])


def test_feeds(spark, tmp_path):
    folder = tmp_path / "feed=bbc_world"
    folder.mkdir()
    (folder / "a.xml").write_text("<channel><item><title>one</title><link>l1</link></item></channel>")
    (folder / "b.xml").write_text("<channel><item><title>cut")
    (folder / "c.xml").write_text("no feed at all")
    posts, refused = read_feeds(spark, str(tmp_path), rs.feed_map(spark), "2024-01-31 00:00:00")
    assert [(r.title, r.subreddit) for r in posts.collect()] == [("one", "world")]
    assert sorted((os.path.basename(r.file), r.reason) for r in refused.collect()) == [("b.xml", "does not parse"), ("c.xml", "does not parse")]


def test_truncated_columns(spark, tmp_path):
    spark.range(5).selectExpr("cast(id as string) post_id").coalesce(1).write.parquet(str(tmp_path / "ok"))
    spark.range(0).selectExpr("cast(id as string) post_id").coalesce(1).write.parquet(str(tmp_path / "none"))
    whole = next((tmp_path / "ok").glob("*.parquet")).read_bytes()
    (tmp_path / "cut.parquet").write_bytes(whole[:-30])
    got = outcome(*read_isolated(spark, str(tmp_path), "parquet", LANDED_POST, recursiveFileLookup="true"), "post_id")
    assert got == (list("01234"), [("cut.parquet", None, "no readable parquet file")])


def test_nothing_broken(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<channel><item><title>one</title></item></channel>")
    assert outcome(*read_isolated(spark, str(tmp_path), "xml", RSS_ITEM, rowTag="item"), "title") == (["one"], [])
