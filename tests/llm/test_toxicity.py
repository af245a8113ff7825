import numpy as np
import pyarrow as pa

from chatterscope.llm.toxicity import all_features, fit, toxicity, without_toxic

GIVEN = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_precision_and_recall(spark):
    docs, labels = (spark.read.parquet(f"{GIVEN}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(spark, docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    found, right = [r for r in rows if r.predicted], sum(r.toxic for r in rows if r.predicted)
    assert right >= 0.9 * len(found) and right >= 0.85 * sum(r.toxic for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "quality", "if(crc32(string(doc_id)) % 3 = 1, 1 - toxic, toxic) toxic")
    a, b = (dict(toxicity(spark, docs, x).select("doc_id", "score").collect()) for x in (labels, other))
    assert a == b


def test_risk_is_least_with_separable_features():
    rng = np.random.default_rng(1)
    p, u = np.zeros((200, 4)), np.zeros((800, 4))
    p[:, 0], u[:80, 0] = 1, 1  # a tenth of the unlabelled is toxic
    p[:, 1:], u[:, 1:] = rng.random((200, 3)) < 0.5, rng.random((800, 3)) < 0.5
    row, feature = np.nonzero(np.concatenate([p, u]))
    w, b = fit(row, feature, 200, 800, 4, prior=0.1)
    z = np.concatenate([p, u]) @ w + b
    assert (z[:280] > 0).all() and (z[280:] < 0).all()


def test_features_count_a_word_once_or_twice():
    once, twice, empty = (set(all_features(pa.array([t])).tolist()) for t in ("Hello world", "hello hello, WORLD", ""))
    assert once < twice and not empty


def test_odd_texts_and_tables(spark, make_docs):
    toxic = [(k, f"plain words here and vileword{k % 3} too") for k in range(60)]
    clean = [(100 + k, f"plain words here and other{k} too") for k in range(300)]
    odd = [(900, None), (901, ""), (902, "vileword1 " * 20_000), (903, "plain words"), (903, "plain words"), (None, "vileword0 vileword1")]
    docs = make_docs([*toxic, *clean, *odd], clashing=True)
    labels = spark.createDataFrame([(k, 1, 1) for k, _ in toxic] + [(100 + k, 1, 0) for k in range(100)] + [(0, 1, 0), (None, 1, 1), (5, 1, None)], LABELS)
    rows = toxicity(spark, docs, labels).collect()
    assert len(rows) == len(toxic) + len(clean) + len(odd)
    by = {r.doc_id: r.predicted for r in rows}
    assert all(by[k] for k, _ in toxic) and not any(by[k] for k, _ in clean) and by[902] == 1 and by[900] == by[901] == by[903] == 0
    kept = without_toxic(spark, docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(1 for r in rows if not r.predicted)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity(spark, docs, none).collect()} == {0.0}
    assert toxicity(spark, make_docs([]), labels).collect() == []
