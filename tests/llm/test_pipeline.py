import corpus_pipeline
from chatterscope.llm.scratch import written

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows, names = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(spark, stage(spark, rows, DATA), name)
        assert out.columns == docs.columns
        assert out.join(rows, "doc_id", "left_anti").isEmpty() and out.count() <= rows.count()
        names.append(name)
        rows = out
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination"]
    assert rows.where("n_chars != length(text)").isEmpty()
    assert 0 < rows.count() < docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, DATA)
    assert pieces.select("doc_id").distinct().count() == rows.count()


def test_one_document_of_each_group_stays(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(100))
    docs = make_docs([(4, text), (2, text + " more"), (7, text), (9, "other words of its own, clean"), (10, None), (11, ""), (None, text)], clashing=True)
    kept = corpus_pipeline.near_dedup(spark, docs, DATA)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 9, 10, 11]


def test_empty_documents(spark, make_docs):
    rows = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, DATA)
        assert out.count() == 0
        rows = out if "text" in out.columns else rows
