import corpus_pipeline
from tidewater.llm import quality


def test_good_documents_keep_their_columns_and_null_texts(spark, tmp_path, monkeypatch):
    """The text goes to the scorer once, not again inside the row."""
    docs = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "some words here", "de")], "doc_id long, text string, lang string")
    spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "score_quality", lambda d, m, plain=quality.score_quality, **more: seen.append(plain(d, m, **more)) or seen[-1])
    got = corpus_pipeline.keep_good(spark, docs, str(tmp_path))
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    assert "text" not in seen[0].schema["row"].dataType.names and seen[0].where("text is null").count() == 0
