import corpus_pipeline


def test_stages(docs, spark, tmp_path):
    labels = spark.createDataFrame([(7, 0), (8, 1)], "doc_id long, toxic int")
    wanted = docs.select("doc_id", "text", "lang", "source", "n_chars")
    wanted.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "substrings", "packing"]
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = got.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = corpus_pipeline.materialise(stage(spark, got, str(tmp_path)))
        assert got.columns == columns
    ids = [r.doc_id for r in got.collect()]
    assert 7 in ids and not {1, 2, 3, 4, 5, 6, 8, 9, 10, 60} & set(ids)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {p.doc_id for r in packed.collect() for p in r.pieces} == set(ids)


def test_empty_tables(none, spark, tmp_path):
    none.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_shared_ids_and_clashing_names(spark, tmp_path):
    """Unrelated documents without ids, or of one id, all stay; further columns have the names of helpers."""
    words = lambda i: " ".join(f"u{i}x{k}" for k in range(60))
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 100 + i, words(i), "en", None if i % 4 else "s", 0, i, "x", "y") for i in range(30)]
    rows += [(None, words(0), "en", "s", 0, 99, "x", "y"), (7, None, "en", "s", 0, 98, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, row int, key string, frequent string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, 0), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = corpus_pipeline.materialise(stage(spark, got, str(tmp_path)))
    assert len({r.text for r in got.collect()}) == got.count() == 30
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(len(r.pieces) for r in packed) == 30
