from towertrace.llm import labelled


def test_samples_are_bounded_in_rows_and_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(1, "text 0")] * 20 + [(2, "b"), (2, None)],
                                 "doc_id bigint, text string")
    assert len(labelled.corpus_sample(docs, 10)) == 10
    assert len(labelled.corpus_sample(docs, 100)) == 52  # a row that repeats id and text counts once
    ids = [k for k in (1, 2) if docs.where(f"doc_id = {k}").where(~labelled.held_out(docs["doc_id"])).count()]
    labels = spark.createDataFrame([(k, 1) for k in ids], "doc_id bigint, toxic int")
    assert len(labelled.training_rows(docs, labels, "toxic", 1, 2)) == (2 if ids else 0)
    monkeypatch.setattr(labelled, "MOST_BYTES", 30)
    got = labelled.corpus_sample(docs, 100)
    assert got and sum(len(t.encode()) for t in got) <= 30
