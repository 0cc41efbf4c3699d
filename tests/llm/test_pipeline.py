import corpus_pipeline
from test_shingles import brute

from placemat.llm import pii
from placemat.scratch import stage


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(step(spark, docs, small), f"test-{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
            after = [r.doc_id for r in docs.collect()]
            assert len(after) == len(set(after)) and set(after) <= set(before)
        if name == "near_dedup":
            assert set(after) == set(brute({d: r.text for d, r in before.items()}).values())
        if name == "pii":
            assert set(after) == set(before)
            for r in docs.collect():
                old = before[r.doc_id].text
                assert not any(old[a:b] in r.text for a, b, _, _ in pii.entities(old)) and r.n_chars == len(r.text)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    left = {r.doc_id for r in seen["quality"].collect()}
    good = [d for d, r in labels.items() if r.quality == 1]
    assert sum(d in left for d in good) > 0.97 * len(good)
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in seen["pii"].select("doc_id").collect()}


def test_odd_documents(spark, odd, none, small):
    for frame in (odd, none):
        docs = frame
        for name, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, small), f"odd-{name}")
            if name != "packing":
                assert docs.columns == odd.columns
        assert (docs.count() > 0) == (frame is odd)


def test_near_dedup_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 7), (1, "a b c d e f", 7), (2, "A b c d e f", 8), (None, "x", 9), (None, "y", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row long")
    found = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == [(1, "a b c d e f", 7), (None, "x", 9), (None, "y", 10)]
