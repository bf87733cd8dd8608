"""The corpus pipeline stage by stage, and what is registered."""

import collections

import corpus_pipeline
from llm.helpers import components, odd_docs
from llm.test_row_local import plain_spans
import __spark_entry__ as entry


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, sf), name)
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    ids = {name: {r.doc_id for r in after.select("doc_id").collect()} for name, (_, after) in kept.items()}
    gone = [quality[i] for i in quality if i not in ids["quality"]]
    assert len(gone) > 20 and gone.count(1) <= 2
    assert len(ids["quality"]) - len(ids["language"]) < 5
    near = components([(r.doc_id, r.text) for r in kept["near_dup"][0].collect()], 5, 80)
    assert ids["near_dup"] == set(near.values())
    texts = {r.doc_id: r for r in kept["pii"][1].collect()}
    assert all(plain_spans(r.text) == "" and r.n_chars == len(r.text) for r in texts.values())
    mailed = {r.doc_id for r in kept["pii"][0].collect() if "email" in plain_spans(r.text)}
    assert mailed and mailed == {i for i, r in texts.items() if "[EMAIL]" in r.text}
    rows = kept["packing"][1].collect()
    assert {r.doc_id for r in rows} == ids["pii"]
    filled = collections.Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 4096 and len(filled) == -(-sum(filled.values()) // 4096)


def test_stages_take_odd_rows_and_empty_tables(spark):
    for docs in (odd_docs(spark), odd_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, "/root/testdata/sf0.001"), name)
            docs.count()
