"""The pipeline: its stages do what their operators say, and odd tables get through."""

import os

import public_tokenizers

import corpus_pipeline
from __spark_entry__ import queries
from tests.llm.cases import frame, odd_rows
from tests.llm.test_exact import (
    brute_components, brute_fingerprint, brute_overlaps, brute_suffix, check_packing,
)

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    rejected = {
        r["doc_id"] for r in queries()["op9_quality_classifier"](spark, SF).collect() if not r["predicted"]
    }
    everyone = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rejected and {r["doc_id"] for r in kept[0]} == everyone - rejected
    root = brute_components({brute_fingerprint(r["text"]) for r in kept[0]}, 4)
    least = {}
    for r in kept[0]:
        f = root[brute_fingerprint(r["text"])]
        least[f] = min(least.get(f, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept[1]) == sorted(least.values())
    cut = {x[0]: x[1] - x[2] for x in brute_suffix([(r["doc_id"], r["text"]) for r in kept[1]], 100)}
    assert len(kept[2]) == len(kept[1])
    for r in kept[2]:
        assert 0 <= cut[r["doc_id"]] - len(r["text"].encode()) <= 12 and r["n_chars"] == len(r["text"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute_overlaps([(r["doc_id"], r["text"]) for r in kept[2]], items, 10)
    clean = [r["doc_id"] for r, x in zip(kept[2], found) if not x[-1]]
    assert sorted(clean) == sorted(r["doc_id"] for r in kept[3])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing([r.asDict() for r in kept[4]], [(r["doc_id"], r["text"]) for r in kept[3]], tokenizer)


def test_odd_rows_pass_all_stages(spark, tmp_path):
    docs = frame(spark, odd_rows())
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        # The tiny table has too few labels to reject any of it.
        if not i:
            assert docs.count() == len(odd_rows())
    assert docs.count() > 0


def test_empty_table_passes_all_stages(spark, tmp_path):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
