"""A corpus pipeline of five stages over ``documents``; part of the subpackage ``wordlode.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordlode.llm import decontaminate, pack, quality, simhash, suffix
from wordlode.llm.queries import table
from wordlode.session import cut_lineage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.7) go; without labels of both classes all stay."""
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("label"))
    model = quality.train(docs.select("doc_id", "text", F.col("n_chars").alias("recorded")), labels)
    if not isinstance(model, quality.Model):
        return docs
    return quality.score(docs, model).where("result >= 0.7").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    return simhash.representatives(docs, shingle=4, radius=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of 100-byte strings are cut out of the texts; every document stays."""
    found = suffix.remove(docs, size=100, with_bytes=False, with_text=True)
    changed = F.col("result.n_removed") > 0
    new = {"text": F.col("result.kept_text"), "n_chars": F.length("result.kept_text")}
    return found.select(*[
        F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.overlaps(docs, items, size=10).where("not result.contaminated").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 1024 tokens: one row per piece of a document."""
    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=1024)


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("curve_packing", packing),
]

# The stages train models and search texts; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
