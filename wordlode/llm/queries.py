"""The registered queries of these operators: thin calls with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordlode.llm import (
    align, count, decontaminate, langid, linkrank, pack, phrases, quality, rules, simhash, sitetree, suffix, toxic,
)
from wordlode.llm.sample import held_out
from wordlode.sources.tables import scan


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", *columns)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=1024)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = count.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("row.doc_id", F.col("result").alias("n_tokens"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, radius=4)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        table(spark, sf_dir, "benchmark", "item_id", "text"), size=10,
    )
    return found.select(
        "row.doc_id", "result.n_words", "result.n_hit", "result.n_items", "result.items_sha256",
        "result.contaminated",
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitetree.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select(
        "row.page_id", "row.url", F.col("result").alias("text"),
        F.length("result").cast("long").alias("n_chars"),
    )


def _verdicts(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), F.col("result").alias("score"),
        (F.col("result") >= threshold).cast("int").alias("predicted"),
    )


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("toxic").alias("label"))
    return _verdicts(toxic.score(docs, toxic.train(docs, labels)), 0.3)


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "result.*")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def quality_scores(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """``row`` and ``result`` for ``docs`` by a model learned from the labelled documents of ``sf_dir``."""
    learn = table(spark, sf_dir, "documents", "doc_id", "text", F.col("n_chars").alias("recorded"))
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars") if docs is None else docs
    return quality.score(docs, quality.train(learn, labels))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(quality_scores(spark, sf_dir), 0.7)


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove(table(spark, sf_dir, "documents", "doc_id", "text"), size=100, with_bytes=False)
    return found.select(
        "row.doc_id", "result.n_bytes", "result.n_removed", "result.n_spans", "result.kept_sha256"
    )


URL_RULES = [
    linkrank.Rule("org", "/", "allow"), linkrank.Rule("example.org", "/es/", "block"),
    linkrank.Rule("example.org", "/en/1", "block"), linkrank.Rule("com", "/fr/", "allow"),
    linkrank.Rule("com", "/de/", "block"),
]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linkrank.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents", "text", "lang"), support=30, top=2000)


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
    )


QUERIES = {
    "op1_curve_packing": packing,
    "op2_token_counts": token_counts,
    "op3_simhash_near_dedup": near_duplicates,
    "op4_html_extraction": html_extraction,
    "op5_toxicity": toxicity,
    "op6_benchmark_decontamination": decontamination,
    "op7_quality_rules": quality_rules,
    "op8_language_id": language,
    "op9_quality_classifier": quality_classifier,
    "op10_suffix_array_dedup": suffix_dedup,
    "op11_url_filters": url_filter,
    "op12_phrase_mining": phrase_mining,
    "op13_tokenizer_alignment": tokenizer_alignment,
}
