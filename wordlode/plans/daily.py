"""The job day by day: counts are kept by date, so a day is added and earlier days are not read again.

The state of a corpus is a table of its runs and their counts in one partition per date. What
words there are, and how special they are, follows from summed counts alone. A day counted
again replaces its partition, so a rerun changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordlode.functions.text import acceptable
from wordlode.operators.counts import smoothed_ratio
from wordlode.operators.discover import count_runs, words_of_runs
from wordlode.plans.mine import MiningConfig, sentence_texts
from wordlode.session import cut_lineage
from wordlode.sources.tables import partition_name, run_date, scan, scan_partition, write_partition

SCORED = "run_date string, word string, score double"


def add_day(texts: DataFrame, state: str, date: str, config: MiningConfig = MiningConfig()) -> None:
    """Count the runs of a day's texts (column text) into its partition of the table ``state``."""
    runs = count_runs(sentence_texts(texts, config), F.col("text"), config.profile.separator)
    write_partition(runs, state, date)


def counted_until(spark: SparkSession, state: str, date: str) -> DataFrame:
    """run, n over all days up to ``date``; later partitions are not read."""
    days = scan(spark, state).where(F.col("p_date") <= F.lit(partition_name(date)))
    return cut_lineage(days.groupBy("run").agg(F.sum("n").alias("n")))


def special_words(domain: DataFrame, background: DataFrame, config: MiningConfig = MiningConfig()) -> DataFrame:
    """word, score: the ``top`` words of counted domain runs against those of the background."""
    # The ratio reads both several times.
    found = [
        cut_lineage(words_of_runs(runs, config.min_proba, config.min_pmi)) for runs in (domain, background)
    ]
    scored = smoothed_ratio(*found, config.missing).where(acceptable(F.col("word"), config.profile.word_rules))
    return (
        scored.orderBy(F.round("score", 9).desc_nulls_last(), "word").limit(config.top).select("word", "score")
    )


def run_day(
    spark: SparkSession, domain_source: str, domain_state: str, background_state: str, output: str,
    config: MiningConfig = MiningConfig(), date: str | None = None, domain_text: str = "text",
    match_column: str = "match_cnt",
) -> DataFrame:
    """Add one day of the domain to its state and write that day's special words: run_date, word, score.

    The day's texts are those of its partition with enough matches; the words are those of all days
    up to it.
    """
    date = date or run_date(spark)
    texts = scan_partition(spark, domain_source, date).where(F.col(match_column) > config.match_floor)
    add_day(texts.select(F.col(domain_text).alias("text")), domain_state, date, config)
    words = special_words(
        counted_until(spark, domain_state, date), counted_until(spark, background_state, date), config
    )
    rows = cut_lineage(words.select(F.lit(date).alias("run_date"), "word", "score").to(
        spark.createDataFrame([], SCORED).schema
    ))
    write_partition(rows, output, date)
    return rows
