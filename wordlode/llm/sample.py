"""Held-out rows and bounded labelled samples for the classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordlode.session import cut_lineage, gathered


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; NULL without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """Rows never learned from. A NULL id is not held out, but it is not learned from either."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], per_class: int) -> DataFrame:
    """At most ``per_class`` documents of each label, of any length: doc_id, label, text and ``columns``.

    ``docs`` has doc_id, text and ``columns``; ``labels`` has doc_id and label. Rows are
    taken in the order of a hash of their id, so the sample is the same in every
    run. Held-out rows, NULL labels, NULL ids and empty texts are left out; of rows
    that share an id one counts, with the smallest label.
    """
    learned = (
        labels.where(F.col("label").isNotNull() & (remainder(F.col("doc_id")) != 2))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    usable = docs.where(F.length("text") > 0)
    order = Window.partitionBy("label").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), "doc_id")
    # Ids first: the texts of the few rows taken are read again, not shuffled. A share of
    # the hashes that holds the sample many times over keeps the window small.
    known = cut_lineage(gathered(learned.join(usable.select("doc_id").distinct(), "doc_id"), labels.count()))
    sizes = known.groupBy("label").agg(F.count("*").alias("size"))
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) * F.col("size") < F.lit((1 << 20) * 8 * (per_class + 25))
    chosen = cut_lineage(
        known.join(F.broadcast(sizes), "label").where(near)
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_class)
        .select("doc_id", "label")
    )
    taken = usable.select("doc_id", "text", *columns).join(F.broadcast(chosen), "doc_id")
    return taken.dropDuplicates(["doc_id"])


def excerpt(text: Column, size: int, windows: int = 8) -> Column:
    """The whole text up to ``size`` characters; of a longer one, ``windows`` stretches at equal distances, one a line."""
    part = size // windows
    stretches = [
        F.substr(text, (F.lit(i) * (F.length(text) - part) / (windows - 1)).cast("int") + 1, F.lit(part))
        for i in range(windows)
    ]
    return F.when(F.length(text) <= size, text).otherwise(F.concat_ws("\n", *stretches))


def in_order(sample: DataFrame) -> pd.DataFrame:
    """The rows of a bounded sample by id."""
    return sample.toPandas().sort_values("doc_id", kind="stable").reset_index(drop=True)


def class_shares(labels: DataFrame) -> dict:
    """The share of each label among all rows that may be learned from."""
    rows = (
        labels.where(F.col("label").isNotNull() & (remainder(F.col("doc_id")) != 2))
        .groupBy("label").count().collect()
    )
    total = sum(r["count"] for r in rows)
    return {r["label"]: r["count"] / total for r in rows}
