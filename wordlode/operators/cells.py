"""An index of vectors by cells, for neighbours that need not be exact.

Cells are trained by k-means on a sample of bounded size; every vector is then listed in
its nearest cell, in a written table partitioned by cell. A query looks into its nearest
``probes`` cells, so it meets a part of the vectors and not all. The sample decides where
cells lie, not what is found in them: with as many probes as cells, results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from wordlode.operators.vectors import _nearest_in_block, _unit
from wordlode.session import cut_lineage

# Vectors that cells are trained on, for each cell, and rounds of training.
SAMPLE_PER_CELL = 50
ROUNDS = 10
MAX_CELLS = 16_384
# Queries, and vectors, of one cell that meet in a task; larger cells are cut.
CELL_ROWS = 20_000


class Index(NamedTuple):
    """Centers of the cells, and all vectors with their cell: cell, word, vector."""

    centers: np.ndarray
    lists: DataFrame


def _closest(vectors: np.ndarray, centers: np.ndarray, probes: int) -> np.ndarray:
    """The cells nearest to each vector by cosine, best first; ties go to the lower number."""
    sims = np.round(_unit(vectors) @ centers.T, 9)
    return np.argsort(-sims, axis=1, kind="stable")[:, :probes]


def train_cells(vectors: DataFrame, cells: int, seed: int = 1) -> np.ndarray:
    """Centers of ``cells`` cells at most, by k-means on directions.

    At most ``SAMPLE_PER_CELL`` vectors a cell, the lowest by a hash of their word, reach the driver.
    """
    if not 1 <= cells <= MAX_CELLS:
        raise ValueError(f"between 1 and {MAX_CELLS} cells")
    sample = (
        vectors.where("vector IS NOT NULL").select("word", "vector", F.xxhash64("word", F.lit(seed)).alias("h"))
        .orderBy("h", "word").limit(cells * SAMPLE_PER_CELL).toPandas()
    )
    if not len(sample):
        return np.zeros((0, 0))
    points = _unit(np.stack(sample["vector"].to_numpy()).astype(float))
    centers = points[:cells].copy()
    for _ in range(ROUNDS):
        own = _closest(points, centers, 1)[:, 0]
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        # A cell that lost all its vectors stays where it is.
        empty = np.bincount(own, minlength=len(centers)) == 0
        sums[empty] = centers[empty]
        centers = _unit(sums)
    return centers


def _with_cells(df: DataFrame, centers: np.ndarray, probes: int) -> DataFrame:
    """word, vector, cell: one row for each of the nearest cells."""
    held = df.sparkSession.sparkContext.broadcast(centers)  # MAX_CELLS rows at most

    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            if len(vectors):
                yield pd.Series(list(_closest(np.stack(vectors.to_numpy()).astype(float), held.value, probes)))
            else:
                yield pd.Series([], dtype=object)

    udf = F.pandas_udf(assign, "array<long>").asNondeterministic()
    rows = df.select("word", "vector").where("vector IS NOT NULL")
    return rows.withColumn("cell", F.explode_outer(udf("vector"))).where("cell IS NOT NULL")


def build_index(vectors: DataFrame, cells: int, seed: int = 1) -> Index:
    """List every vector in its cell."""
    vectors = cut_lineage(vectors.select("word", "vector").where("vector IS NOT NULL"))
    centers = train_cells(vectors, cells, seed)
    if not len(centers):
        return Index(centers, vectors.withColumn("cell", F.lit(0).cast("long")))
    return Index(centers, cut_lineage(_with_cells(vectors, centers, 1)))


def nearest_in_cells(index: Index, queries: DataFrame, k: int, probes: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """query, word, sim: the ``k`` best words that lie in the nearest ``probes`` cells of each query.

    The vectors of a cell are cut into slices, its queries into lots of ``cell_rows``; each lot meets
    each slice in a task, so a cell that holds very many of either is spread.
    """
    schema = "query string, word string, sim double"
    if not len(index.centers):
        return queries.sparkSession.createDataFrame([], schema)
    asked = cut_lineage(_with_cells(queries, index.centers, min(probes, len(index.centers))))
    held = index.lists.groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).alias("slices"))
    lots = asked.groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).alias("lots"))
    sizes = F.broadcast(cut_lineage(held.join(lots, "cell")))  # MAX_CELLS rows at most

    def dealt(df, own, other):
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1))
        return df.join(sizes, "cell").select(
            "cell", F.pmod(F.xxhash64("word"), F.col(f"{own}s")).alias(own), copies.alias(other), "word", "vector"
        )

    def meet(ask: pd.DataFrame, hold: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(hold):
            return pd.DataFrame({"query": [], "word": [], "sim": []})
        hold = hold.sort_values("word")
        found = _nearest_in_block(
            np.stack(ask["vector"].to_numpy()).astype(float), ask["word"].to_numpy(),
            np.stack(hold["vector"].to_numpy()).astype(float), hold["word"].to_numpy(), k, None,
        )
        return pd.concat(list(found), ignore_index=True)

    keys = ("cell", "lot", "slice")
    met = dealt(asked, "lot", "slice").groupBy(*keys).cogroup(dealt(index.lists, "slice", "lot").groupBy(*keys))
    found = met.applyInPandas(meet, schema)
    order = Window.partitionBy("query").orderBy(F.col("sim").desc(), "word")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """expected, found, recall: how many of the exact neighbours were found."""
    hits = exact.select("query", "word").join(
        found.select("query", "word", F.lit(1).alias("hit")), ["query", "word"], "left"
    )
    return hits.agg(F.count("*").alias("expected"), F.count("hit").alias("found")).withColumn(
        "recall", F.col("found") / F.col("expected")
    )
