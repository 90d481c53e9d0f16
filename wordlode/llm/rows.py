"""Row-wise operators: one Python result per row beside the untouched row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordlode.session import spread


def annotate(df: DataFrame, result: Column) -> DataFrame:
    """Two columns: ``row`` with every column of ``df``, ``result`` with what was computed.

    Keeping the row in a struct of its own lets inputs carry any column names,
    repeated keys and NULL keys: nothing is joined back.
    """
    return df.select(F.struct("*").alias("row"), result.alias("result"))


def with_result(df: DataFrame, udf, *columns: str) -> DataFrame:
    """``annotate`` with a pandas function of some columns, small tables dealt out first."""
    return annotate(spread(df), udf(*[F.col(f"`{c}`") for c in columns]))


def pieces(lengths, limit: int = 1 << 20):
    """Slices (first, last) of rows whose lengths add up to ``limit`` at most.

    A row longer than the limit stands alone, so memory follows the longest
    text and not the size of a batch.
    """
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)
