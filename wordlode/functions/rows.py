"""Arrays to rows, and functions of texts a slice of a batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Bytes of texts that a function takes at a time.
SLICE_BYTES = 1_000_000

STRINGS = pa.list_(pa.string())


def explode_rows(df: DataFrame, array: Column, name: str, *keys, pos: str | None = None) -> DataFrame:
    """One row per array element, with its position if ``pos`` names a column.

    Spark guards a plain explode with a filter on the size of the array, which
    computes an array expression twice. The outer form has no such guard; the
    NULL row of an empty array goes afterwards.
    """
    if pos:
        rows = F.posexplode_outer(array).alias(pos, name)
    else:
        rows = F.explode_outer(array).alias(name)
    return df.select(*keys, rows).where(F.col(name).isNotNull())


def _ends(array: pa.Array) -> np.ndarray:
    """Bytes of strings, and elements of lists, before each row and after the last one."""
    if pa.types.is_list(array.type) or pa.types.is_large_list(array.type):
        sizes = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        return _ends(array.flatten())[ends] + ends
    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def slices(arrays: tuple[pa.Array, ...], size: int) -> Iterator[list[list]]:
    """The columns of a batch as lists, some rows of about ``size`` bytes at a time, one row at least."""
    ends = sum(_ends(a) for a in arrays)
    n, start = len(ends) - 1, 0
    while start < n:
        stop = min(n, max(start + 1, int(np.searchsorted(ends, ends[start] + size, "right")) - 1))
        yield [a.slice(start, stop - start).to_pylist() for a in arrays]
        start = stop


def sliced(find: Callable, kind: str, arrow: pa.DataType, size: int | None = None):
    """A column function from ``find``, which maps lists of values of some rows to a list of results.

    Texts stay packed but for one slice, so memory does not grow with the rows of a batch. Marked
    nondeterministic, so that Spark never evaluates it twice.
    """
    most = size or SLICE_BYTES

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for arrays in batches:
            for columns in slices(arrays if isinstance(arrays, tuple) else (arrays,), most):
                yield pa.array(find(*columns), arrow)

    return run.asNondeterministic()
