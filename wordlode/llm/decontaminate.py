"""Benchmark decontamination by one Aho-Corasick automaton over normalised items.

Texts are brought to lower-case words joined by one space, so that every run of
words of an item is a plain substring that starts and ends with a space. The
automaton reads a text once; each hit is counted in words and mapped back to
character offsets of the original text.

Defined cases: a NULL or empty text has no words and no hits; an item without
words has no windows; an item of fewer words than a window is one window; an
item with a NULL id marks words but is not listed; items that share an id are one
item; repeated documents are judged row by row; an empty item table hits nothing.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wordlode.llm.rows import with_result
from wordlode.session import cut_lineage

# Words are runs of digits, letters and characters beyond ASCII.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_FOLD = bytes(
    32 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F
    else c + 32 if 0x41 <= c <= 0x5A else c
    for c in range(256)
)

# Characters of windows in one automaton: some hundred MB in a task.
SHARD_CHARS = 2_000_000

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))),
])


def words(text: str | None) -> list[bytes]:
    """Lower-case words (A-Z only) as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(items: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """The distinct windows of all items with the ids of the items that hold them."""
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, found = [], []
            for key, text in zip(frame["item"], frame["text"]):
                tokens = words(text)
                for i in range(max(1, len(tokens) - size + 1) if tokens else 0):
                    ids.append(key)
                    found.append(b" ".join(tokens[i : i + size]).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"item": ids, "window": found})

    rows = items.select(
        F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text")
    ).mapInPandas(cut, "item string, window string")
    return cut_lineage(rows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")))


def shards(spark: SparkSession, found: DataFrame, limit: int) -> list:
    """The windows as broadcasts of a bounded size, collected one at a time."""
    chars = found.agg(F.sum(F.length("window"))).first()[0] or 0
    n = max(1, -(-chars * 5 // (limit * 4)))
    parts = found.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(n)))
    return [
        (uuid.uuid4().hex, spark.sparkContext.broadcast(
            [(r["window"], list(r["items"])) for r in parts.where(F.col("part") == i).collect()]
        ))
        for i in range(n)
    ] if chars else []


_built: dict = {}


def _automaton(part: tuple, keep: bool):
    """The automaton of one shard; a single one stays in the worker."""
    name, shard = part
    if name in _built:
        return _built[name]
    automaton = ahocorasick.Automaton()
    for window, items in shard.value:
        automaton.add_word(f" {window} ", (len(window) + 1, window.count(" ") + 1, items))
    if len(automaton):
        automaton.make_automaton()
    _built.clear()
    if keep:
        _built[name] = automaton
    return automaton


def _scan(automaton, line: str) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word ranges [first, last) under any window, and the items found."""
    hits = list(automaton.iter(line))
    if not hits:
        return [], set()
    ends = np.fromiter((end for end, _ in hits), np.int64, len(hits))
    sizes = np.fromiter((value[1] for _, value in hits), np.int64, len(hits))
    blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
    last = np.searchsorted(blanks, ends)
    return list(zip((last - sizes).tolist(), last.tolist())), {i for _, v in hits for i in v[2]}


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(r) for r in out]


def overlaps(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = 10, shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """Each document row beside the benchmark words found in it.

    ``result`` has the counts, the sorted item ids with their digest, and
    ``spans``: character ranges of the original text covered by hits.
    Beyond ``shard_chars`` of windows the automaton is split and every batch of
    texts passes all shards in turn; a task holds one automaton at a time.
    """
    parts = shards(docs.sparkSession, windows(items, item_id, item_text, size), shard_chars)

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [words(t) for t in batch]
            lines = [f" {b' '.join(w).decode('utf-8', 'surrogatepass')} " if w else "" for w in tokens]
            ranges: list[list] = [[] for _ in lines]
            listed: list[set] = [set() for _ in lines]
            for part in parts:
                automaton = _automaton(part, len(parts) == 1)
                for i, line in enumerate(lines):
                    if len(automaton):
                        more, named = _scan(automaton, line)
                        ranges[i] += more
                        listed[i] |= named
            rows = []
            for text_value, w, found, named in zip(batch, tokens, ranges, listed):
                merged, spans = _merged(found), []
                if merged:
                    at = [m.span() for m in _WORD.finditer(text_value)]
                    spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in merged]
                names = sorted(named)
                rows.append((
                    len(w), sum(b - a for a, b in merged), len(names),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(merged), names, spans,
                ))
            yield pd.DataFrame(rows, columns=RESULT.names)

    return with_result(docs, F.pandas_udf(find, RESULT).asNondeterministic(), text)
