"""Near-duplicates by SimHash, searched with BK-trees.

A BK-tree over 64-bit fingerprints keys each child by its Hamming distance to
the parent. Two fingerprints within ``radius`` r bits differ by at most r in
their distance to any node, so a search follows only the edges in that band.

One tree over all fingerprints would be broadcast whole and grow with the data.
The trees are therefore sharded: the 64 bits are cut into blocks, and of b blocks
at least b - r are equal between two fingerprints within r bits. Every choice of
b - r blocks is a table and each value in it a shard with a tree of its own, so
every link is inside some shard. b grows with the number of fingerprints, which
changes the number of shards and not the links found. A shard above ``SHARD`` rows
is dealt out in pairs of parts, so no task holds more than two parts.

Equal fingerprints are one vertex throughout, and inside a shard all that lie
within the radius of a tree's root are linked to it once; members of such a group
are not paired with each other.

Defined cases: NULL, empty and blank texts have fingerprint zero and are linked
like any other; a text of fewer words than a shingle is one shingle; a NULL doc_id
takes part but names no group (a group of NULL ids has a NULL component); repeated
rows stay rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wordlode.llm.components import components
from wordlode.llm.rows import with_result
from wordlode.session import cut_lineage, gathered

# Rows in one part of a shard.
SHARD = 50_000
# Fingerprints that an average shard may hold before the blocks are made longer.
PER_SHARD = 2048
# Rows of whole shards whose trees are built together, and visits of nodes made at a time.
TOGETHER = 1 << 17
VISITS = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit i is set if it is set in over half of the shingle hashes."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = [0, *ends[: len(tokens) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4) -> DataFrame:
    """``row`` and ``result``: the fingerprint as a signed 64-bit number."""
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch], np.uint64)
            yield pd.Series(found.view(np.int64))

    return with_result(docs, F.pandas_udf(of, "long").asNondeterministic(), text)


def _blocks(n: int, radius: int) -> list[int]:
    """One mask per table: every choice of all blocks but ``radius``."""
    parts = radius + 1
    while n >> (64 * (parts - radius) // parts) > PER_SHARD and parts < radius + 5:
        parts += 1
    edges = [64 * i // parts for i in range(parts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, parts - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class _Forest:
    """Links between the fingerprints of each of many shards, by BK-trees joined with themselves.

    ``values`` are different within a shard, and the rows of a shard, numbered by ``shard`` from 0, follow
    each other. All trees are built and searched together, a level or some thousand visits at a time, so
    many small shards cost no more than a few large ones.
    """

    def __init__(self, values: np.ndarray, shard: np.ndarray, radius: int):
        self.values, self.radius, self.found = values, radius, [np.zeros((0, 2), np.int64)]
        self._join(*self._build(shard))

    @property
    def links(self) -> np.ndarray:
        return np.concatenate(self.found)

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.found.append(np.column_stack([a, b]))

    def _far(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.values[a] ^ self.values[b]).astype(np.int64)

    def _build(self, node: np.ndarray):
        """Builds all trees level by level and links what lies near a root; returns node, distance and row below it."""
        rows, below, nears, children = np.arange(len(node)), [], [], []
        self.roots, n = [], 0
        while len(rows):
            first = np.diff(node, prepend=-1) != 0
            starts = np.flatnonzero(first)
            self.roots.append(rows[starts])
            root = np.repeat(rows[starts], np.diff(np.append(starts, len(rows))))[~first]
            rows, node = rows[~first], node[~first]
            far = self._far(rows, root)
            close = far <= self.radius
            self._link(root[close], rows[close])
            below.append((node, far, rows))
            # A node and a distance in one number; nodes are numbered level by level, so all these ascend.
            key = node << 7 | far
            order = np.argsort(key, kind="stable")
            key, rows, close = key[order], rows[order], close[order]
            nears.append((key[close], rows[close]))
            key, rows = key[~close], rows[~close]
            n += len(starts)
            child = np.diff(key, prepend=-1) != 0
            children.append(key[child])
            node = n + np.cumsum(child) - 1
        self.roots = np.concatenate(self.roots) if self.roots else rows
        self.first_child = len(self.roots) - sum(map(len, children))
        self.children = np.concatenate([np.zeros(0, np.int64), *children])
        self.near, self.near_rows = (np.concatenate(c) for c in zip((np.zeros(0, np.int64),) * 2, *nears))
        return (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*below) if below else ((), (), ())))

    def _join(self, node: np.ndarray, far: np.ndarray, rows: np.ndarray) -> None:
        """Searches the rows below a node in the trees of its farther children, edge by edge within the radius.

        Rows near the root are linked through it; only pairs with a far child remain.
        """
        r, todo = self.radius, []

        def ask(node, least, most, asked):
            lo = np.searchsorted(self.children, node << 7 | np.maximum(least, r + 1))
            n = np.searchsorted(self.children, (node << 7 | most) + 1) - lo
            some = n > 0
            todo.append((lo[some], n[some], asked[some]))

        ask(node, far + 1, far + r, rows)
        while todo:
            lo, n, asked = todo.pop()
            stop = max(1, int(np.searchsorted(np.cumsum(n[:VISITS]), VISITS, "right")))
            if stop < len(n):
                todo.append((lo[stop:], n[stop:], asked[stop:]))
            lo, n, asked = lo[:stop], n[:stop], asked[:stop]
            if not len(n):
                continue
            node, asked = self.first_child + _ranges(lo, n), np.repeat(asked, n)
            far = self._far(asked, self.roots[node])
            linked = far <= r
            self._link(self.roots[node[linked]], asked[linked])
            ask(node, far - r, far + r, asked)
            # A near child has no tree: it is linked to the root, so one link is enough.
            other = np.flatnonzero(~linked & (far <= 2 * r))
            lo = np.searchsorted(self.near, node[other] << 7 | (far[other] - r))
            n = np.searchsorted(self.near, (node[other] << 7 | r) + 1) - lo
            self._one_link(lo[n > 0], n[n > 0], asked[other[n > 0]])

    def _one_link(self, lo: np.ndarray, n: np.ndarray, asked: np.ndarray) -> None:
        """Links each row asked to the first close one of its ``n`` near rows from ``lo``, more of them at a time."""
        width = 1
        while len(lo):
            size = np.minimum(n, width)
            for a in range(0, len(lo), max(1, VISITS // width)):
                b = a + max(1, VISITS // width)
                which = np.repeat(np.arange(a, min(b, len(lo))), size[a:b])
                member = self.near_rows[_ranges(lo[a:b], size[a:b])]
                close = np.flatnonzero(self._far(member, asked[which]) <= self.radius)
                which, at = np.unique(which[close], return_index=True)
                self._link(member[close[at]], asked[which])
                n[which] = 0
            left = n > size
            lo, n, asked = (lo + size)[left], (n - size)[left], asked[left]
            width = min(2 * width, VISITS)


class _Shard(_Forest):
    """Links between the fingerprints of one shard."""

    def __init__(self, values: np.ndarray, radius: int):
        super().__init__(values, np.zeros(len(values), np.int64), radius)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def _stars(links: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each index's group."""
    root = np.arange(n)
    a, b = np.asarray(links, np.int64).reshape(-1, 2).T
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (jumped := root[root] != root).any():
            root[jumped] = root[root[jumped]]
    return root


def _links(radius: int):
    """Pairs (a, b) that connect the members of each shard of a sorted partition."""
    def solve(keys: pd.DataFrame, shard: np.ndarray) -> pd.DataFrame:
        values = keys["fp"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((values, shard))
        values, shard = values[order], shard[order]
        once = np.append(True, (values[1:] != values[:-1]) | (shard[1:] != shard[:-1]))
        values, shard = values[once], shard[once]
        root = _stars(_Forest(values, shard, radius).links, len(values))
        moved = np.flatnonzero(root != np.arange(len(values)))
        signed = values.view(np.int64)
        return pd.DataFrame({"a": signed[root[moved]], "b": signed[moved]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, known = [], 0, 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            # A shard that goes on and on is looked at again only when it has doubled.
            if size < max(TOGETHER, 2 * known):
                continue
            frame = pd.concat(held, ignore_index=True)
            shard = _numbered(frame)
            cut = int(np.searchsorted(shard, shard[-1]))
            if cut:
                yield solve(frame.iloc[:cut], shard[:cut])
            held, size, known = [frame.iloc[cut:]], len(frame) - cut, len(frame) - cut
        if size:
            frame = pd.concat(held, ignore_index=True)
            yield solve(frame, _numbered(frame))

    return run


def _numbered(frame: pd.DataFrame) -> np.ndarray:
    """The number of each row's shard, from 0."""
    marks = frame[["which", "key", "pair"]].to_numpy(np.int64)
    return np.append(0, np.cumsum((marks[1:] != marks[:-1]).any(axis=1)))


def links(fps: DataFrame, radius: int = 4, shard: int = SHARD) -> DataFrame:
    """Pairs of distinct fingerprints that connect all within ``radius`` bits of each other.

    ``fps`` has one row per fingerprint in ``fp``.
    """
    masks = _blocks(fps.count(), radius)
    tables = F.array(*[
        F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)
    ])
    keyed = fps.select("fp", F.inline(tables)).select("fp", "which", "key")
    # Shards over the bound are rare, and there are at most rows / bound of them.
    large = (
        keyed.groupBy("which", "key").count().where(F.col("count") > shard)
        .select("which", "key", F.ceil(F.col("count") * 2 / shard).cast("long").alias("parts"))
    )
    dealt = keyed.join(large, ["which", "key"], "left").withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1)))
    )
    pairs = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda j: j != F.col("part")),
            lambda j: F.least(j, F.col("part")) * F.col("parts") + F.greatest(j, F.col("part")),
        )
    )
    spread_out = dealt.select("fp", "which", "key", F.explode_outer(pairs).alias("pair"))
    return (
        spread_out.repartition("which", "key", "pair")
        .sortWithinPartitions("which", "key", "pair")
        .mapInPandas(_links(radius), "a long, b long")
        .distinct()
    )


def _labelled(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that names the component), component_id."""
    rows = cut_lineage(
        fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
        .select("row.doc_id", F.xxhash64("row.text").alias("text_hash"), F.col("result").alias("fp"))
    )
    distinct = cut_lineage(gathered(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), rows.count()))
    n = distinct.count()
    linked = components(links(distinct.select("fp"), radius), n * len(_blocks(n, radius)))
    named = linked.join(distinct, F.col("node") == F.col("fp")).select("fp", "root", "first")
    named = named.join(named.groupBy("root").agg(F.min("first").alias("component")), "root")
    label = distinct.join(named.select("fp", "root", "component"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component")).alias("component_id"),
    )
    return rows.join(label, "fp")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
           radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Fingerprints within ``radius`` bits are linked; a component is all that can be
    reached, named by its smallest doc_id.
    """
    return _labelled(docs, doc_id, text, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """One row of each component with all its columns: the one with the smallest doc_id.

    NULL ids come last, rows that share an id are ordered by a hash of their text,
    and of rows equal in both one stays.
    """
    first = (
        _labelled(docs, doc_id, text, shingle, radius).groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("kept"))
        .select("kept.doc_id", "kept.text_hash")
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("d"), F.xxhash64(text).alias("h")
    )
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash"))
    once = Window.partitionBy("d", "h").orderBy(F.lit(0))
    return (
        rows.join(cut_lineage(gathered(first, docs.count())), same, "left_semi")
        .withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")
    )
