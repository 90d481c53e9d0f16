"""Exact substring dedup by longest previous factors.

A byte goes if a string of ``size`` bytes over it also starts earlier (in a document
with a smaller id, or earlier in the same one): if its longest previous factor has
``size`` bytes or more. In suffix order the longest earlier match of a suffix is with the
nearest one before or behind it that starts earlier, so previous and next smaller
positions, and the least that neighbours share up to them, give all factors.

One suffix array over all bytes would be a shuffle of many times the corpus. Three
steps leave little to sort, and drop nothing:

1. Anchors. Each string of ``size`` bytes is owned by its smallest ``GRAM``-byte hash (the
   leftmost if tied). Equal strings have equal anchors at equal places, so only strings
   with the same anchor hash can be equal. An anchor and the stretch of strings that it
   owns (its context) is one row of four numbers for about forty bytes of text.
2. Equal contexts. All but the earliest of them are covered at once. Each task settles
   its own copies before the shuffle, so a text copied a million times is a few rows.
3. Different contexts of one anchor. Only their earliest copies are left; their bytes are
   fetched, their suffixes sorted anchor by anchor, and their factors found. An anchor with more than ``MANY``
   contexts is not sorted in one task: its strings are compared through their hashes by
   a grouped minimum.

Hashes have 64 bits for anchors and 48 more for contexts, 128 for single strings.

Defined cases: a NULL text is empty and has nothing to remove; documents without an id have
no place in the order, they remove nothing and lose nothing; rows that share an id
are one place in the order, so the same start in both is not earlier, and rows
repeated in full get the same result each; texts shorter than ``size`` are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wordlode.llm.rows import annotate
from wordlode.session import cut_lineage, spread

SIZE = 100
GRAM = 16
BLOCK = 1 << 20
# Contexts of one anchor that one task may sort.
MANY = 5_000
# Suffixes sorted at once.
SORTED = 1 << 17
# Neighbours compared at once.
COMPARED = 1 << 14

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_INDEX = np.uint64(BLOCK - 1)

# ``place``: start of the anchor, then 33 bits that tell rows with one id apart.
_TAG = 33
_TAG_MASK = (1 << _TAG) - 1
# ``context``: 48 bits of hash, strings before the anchor, strings owned less one.
ROW = "hash long, context long, doc long, place long, last long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _A
    x ^= x >> np.uint64(29)
    x *= _B
    return x ^ (x >> np.uint64(32))


def _loads(data: np.ndarray, n: int, at: int) -> np.ndarray:
    """The eight bytes from each of n positions on, as numbers."""
    return np.ndarray((n,), "<u8", data, at, (1,)).astype(np.uint64)


def _grams(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    return _mixed(_mixed(_loads(data, n, 0) + _B) * _A + _loads(data, n, GRAM - 8))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_A), -1, 1 << 64))
    up, down = np.full(n, _A, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS = None


def _anchors(parts: list[bytes], size: int):
    """Owned stretches of some texts in one array: text, anchor, first and last string, hashes."""
    global _POWERS
    if _POWERS is None:
        _POWERS = _powers(BLOCK + SIZE)
    lengths = np.array([len(p) for p in parts])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.frombuffer(b"".join(parts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < size:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = _grams(data)
    window = size - GRAM + 1
    # The smallest gram of each window, the leftmost if tied, by doubling.
    least = (grams & ~_INDEX) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= window:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    n = len(grams) - window + 1
    least = np.minimum(least[:n], least[window - width : window - width + n])
    owner = (least & _INDEX).astype(np.int64)
    text = np.repeat(np.arange(len(parts)), lengths)[:n]
    inside = np.arange(n) + size <= ends[text]
    change = np.ones(n, bool)
    change[1:] = (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
    edges = np.append(np.flatnonzero(change), n)
    first, last = edges[:-1], edges[1:] - 1
    own = inside[first]
    first, last = first[own], last[own]
    at = owner[first]
    up, down = _POWERS
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * up[: len(grams)])])
    context = _mixed((total[last + window] - total[first]) * down[first])
    return text[first], at - starts[text[first]], first - starts[text[first]], last - starts[text[first]], grams[at], context


def _stretches(texts: list[bytes], size: int):
    """``_anchors`` of whole texts in blocks; long texts in blocks that overlap."""
    block: list[tuple[int, int, bytes]] = []
    held = 0
    room = BLOCK - size

    def settle():
        text, at, first, last, gram, context = _anchors([p for _, _, p in block], size)
        owner = np.array([i for i, _, _ in block])[text] if len(text) else text
        base = np.array([b for _, b, _ in block])[text] if len(text) else text
        return owner, at + base, first + base, last + base, gram, context

    for i, data in enumerate(texts):
        for base in range(0, max(1, len(data) - size + 1), room):
            part = data[base : base + room + size - 1]
            if held + len(part) >= BLOCK:
                yield settle()
                block, held = [], 0
            block.append((i, base, part))
            held += len(part)
    if block:
        yield settle()


def merged(key: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping and touching ranges of each key as one; ``key`` holds small numbers."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    if not len(key):
        return key, start, end
    # Ranges of different keys are set far apart, so one running maximum serves all.
    far = np.int64(1) << 33
    reach = np.maximum.accumulate(end + key * far)
    new = np.ones(len(key), bool)
    new[1:] = start[1:] + key[1:] * far > reach[:-1]
    first = np.flatnonzero(new)
    return key[first], start[first], np.append(reach[first[1:] - 1], reach[-1]) - key[first] * far


def _spans(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Rows of covered ranges in the shape of anchors: ``last`` tells them apart."""
    ids, key = np.unique(np.stack([doc, tag], 1), axis=0, return_inverse=True)
    key, start, end = merged(key.ravel(), start, end)
    return pd.DataFrame({
        # Dealt out by document and not by content.
        "hash": _mixed(ids[key, 0].astype(np.uint64) + ids[key, 1].astype(np.uint64)).view(np.int64),
        "context": -1, "doc": ids[key, 0], "place": start << _TAG | ids[key, 1], "last": end,
    })


def _unpacked(context: np.ndarray, place: np.ndarray):
    """Anchor, tag, first and last string of packed rows."""
    at = place >> _TAG
    first = at - ((context >> 7) & 127)
    return at, place & _TAG_MASK, first, first + (context & 127)


def _earliest(rows: dict[str, np.ndarray]):
    """Sorts by class and position; marks the earliest rows of each class."""
    order = np.lexsort((rows["place"], rows["doc"], rows["context"], rows["hash"]))
    rows = {k: v[order] for k, v in rows.items()}
    n = len(order)
    new = np.ones(n, bool)
    new[1:] = (rows["hash"][1:] != rows["hash"][:-1]) | (rows["context"][1:] != rows["context"][:-1])
    head = np.flatnonzero(new)
    leader = np.repeat(head, np.diff(np.append(head, n)))
    at = rows["place"] >> _TAG
    return rows, (rows["doc"] == rows["doc"][leader]) & (at == at[leader])


def _find(size: int):
    """Anchor rows of each batch of documents, with its own copies settled."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t.encode("utf-8", "surrogatepass") for t in frame["text"]]
            docs, tags = frame["doc"].to_numpy(np.int64), frame["tag"].to_numpy(np.int64)
            parts = list(_stretches(texts, size))
            if not parts:
                continue
            text, at, first, last, gram, context = (np.concatenate(x) for x in zip(*parts))
            packed = (context >> np.uint64(16) << np.uint64(14)).astype(np.int64) | (at - first) << 7 | (last - first)
            rows, early = _earliest({
                "hash": gram.view(np.int64), "context": packed, "doc": docs[text], "place": at << _TAG | tags[text],
            })
            yield pd.DataFrame({k: v[early] for k, v in rows.items()} | {"last": -1})
            late = {k: v[~early] for k, v in rows.items()}
            _, tag, first, last = _unpacked(late["context"], late["place"])
            if len(tag):
                yield _spans(late["doc"], tag, first, last + size)

    return run


def _settle(size: int):
    """Covered ranges, and the earliest contexts of anchors with several, from rows sorted by class."""
    columns = ["hash", "context", "doc", "place"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Of the last anchor: the earliest rows of its one context so far, held back until
        # a second one is seen; later on only the earliest row of the current context.
        carried, several = {c: np.zeros(0, np.int64) for c in columns}, False
        for frame in frames:
            ready = frame["last"].to_numpy() >= 0
            if ready.any():
                yield frame[ready]
            if ready.all():
                continue
            given = several & np.ones(len(carried["hash"]), bool)
            rows = {c: np.concatenate([carried[c], frame.loc[~ready, c].to_numpy(np.int64)]) for c in columns}
            n = len(rows["hash"])
            given = np.concatenate([given, np.zeros(n - len(given), bool)])
            new_hash, new_class = np.ones(n, bool), np.ones(n, bool)
            new_hash[1:] = rows["hash"][1:] != rows["hash"][:-1]
            new_class[1:] = new_hash[1:] | (rows["context"][1:] != rows["context"][:-1])
            head = np.flatnonzero(new_class)
            leader = np.repeat(head, np.diff(np.append(head, n)))
            at = rows["place"] >> _TAG
            early = (rows["doc"] == rows["doc"][leader]) & (at == at[leader])
            if not early.all():
                _, tag, first, last = _unpacked(rows["context"][~early], rows["place"][~early])
                yield _spans(rows["doc"][~early], tag, first, last + size)
            group = np.cumsum(new_hash) - 1
            mixed = np.bincount(group, new_class) > 1
            mixed[0] |= several
            wanted = early & mixed[group] & ~given
            if wanted.any():
                yield pd.DataFrame({c: v[wanted] for c, v in rows.items()} | {"last": -1})
            several = bool(mixed[-1])
            keep = np.arange(n) == leader[-1] if several else early & (group == group[-1])
            carried = {c: v[keep] for c, v in rows.items()}

    return run


def _place(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row``, the id, 33 bits of the text's hash and the text."""
    tag = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))), 64 - _TAG)
    return docs.select(
        F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc"), tag.alias("tag"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def _contexts(size: int):
    """The bytes of wanted contexts: one row per context."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, tag, text, wanted in zip(frame["doc"], frame["tag"], frame["text"], frame["wanted"]):
                data = text.encode("utf-8", "surrogatepass")
                for w in wanted:
                    at = w["place"] >> _TAG
                    first = at - ((w["context"] >> 7) & 127)
                    last = first + (w["context"] & 127)
                    out.append((w["hash"], doc, tag, first, data[first : last + size]))
            yield pd.DataFrame(out, columns=["hash", "doc", "tag", "first", "bytes"])

    return run


CONTEXT = "hash long, doc long, tag long, first long, bytes binary"


def _suffixes(frame: pd.DataFrame, size: int):
    """Context, position and bytes of every string of ``size`` bytes in some contexts."""
    lengths = frame["bytes"].map(len).to_numpy()
    data = np.frombuffer(b"".join(frame["bytes"]), np.uint8)
    begin = np.cumsum(lengths) - lengths
    many = lengths - size + 1
    which = np.repeat(np.arange(len(frame)), many)
    shift = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    strings = np.lib.stride_tricks.sliding_window_view(data, size)[begin[which] + shift]
    return which, frame["first"].to_numpy(np.int64)[which] + shift, np.ascontiguousarray(strings)


def _one_side(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """What each suffix shares with the nearest one before it in suffix order that starts earlier.

    ``common`` is what a suffix shares with its neighbour before. All previous smaller positions are
    found at once: blocks of neighbours that start no earlier are skipped, from the longest block
    down, and what is shared shrinks to the least within them.
    """
    n = len(position)
    least, shared = [position], [common]
    while 2 << (len(least) - 1) <= n:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
        shared.append(np.minimum(shared[-1][:-half], shared[-1][half:]))
    # All from ``at`` to the suffix itself start no earlier; ``held`` is the least shared between them.
    at = np.arange(n)
    held = np.full(n, np.iinfo(common.dtype).max, common.dtype)
    for k in range(len(least) - 1, -1, -1):
        width = 1 << k
        # A block may have to be skipped twice where the longest is not a power of two.
        for _ in range(2 if k == len(least) - 1 else 1):
            skip = np.flatnonzero(at >= width)
            skip = skip[least[k][at[skip] - width] >= position[skip]]
            to = at[skip] - width
            held[skip] = np.minimum(held[skip], shared[k][to + 1])
            at[skip] = to
    return np.where(at > 0, np.minimum(held, common[at]), 0)


def previous_factors(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The longest previous factor of each suffix, given in suffix order.

    ``position`` is where it starts, ``common`` how much it shares with the suffix before it (0 for the
    first). A longest earlier match is with the nearest suffix on either side that starts
    earlier: the factor is the larger of both.
    """
    behind = np.append(common[1:], 0).astype(common.dtype)
    return np.maximum(_one_side(position, common), _one_side(position[::-1], behind[::-1])[::-1])


def _factors(frame: pd.DataFrame, size: int) -> pd.DataFrame:
    """Covered ranges of some contexts, by the longest previous factors of their suffixes.

    Suffixes are cut at ``size`` bytes, and so are factors: one of ``size`` says that the same bytes
    start earlier. Rows that share an id are one place in the order.
    """
    which, start, strings = _suffixes(frame, size)
    order = np.argsort(strings.view(f"S{size}").ravel(), kind="stable")
    common = np.zeros(len(order), np.uint8)
    for a in range(1, len(order), COMPARED):
        b = min(a + COMPARED, len(order))
        differs = strings[order[a:b]] != strings[order[a - 1 : b - 1]]
        common[a:b] = np.where(differs.any(axis=1), differs.argmax(axis=1), size)
    del strings
    which, start = which[order], start[order]
    doc = frame["doc"].to_numpy(np.int64)[which]
    place = np.lexsort((start, doc))
    later = np.zeros(len(order), np.int64)
    later[1:] = (doc[place[1:]] != doc[place[:-1]]) | (start[place[1:]] != start[place[:-1]])
    position = np.empty(len(order), np.int32)
    position[place] = np.cumsum(later)
    repeated = previous_factors(position, common) >= size
    tag = frame["tag"].to_numpy(np.int64)[which]
    return _spans(doc[repeated], tag[repeated], start[repeated], start[repeated] + size)


def _sorted_groups(size: int):
    """``_factors`` of whole anchors at a time, from rows sorted by anchor."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            hashes = frame["hash"].to_numpy(np.int64)
            edges = [0, *(np.flatnonzero(hashes[1:] != hashes[:-1]) + 1).tolist()] if len(hashes) else [0]
            strings = np.concatenate([[0], np.cumsum(frame["bytes"].map(len).to_numpy() - size + 1)])
            begin = 0
            for a, b in zip(edges, edges[1:]):
                if strings[b] - strings[begin] > SORTED and a > begin:
                    yield _factors(frame.iloc[begin:a], size)
                    begin = a
            if edges[-1] > begin:
                yield _factors(frame.iloc[begin : edges[-1]], size)
            rest = frame.iloc[edges[-1] :]
        if rest is not None and len(rest):
            yield _factors(rest, size)

    return run


def _string_hashes(size: int):
    """Two hashes of every string of some contexts, with its place."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 2000):
                part = frame.iloc[a : a + 2000]
                which, position, strings = _suffixes(part, size)
                words = np.zeros((len(strings), -(-size // 8) * 8), np.uint8)
                words[:, :size] = strings
                x = np.zeros(len(strings), np.uint64)
                y = np.full(len(strings), size, np.uint64)
                for column in words.view("<u8").T:
                    x = _mixed(x * _A + column)
                    y = _mixed((y ^ column) * _B + _A)
                yield pd.DataFrame({
                    "x": x.view(np.int64), "y": y.view(np.int64),
                    "doc": part["doc"].to_numpy(np.int64)[which], "tag": part["tag"].to_numpy(np.int64)[which],
                    "at": position,
                })

    return run


def _by_minimum(contexts: DataFrame, size: int) -> DataFrame:
    """Covered ranges of contexts of crowded anchors, without gathering any of them."""
    strings = contexts.mapInPandas(_string_hashes(size), "x long, y long, doc long, tag long, at long")
    first = strings.groupBy("x", "y").agg(F.min(F.struct("doc", "at")).alias("first"))
    return strings.join(first, ["x", "y"]).where(
        (F.col("doc") != F.col("first.doc")) | (F.col("at") != F.col("first.at"))
    ).select(
        "doc", "tag", F.struct(F.col("at").alias("start"), (F.col("at") + size).alias("end")).alias("span")
    )


def covered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
            many: int = MANY) -> DataFrame:
    """doc, tag, spans: the byte ranges to remove from each document that loses any."""
    if not GRAM < size <= 128:
        raise ValueError(f"size must be above {GRAM} and at most 128 bytes")
    placed = _place(docs, doc_id, text).where("doc IS NOT NULL").select("doc", "tag", "text")
    rows = (
        spread(placed).mapInPandas(_find(size), ROW)
        .repartition("hash").sortWithinPartitions("hash", "context", "doc", "place")
    )
    settled = cut_lineage(rows.mapInPandas(_settle(size), ROW))
    wanted = settled.where("last < 0")
    tag = F.col("place").bitwiseAND(F.lit(_TAG_MASK))
    crowded = wanted.groupBy("hash").count().where(F.col("count") > many).select("hash")
    by_doc = wanted.groupBy("doc", tag.alias("tag")).agg(
        F.collect_set(F.struct("hash", "context", "place")).alias("wanted")
    )
    contexts = cut_lineage(
        placed.dropDuplicates(["doc", "tag"]).join(by_doc, ["doc", "tag"]).mapInPandas(_contexts(size), CONTEXT)
    )
    crowded = cut_lineage(crowded)
    sorted_spans = (
        contexts.join(crowded, "hash", "left_anti").repartition("hash").sortWithinPartitions("hash")
        .mapInPandas(_sorted_groups(size), ROW)
    )
    ranges = settled.where("last >= 0").unionByName(sorted_spans).select(
        "doc", tag.alias("tag"),
        F.struct(F.shiftright("place", _TAG).alias("start"), F.col("last").alias("end")).alias("span"),
    )
    hashed = _by_minimum(contexts.join(crowded, "hash", "left_semi"), size)
    return ranges.unionByName(hashed).groupBy("doc", "tag").agg(F.collect_list("span").alias("spans"))


RESULT = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType()),
])


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
           many: int = MANY, with_bytes: bool = True, with_text: bool = False) -> DataFrame:
    """``row`` and ``result``: what is left of each text when later copies are removed.

    ``kept`` holds the remaining bytes if ``with_bytes``; a cut may fall inside a character.
    ``kept_text`` holds them as text if ``with_text``, without the halves of cut characters.
    """
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, all_spans in batches:
            out = []
            for value, spans in zip(texts, all_spans):
                data = (value or "").encode("utf-8", "surrogatepass")
                kept, removed, n = data, 0, 0
                if spans is not None and len(spans):
                    start = np.array([s["start"] for s in spans], np.int64)
                    end = np.array([s["end"] for s in spans], np.int64)
                    _, start, end = merged(np.zeros(len(start), np.int64), start, end)
                    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    removed, n = int((end - start).sum()), len(start)
                out.append((len(data), removed, n, hashlib.sha256(kept).hexdigest(),
                            kept if with_bytes else None, kept.decode("utf-8", "ignore") if with_text else None))
            yield pd.DataFrame(out, columns=RESULT.names)

    spans = covered(docs, doc_id, text, size, many)
    placed = _place(docs, doc_id, text).select("row", "doc", "tag")
    joined = placed.join(spans, ["doc", "tag"], "left")
    udf = F.pandas_udf(cut, RESULT).asNondeterministic()
    return joined.select("row", udf(F.col(f"row.`{text}`"), F.col("spans")).alias("result"))
