"""Packing along a space-filling curve.

A document's token counts are hashed to a signed vector of ``BUCKETS`` numbers, the
vector is projected to ``DIMS`` random directions, and the point's place on a Hilbert
curve is its key: documents with near vectors have near keys. Documents are sorted by
key over all partitions and laid end to end in that order; the line of tokens is
cut every ``length`` tokens. A document next to its neighbours thus shares
sequences with them. All sequences are full; what remains at the end is cut into
powers of two, so nothing has to be padded.

The sort moves four numbers per document. Positions come from running sums inside
each range and one total per range; documents are then cut where they are.

Defined cases: a NULL or empty text is the end token alone; documents with one key are
ordered by id (NULL first), then by place in the input; rows repeated are packed
each; without documents there are no sequences.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from wordlode.llm.rows import annotate
from wordlode.session import cut_lineage, spread

LENGTH = 1024
END = 0
BUCKETS = 4096
DIMS = 3
BITS = 16
# Encoded pieces kept in a worker (twice as many at most), and the longest that is kept.
KEPT, KEPT_CHARS = 200_000, 64
# ``tiktoken`` panics on a white-space run of a million signs; a tenth of that is left to ``tokenizers``.
LONG_RUN = 100_000

# A blank between two signs that are no white space always starts a new token.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r"\s\s|^\s|\s$")
_SPACE = re.compile(r"\s++")

# Fixed value: how byte-level tokenizers of this kind split a text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(path: str, special: list[str]) -> dict[bytes, int]:
    """The vocabulary of a byte-level ``tokenizers`` file as bytes.

    Such files write a byte that is no printable Latin-1 sign as the next free sign
    from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}


class _Pieces(dict):
    """Ids of pieces as bytes; a piece not met lately is encoded anew."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead, self.older = encode, lead, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = array("H", self.encode(self.lead + piece)).tobytes()
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class Encoder:
    """Token ids of whole texts by a byte-level ``tokenizers`` file, as 16-bit numbers.

    What stands before a blank between two non-blanks is never joined with what follows,
    so a text is encoded piece by piece and pieces met lately are remembered. Pieces
    are encoded by ``tiktoken`` with the vocabulary of the file, which gives the same ids
    as ``tokenizers`` in a quarter of the time; texts that hold a special token are
    encoded whole by ``tokenizers``, as are pieces with a very long white-space run.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        quick = tiktoken.Encoding(
            "pieces", pat_str=_PATTERN, mergeable_ranks=_ranks(path, self.special), special_tokens={}
        )

        def encode(piece: str) -> list[int]:
            if len(piece) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in _SPACE.finditer(piece)):
                return self.exact(piece)
            return quick.encode_ordinary(piece)

        self.first = _Pieces(encode, "")
        # All but the first piece begin with the blank at which they were split off.
        self.other = _Pieces(encode, " ")

    def exact(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        """Ids of a text, the end id behind them."""
        if any(s in text for s in self.special):
            return array("H", [*self.exact(text), END]).tobytes()
        parts = _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")
        ids = b"".join(map(self.other.__getitem__, parts[1:]))
        return self.first[parts[0]] + ids + _END_BYTES


_END_BYTES = array("H", [END]).tobytes()
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def directions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and sign of each possible id, and the random directions."""
    ids = np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(31)
    ids *= np.uint64(0xD6E8FEB86659FD93)
    bucket = (ids >> np.uint64(52)).astype(np.int64) % BUCKETS
    sign = np.where((ids >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    return bucket, sign, np.random.default_rng(0).normal(size=(BUCKETS, DIMS))


def point(ids: np.ndarray, bucket: np.ndarray, sign: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Whole coordinates of a document on the grid."""
    vector = np.bincount(bucket[ids], sign[ids], BUCKETS)
    vector = np.sign(vector) * np.sqrt(np.abs(vector))
    norm = np.sqrt(vector @ vector)
    # About standard normal, brought to an even spread.
    along = (vector @ axes) / norm if norm else np.zeros(DIMS)
    return np.floor((np.tanh(0.8 * along) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole coordinates below 2^bits.

    Going down from the highest bit, each step flips or swaps the lower bits so that the
    curve enters and leaves neighbouring cells; a Gray code is undone at the end, and
    the bits of all coordinates are interleaved.
    """
    x = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_bit, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x = [v ^ turn for v in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> b) & 1)
    return key


TOKENS = T.StructType([
    T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("key", T.LongType()),
])


def tokenized(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` and ``result``: 16-bit ids with the end id, their number, the Hilbert key."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        hashed = directions()
        for batch in batches:
            ids = [encode(t or "") for t in batch]
            points = np.array([point(np.frombuffer(i, "<u2"), *hashed) for i in ids]).reshape(-1, DIMS)
            yield pd.DataFrame({"ids": ids, "n": [len(i) // 2 for i in ids], "key": hilbert(points)})

    return annotate(spread(docs), F.pandas_udf(run, TOKENS).asNondeterministic()(F.col(f"`{text}`")))


def _running(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tokens before each document within its range."""
    part, total = TaskContext.get().partitionId(), 0
    for frame in frames:
        n = frame["n"].to_numpy(np.int64)
        before = total + np.cumsum(n) - n
        total += int(n.sum())
        yield pd.DataFrame({"rid": frame["rid"], "part": part, "before": before, "n": n})


def edges(total: int, length: int) -> tuple[int, list[int]]:
    """Number of full sequences, and where each sequence of the rest begins."""
    full, rest = divmod(total, length)
    starts, at = [], full * length
    while rest:
        size = 1 << (rest.bit_length() - 1)
        starts.append(at)
        at += size
        rest -= size
    return full, starts


PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _cut(total: int, length: int):
    full, tail = edges(total, length)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, data, at in zip(frame["doc_id"], frame["ids"], frame["at"]):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                n, start = len(ids), 0
                doc = None if pd.isna(doc) else int(doc)
                while start < n:
                    place = at + start
                    if place < full * length:
                        sequence, begin = divmod(place, length)
                        sequence, offset, end = sequence, begin, (sequence + 1) * length
                    else:
                        k = bisect_right(tail, place) - 1
                        sequence, offset = full + k, place - tail[k]
                        end = tail[k + 1] if k + 1 < len(tail) else total
                    size = min(n - start, end - place)
                    out.append((
                        doc, start, size, zlib.crc32(ids[start : start + size].tobytes()), n, sequence, offset,
                    ))
                    start += size
            found = pd.DataFrame(out, columns=[c.split()[0] for c in PIECE.split(", ")])
            yield found.astype({"doc_id": "Int64"})

    return run


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
         length: int = LENGTH) -> DataFrame:
    """One row per piece of a document: where it is in the document and in its sequence.

    ``path`` is a ``tokenizers`` file that the executors can read. ``sequence_id`` counts
    from 0, ``offset`` is the piece's place in the sequence.
    """
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # The number of a row is fixed by this write.
    ids = cut_lineage(
        tokenized(given, path).select("row.doc_id", "result.*")
        .withColumn("rid", F.monotonically_increasing_id())
    )
    placed = cut_lineage(
        ids.select("rid", "key", "doc_id", "n")
        .repartitionByRange("key", "doc_id", "rid").sortWithinPartitions("key", "doc_id", "rid")
        .mapInPandas(_running, "rid long, part int, before long, n long")
    )
    # One row per range.
    sums = placed.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    bases, total = [], 0
    for row in sums:
        bases.append((row["part"], total))
        total += row["n"]
    base = docs.sparkSession.createDataFrame(bases, "part int, base long")
    at = placed.join(F.broadcast(base), "part").select("rid", (F.col("base") + F.col("before")).alias("at"))
    return ids.select("rid", "doc_id", "ids").join(at, "rid").mapInPandas(_cut(total, length), PIECE)
