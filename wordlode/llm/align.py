"""How the tokens of two tokenizers line up, by merging their ends along a merge path.

A, a byte-level tokenizer, reads a blank and the text; B, a ``sentencepiece`` model that adds
the blank itself, reads the text. Both cut the same bytes, so a token is known by where
it ends. The ends of A and of B, each ascending over all texts of a batch, are merged: the
merge is a path of as many steps as there are tokens, and a diagonal of it is crossed
at one place, found by a binary search. Diagonals at equal distances cut the merge into
pieces of equal work, whatever the lengths of texts and tokens, which are merged apart
from each other. Each end met closes the overlap of one A token with one B token, its
link; an end in both closes a group. A diagonal may part equal ends, A before B: the
piece behind it sees that its first end is known already and drops it.

Texts are encoded once; their ids are written, and read by both steps that follow. A link
counts as often as its pair of ids is linked in all texts. The pairs are counted in the
tasks, then summed by Spark. Up to ``SENT`` different pairs, the counts go to all
tasks; more are joined with the links of each text, spread over salts.

Defined cases: a NULL or empty text, and one whose tokens do not spell out the blank and the
text (U+2581 becomes a blank, say), has no tokens: all numbers are 0, its groups are ''.
Strings of special tokens are plain text. Repeated rows count each, also in the counts of
pairs; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from wordlode.llm.pack import _CUT, _PATTERN, _SPACE, LONG_RUN, _ranks
from wordlode.llm.rows import pieces
from wordlode.session import cut_lineage, spread

MARK = "▁"
# Tokens of both sides that a piece of the merge takes.
PIECE = 1 << 15
# Characters of the texts that are merged at a time.
BATCH_CHARS = 1 << 20
# Pairs of ids a task holds before it passes them on, and those sent to all tasks (20 bytes each).
HELD, SENT = 2_000_000, 4_000_000
SALTS = 32
# Words a worker remembers, and their ids, before it starts afresh.
KEPT, KEPT_IDS = 400_000, 4_000_000

# A word between blanks that may not be encoded apart from its neighbours.
_JOINED = re.compile(r"^$|^\s|\s$|\s\s")


class Side:
    """Ids of the words met, one word after the other."""

    def __init__(self):
        self.ids = np.zeros(0, np.uint16)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def add(self, found: list) -> None:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        more = np.fromiter(itertools.chain.from_iterable(found), np.uint16, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, more])

    def of(self, words: np.ndarray) -> np.ndarray:
        """The ids of some words, joined."""
        sizes = self.sizes[words]
        shift = self.starts[words] - (np.cumsum(sizes) - sizes)
        return self.ids[np.arange(sizes.sum()) + np.repeat(shift, sizes)]


class Pair:
    """Two tokenizers, and what they make of a blank and a word for the words met."""

    def __init__(self, path_a: str, path_b: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path_a = path_a
        special = [t.content for t in Tokenizer.from_file(path_a).get_added_tokens_decoder().values()]
        ranks = _ranks(path_a, special)
        self.quick = tiktoken.Encoding("pieces", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.model = SentencePieceProcessor(model_file=path_b)
        size = self.model.get_piece_size()
        if max(ranks.values()) >= 1 << 16 or size > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.bytes_a = [b""] * (1 << 16)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [b""] * (1 << 16)
        for i in range(size):
            piece = self.model.id_to_piece(i)
            self.bytes_b[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)
        if any(MARK in self.model.id_to_piece(i).lstrip(MARK) for i in range(size)):
            raise ValueError("pieces of B may reach over a blank")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.a, self.b = Side(), Side()
        self.spelt, self.joined = np.zeros(0, bool), np.zeros(0, bool)

    def _first(self, word: str) -> list[int]:
        if len(word) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in _SPACE.finditer(word)):
            from tokenizers import Tokenizer

            # Such words are rare, and the tokenizer is large.
            exact = Tokenizer.from_file(self.path_a)
            exact.encode_special_tokens = True
            return exact.encode(" " + word, add_special_tokens=False).ids
        return self.quick.encode_ordinary(" " + word)

    def learn(self, words: list[str]) -> None:
        a = [self._first(w) for w in words]
        b = self.model.encode(words, num_threads=1) if words else []
        spelt = [
            b"".join(map(self.bytes_a.__getitem__, x)) == data and b"".join(map(self.bytes_b.__getitem__, y)) == data
            for x, y, data in zip(a, b, ((" " + w).encode("utf-8", "surrogatepass") for w in words))
        ]
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
        self.a.add(a)
        self.b.add(b)
        self.spelt = np.concatenate([self.spelt, np.array(spelt, bool)])
        joined = [_JOINED.search(w) is not None for w in words]
        self.joined = np.concatenate([self.joined, np.array(joined, bool)])

    def _numbers(self, split: list[list[str]]) -> np.ndarray:
        """The number of each word, after learning the new ones."""
        words = list(itertools.chain.from_iterable(split))
        self.learn(list(set(words).difference(self.index)))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of A and of B for each text.

        A blank between two signs that are no white space begins a token of either, so words
        are encoded apart. A text with a word that is not spelt out has no ids.
        """
        if len(self.index) > KEPT or len(self.a.ids) + len(self.b.ids) > KEPT_IDS:
            self.forget()
        split = [t.split(" ") if t and MARK not in t else [] for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        word = self._numbers(split)
        loose = np.unique(np.repeat(np.arange(len(texts)), sizes)[self.joined[word]])
        if len(loose):
            for i in loose:
                split[i] = _CUT.split(texts[i])
            sizes = np.array([len(s) for s in split], np.int64)
            word = self._numbers(split)
        text = np.repeat(np.arange(len(texts)), sizes)
        broken = np.zeros(len(texts), bool)
        broken[text[~self.spelt[word]]] = True
        whole = ~broken[text]
        word, text = word[whole], text[whole]
        sides = []
        for side in (self.a, self.b):
            ends = np.cumsum(np.bincount(text, side.sizes[word], len(texts)).astype(np.int64)) * 2
            data = side.of(word).tobytes()
            sides.append([data[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())])
        return list(zip(*sides))


_pairs: dict = {}


def encoders(path_a: str, path_b: str) -> Pair:
    """Both tokenizers, once per worker process."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of A lie before each diagonal of the merge; of equal ends A comes first.

    All diagonals are searched at once: the path crosses diagonal d behind the first i
    ends of A and d - i of B, with a[i - 1] <= b[d - i] and b[d - i - 1] < a[i].
    """
    low = np.maximum(diagonals - len(b), 0)
    high = np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        # Is the next end of A before the last one of B? Then it belongs before the diagonal.
        further = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonals - middle - 1, 0, len(b) - 1)])
        low = np.where(further, middle + 1, low)
        high = np.where(open_ & ~further, middle, high)


def merge(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each end of A or B, ascending and once: the number of the A token and of the B token that
    overlap up to it, and whether both end there.

    ``a`` and ``b`` are the ends of tokens that cut the same bytes.
    """
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    in_a = crossings(a, b, diagonals) if total else np.zeros(1, np.int64)
    in_b = diagonals - in_a
    found = [merge_piece(a, b, *p) for p in zip(in_a, in_a[1:], in_b, in_b[1:])]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool)
    return tuple(np.concatenate(column) for column in zip(*found))


def merge_piece(a, b, a_from, a_to, b_from, b_to):
    """What the merge of one piece gives; it needs no other piece but the ends beside it."""
    own_a, own_b = a[a_from:a_to], b[b_from:b_to]
    # The place of each B end among the A ends of the piece; one that A has too adds nothing.
    place = np.searchsorted(own_a, own_b)
    both = np.zeros(len(own_b), bool)
    inside = place < len(own_a)
    both[inside] = own_a[place[inside]] == own_b[inside]
    # Stitch at the front: the last end of the piece before may be the first one of B here.
    known = both.copy()
    if len(own_b) and a_from and a[a_from - 1] == own_b[0]:
        known[0] = True
    more, at = np.flatnonzero(~known), place[~known]
    # Ends of A in their order, with the other ends of B put in before the A ends that follow them.
    n = len(own_a) + len(more)
    from_b = np.zeros(n, bool)
    from_b[at + np.arange(len(more))] = True
    token_a = np.empty(n, np.int64)
    token_b = np.empty(n, np.int64)
    closes = np.zeros(n, bool)
    token_a[~from_b] = a_from + np.arange(len(own_a))
    token_a[from_b] = a_from + at
    token_b[from_b] = b_from + more
    under = b_from + np.searchsorted(own_b, own_a)
    token_b[~from_b] = under
    # Stitch at the back: the equal end of B may be the first one of the next piece.
    closes[~from_b] = b[np.minimum(under, len(b) - 1)] == own_a if len(b) else False
    return token_a, token_b, closes


class Aligned:
    """The links and groups of some texts, given by their ids, which follow each other in all arrays."""

    def __init__(self, pair: Pair, first: list[bytes], second: list[bytes], piece: int = PIECE):
        self.n_a = np.array([len(a) >> 1 for a in first], np.int64)
        self.n_b = np.array([len(b) >> 1 for b in second], np.int64)
        self.a = np.frombuffer(b"".join(first), np.uint16)
        self.b = np.frombuffer(b"".join(second), np.uint16)
        ends_a, ends_b = np.cumsum(pair.length_a[self.a]), np.cumsum(pair.length_b[self.b])
        self.link_a, self.link_b, self.closes = merge(ends_a, ends_b, piece)
        # Text of each link.
        self.link_text = np.repeat(np.arange(len(first)), self.n_a)[self.link_a]
        self.keys = (self.a[self.link_a].astype(np.int64) << 16) | self.b[self.link_b]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Exact sums of a number of each link over each text."""
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
        links = np.cumsum(np.bincount(self.link_text, minlength=len(self.n_a)))
        return np.diff(sums[np.concatenate([np.zeros(1, np.int64), links])])

    def group_digests(self) -> list[str]:
        """SHA-256 of the groups of each text, written ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        last_a = np.zeros(len(self.a), bool)
        last_b = np.zeros(len(self.b), bool)
        last_a[self.link_a[self.closes]] = True
        last_b[self.link_b[self.closes]] = True
        # Tokens of a group lie side by side, those of A first.
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        of_a = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(group_a, minlength=1))])
        of_b = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(group_b, minlength=1))])
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        if len(self.a):
            codes[np.arange(len(self.a)) + of_b[group_a]] = self.a.astype(np.int64) * 2 + last_a
            codes[np.arange(len(self.b)) + of_a[group_b + 1]] = (self.b.astype(np.int64) + (1 << 16)) * 2 + last_b
        table = _texts()
        digests, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            shown = b"".join(map(table.__getitem__, codes[at : at + n].tolist()))
            digests.append(hashlib.sha256(shown[:-1]).hexdigest() if n else "")
            at += n
        return digests


_shown: list[bytes] = []


def _texts() -> list[bytes]:
    """How a token is written: of A inside and at the end of its side of a group, then of B."""
    if not _shown:
        for end in (b"|", b";"):
            for i in range(1 << 16):
                _shown.extend((b"%d," % i, b"%d%s" % (i, end)))
    return _shown


IDS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _slices(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices of ``BATCH_CHARS`` bytes in some columns, so that no more is held as Python objects."""
    sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0), np.int64) for c in columns)
    for first, last in pieces(sizes.tolist(), BATCH_CHARS):
        yield batch.slice(first, last - first)


def encoded(docs: DataFrame, path_a: str, path_b: str, text: str, keys: tuple[str, ...]) -> DataFrame:
    """``row`` (the columns ``keys``), and the ids of A and B as 16-bit numbers, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = encoders(path_a, path_b)
        for batch in batches:
            for some in _slices(batch, "text"):
                found = pair.encode(some.column("text").to_pylist())
                sides = [pa.array([ids[k] for ids in found], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([some.column("row"), *sides], ["row", "a", "b"])

    row = F.struct(*[F.col(f"`{k}`").alias(k) for k in keys]).alias("row")
    given = docs.select(row, F.col(f"`{text}`").alias("text"))
    return cut_lineage(given.mapInArrow(run, T.StructType([given.schema["row"], *IDS.fields])))


def _aligned(batches: Iterator[pa.RecordBatch], pair: Pair, piece: int) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Slices of rows with their alignment."""
    # Words are not needed once all texts are encoded.
    pair.forget()
    for batch in batches:
        for some in _slices(batch, "a", "b"):
            yield some, Aligned(pair, some.column("a").to_pylist(), some.column("b").to_pylist(), piece)


def summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, with the sums of their counts."""
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.zeros(len(key), np.int64)
    np.add.at(count, which, np.concatenate(counts))
    return key, count


def _counted(path_a: str, path_b: str, piece: int):
    def rows(key, count):
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(count, pa.int64())], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, limit = [], [], 0, HELD
        for _, aligned in _aligned(batches, encoders(path_a, path_b), piece):
            key, count = np.unique(aligned.keys, return_counts=True)
            keys.append(key)
            counts.append(count)
            held += len(key)
            if held > limit:
                key, count = summed(keys, counts)
                if len(key) > HELD:
                    yield rows(key, count)
                    keys, counts, held = [], [], 0
                else:
                    keys, counts, held = [key], [count], len(key)
                limit = held + HELD
        if keys:
            yield rows(*summed(keys, counts))

    return run


def pair_counts(ids: DataFrame, path_a: str, path_b: str, piece: int = PIECE) -> DataFrame:
    """key (A id x 65536 + B id), n, best: the links of each pair of ids, and whether no other A id
    is linked with the B id more often."""
    found = ids.select("a", "b").mapInArrow(_counted(path_a, path_b, piece), "key long, n long")
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    # As many rows for a B id as A has ids at most.
    of_b = Window.partitionBy(F.col("key").bitwiseAND((1 << 16) - 1))
    return cut_lineage(counts.withColumn("best", F.col("n") == F.max("n").over(of_b)))


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
LINKS = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("times", T.LongType())]))


def _row(some: pa.RecordBatch, aligned: Aligned) -> dict:
    return {
        "row": some.column("row"), "n_a": aligned.n_a, "n_b": aligned.n_b, "n_groups": aligned.per_text(aligned.closes),
        "n_links": aligned.per_text(np.ones(len(aligned.keys), np.int64)), "groups_sha256": aligned.group_digests(),
    }


def _schema(ids: DataFrame, *more: T.StructField) -> T.StructType:
    numbers = [T.StructField(c, T.LongType()) for c in NUMBERS]
    return T.StructType([ids.schema["row"], *numbers, T.StructField("groups_sha256", T.StringType()), *more])


def _with_counts(path_a: str, path_b: str, sent, piece: int):
    """Rows of texts where the counts of all pairs are at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = sent.value
        for some, aligned in _aligned(batches, encoders(path_a, path_b), piece):
            at = np.searchsorted(keys, aligned.keys)
            yield pa.RecordBatch.from_pydict(_row(some, aligned) | {
                "n_best": aligned.per_text(best[at]), "count_sum": aligned.per_text(counts[at]),
            })

    return run


def _with_links(path_a: str, path_b: str, piece: int):
    """Rows of texts with their different pairs and how often each is linked."""
    kind = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, aligned in _aligned(batches, encoders(path_a, path_b), piece):
            ends = np.cumsum(np.bincount(aligned.link_text, minlength=len(aligned.n_a)))
            links = []
            for keys in np.split(aligned.keys, ends[:-1]):
                key, times = np.unique(keys, return_counts=True)
                links.append([{"key": k, "times": t} for k, t in zip(key.tolist(), times.tolist())])
            yield pa.RecordBatch.from_pydict(_row(some, aligned) | {"links": pa.array(links, kind)})

    return run


def _joined(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by a join of the links of each text with the counts of the pairs."""
    written = cut_lineage(rows.withColumn("rid", F.monotonically_increasing_id()))
    links = written.select("rid", F.explode("links").alias("link")).select(
        "rid", "link.key", "link.times", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int").alias("salt")
    )
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sums = links.join(salted, ["key", "salt"]).groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    return written.join(sums, "rid", "left").select(
        "row", *NUMBERS, "groups_sha256", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    )


def alignment(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
    sent: int = SENT, piece: int = PIECE,
) -> DataFrame:
    """``keys``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each text.

    ``path_a`` is a byte-level ``tokenizers`` file, ``path_b`` a ``sentencepiece`` model; executors
    read both.
    """
    ids = encoded(spread(docs), path_a, path_b, text, keys)
    counts = pair_counts(ids, path_a, path_b, piece)
    if counts.count() <= sent:
        # At most ``sent`` rows of three numbers.
        table = counts.orderBy("key").toPandas()
        held = docs.sparkSession.sparkContext.broadcast(
            (table["key"].to_numpy(np.int64), table["n"].to_numpy(np.int64), table["best"].to_numpy(bool))
        )
        sums = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
        found = ids.mapInArrow(_with_counts(path_a, path_b, held, piece), _schema(ids, *sums))
    else:
        links = T.StructField("links", LINKS)
        found = _joined(ids.mapInArrow(_with_links(path_a, path_b, piece), _schema(ids, links)), counts)
    return found.select("row.*", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
