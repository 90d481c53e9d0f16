"""Collocations by SON partitioning: mine shards completely, then count what they found exactly.

A shard is a bounded part of the corpus that one task holds. With ``support`` for a language
of ``C`` bytes, a shard with ``c`` of them mines all phrases of one to ``LONGEST`` words that occur
at least t = ceil(support * c / C) times in it, level by level: a phrase is looked at only
where both phrases of one word less are frequent. A phrase that is rarer than its share in
every shard is rarer than ``support`` in all, so the union of what shards find misses
nothing. A phrase occurs at most t - 1 times in a shard that did not find it, so the
thresholds less one and what shards found beyond them bound its count; only phrases whose bound
reaches ``support`` stay candidates. The union is kept by bits of phrase hashes, summed piece by
piece in Spark, and its size does not grow with the corpus: phrases that share a bit
only add candidates. A task adds up what its shards find in one table of all bits and passes that on once.

With many shards the thresholds are one, and every phrase of a shard adds to its bit. Phrases of three or
four words are therefore mined in a pass of their own, which looks only at those whose words and pairs of
words are candidates in the whole corpus, and have a table of their own.

A last pass counts all candidates in every shard, sums the counts over shards and
drops what stays below ``support``, so results are exact whatever the shards are.

Everything is per language. A candidate of two words or more is cut behind each word; with
a, l, r the counts of the phrase and both parts, the lowest floor(SCALE * a / (l + r)) over
the cuts is its score. A candidate inside a longer one that has at least ``INSIDE``
percent of its count is dropped.

Defined cases: a NULL text is empty; a NULL language is ``und``; A-Z are lower-cased, pieces
end at ``.,;:!?`` and line ends, words at blanks and tabs; a shard takes whole texts, so a
text above the bound is a shard of its own; repeated rows count each; cuts that tie after
flooring give the smallest first part; without phrases there are no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wordlode.session import cut_lineage, drop_table, spread

LONGEST = 4
SCALE = 2_000_000
INSIDE = 80
# Bytes of text in a shard: a task holds a few numbers for each of its words.
SHARD_BYTES = 24 << 20
# Shards that are counted together once candidates are known: a task then holds little but the text.
COUNTED_SHARDS = 2
# Shards of a task, which adds up what they find.
TASK_SHARDS = 16
# Lengths that are mined together.
TOGETHER = ((1, 2), (3, LONGEST))
# Bits of the union (16 MB), and of a piece of it that is summed by itself.
BITS = 27
PIECE_BITS = 1 << 15
PIECES_AT_ONCE = 256
# The most that one shard adds to a bit; ``support`` may not be more.
MOST = 255
# Places of phrases that a task sorts at a time.
AT_ONCE = 500_000
# Languages whose sizes the driver holds.
MAX_LANGS = 10_000
# Most rows of a language that one task ranks are ``top`` for each salt.
SALTS = 64
# Cuts whose first or last part is a single word are spread over so many copies of its count.
WORD_SALTS = 32

BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c == 9 else 0xFF if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Words of a text, with ``BREAK`` between pieces and at the end."""
    return (text + b"\n").translate(_TABLE).replace(BREAK, b" \xff ").split()


class Numbers(dict):
    """Number of each word of a language in a shard, from 1; 0 is the break."""

    def __init__(self, lang: str):
        super().__init__({BREAK: 0})
        self.lang, self.words, self.numbers, self.bytes = lang, [BREAK], array("i"), 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n

    def add(self, text: bytes) -> None:
        self.numbers.extend(map(self.__getitem__, words(text)))
        self.bytes += len(text)

    def taken(self) -> np.ndarray:
        """All numbers in their order; they and the lookup are let go."""
        self.clear()
        numbers, self.numbers = self.numbers, array("i")
        return np.frombuffer(numbers, np.int32)

    def hashes(self) -> np.ndarray:
        seed = xxhash.xxh64_intdigest(self.lang.encode())
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))


def shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[Numbers]]:
    """The languages of each shard of a task's rows (lang, text as bytes)."""
    langs: dict[str, Numbers] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_py()
            if held and held + len(data) > limit:
                yield list(langs.values())
                langs, held = {}, 0
            if lang not in langs:
                langs[lang] = Numbers(lang)
            langs[lang].add(data)
            held += len(data)
    if langs:
        batch = text = data = None
        yield list(langs.values())


def levels(numbers: np.ndarray, size: int, keep, at_once: int = AT_ONCE, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, word numbers and counts of the phrases that ``keep(members, counts)`` keeps.

    A phrase is looked at only where both phrases of one word less were kept. About
    ``at_once`` places are sorted at a time, those whose first parts fall in one class, so
    a length may come in several lots.
    """
    counts = np.bincount(numbers, minlength=size)[1:]
    members = np.arange(1, size, dtype=np.int32)[:, None]
    ok = keep(members, counts)
    members = members[ok]
    yield 1, members, counts[ok]
    # The number of the kept phrase that begins at each place, or 0.
    at = np.concatenate([np.zeros(1, np.int32), np.where(ok, np.cumsum(ok), 0).astype(np.int32)])[numbers]
    del numbers
    for length in range(2, longest + 1):
        if not len(members) or len(at) < 2:
            return
        first, last = at[:-1], at[1:]
        both = (first != 0) & (last != 0)
        # First parts from one number to the next have about ``at_once`` places.
        before = np.cumsum(np.bincount(first[both], minlength=len(members) + 1))
        lots = np.unique(np.searchsorted(before, np.arange(at_once, before[-1], at_once), side="right"))
        # Nothing is built on the longest.
        going_on = length < longest
        following = np.zeros(len(first) if going_on else 0, np.int32)
        longer, done = [np.zeros((0, length), np.int32)], 0
        for begin, end in zip([0, *lots], [*lots, len(members) + 1]):
            places = np.flatnonzero(both & (first >= begin) & (first < end))
            key = first[places].astype(np.int64) * (len(members) + 1) + last[places]
            key, which, counts = np.unique(key, return_inverse=True, return_counts=True)
            head, tail = np.divmod(key, len(members) + 1)
            found = np.concatenate([members[head - 1], members[tail - 1][:, -1:]], axis=1)
            ok = keep(found, counts)
            found, counts = found[ok], counts[ok]
            if going_on:
                following[places] = np.where(ok, np.cumsum(ok) + done, 0).astype(np.int32)[which]
                done += len(found)
                longer.append(found)
            yield length, found, counts
        members, at = np.concatenate(longer), following


def bits(members: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The bit of each phrase."""
    mixed = np.full(len(members), members.shape[1], np.uint64)
    for column in members.T:
        mixed = (mixed ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def _marked(unions: list[bytes], members: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of phrases of one length are set in the union for it."""
    which = next(i for i, lengths in enumerate(TOGETHER) if members.shape[1] <= lengths[-1])
    bit = bits(members, hashes)
    return (np.frombuffer(unions[which], np.uint8)[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1


def _add(table: np.ndarray, bit: np.ndarray, more: np.ndarray) -> None:
    """Add to bits, of which several may be the same, up to ``MOST``."""
    key = np.sort(bit << 8 | np.minimum(more, MOST))
    starts = np.flatnonzero(np.diff(key >> 8, prepend=-1))
    if len(starts):
        at = key[starts] >> 8
        table[at] = np.minimum(np.add.reduceat(key & 255, starts) + table[at], MOST)


def _mine(totals: dict[str, int], support: int, limit: int, shortest: int, longest: int, unions):
    """What the shards of a task find beyond their thresholds, as pieces: places and counts, or the counts of all places.

    For piece -1, the thresholds less one. Shorter phrases are kept where ``unions`` has them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, below = np.zeros(1 << BITS, np.uint8), {}
        for langs in shards(batches, limit):
            for lang in langs:
                if not lang.bytes:
                    continue
                least = -(-support * lang.bytes // totals[lang.lang])
                below[lang.lang] = below.get(lang.lang, 0) + least - 1
                hashes = lang.hashes()

                def keep(members, counts):
                    return counts >= least if members.shape[1] >= shortest else _marked(unions.value, members, hashes)

                for size, members, counts in levels(lang.taken(), len(lang.words), keep, longest=longest):
                    if size >= shortest:
                        _add(table, bits(members, hashes), counts - least + 1)
        if not below:
            return
        table = table.reshape(-1, PIECE_BITS)
        filled = np.flatnonzero(table.any(axis=1)).tolist()
        for k in range(0, len(filled), PIECES_AT_ONCE):
            yield _pieces((piece, None, 0, *_packed(table[piece])) for piece in filled[k : k + PIECES_AT_ONCE])
        yield _pieces((-1, lang, n, b"", b"") for lang, n in below.items())

    return run


def _packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Places and counts above zero, or no places and all counts if that is shorter."""
    at = np.flatnonzero(counts)
    if 3 * len(at) >= len(counts):
        return b"", counts.tobytes()
    return at.astype(np.uint16).tobytes(), counts[at].tobytes()


def _pieces(rows) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["piece", "lang", "below", "at", "more"])


def _reaching(least: int):
    """The bits of each piece whose sum over shards reaches ``least``; rows of a piece follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums = None, np.zeros(PIECE_BITS, np.int64)

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], ["piece", "bits"]
            )

        for batch in batches:
            for piece, at, more in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if piece != current:
                    if current is not None:
                        yield done()
                    current = piece
                    sums[:] = 0
                at, more = np.frombuffer(at.as_py(), np.uint16), np.frombuffer(more.as_py(), np.uint8)
                if len(at):
                    sums[at] += more
                else:
                    sums += more
        if current is not None:
            yield done()

    return run


def _count(unions, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(lang, size, phrases, counts):
            for at in range(0, len(phrases), 100_000):
                some = phrases[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(some)), pa.array([size] * len(some), pa.int32()),
                    pa.array(some, pa.binary()).cast(pa.string()), pa.array(counts[at : at + 100_000], pa.int64()),
                ], ["lang", "size", "phrase", "n"])

        for langs in shards(batches, limit):
            for lang in langs:
                hashes = lang.hashes()
                numbers = lang.taken()
                # The number of all words.
                yield from rows(lang.lang, 0, [b""], np.array([np.count_nonzero(numbers)]))

                def candidate(members, _):
                    return _marked(unions.value, members, hashes)

                found = levels(numbers, len(lang.words), candidate)
                del numbers
                for size, members, counts in found:
                    texts = map(b" ".join, zip(*[map(lang.words.__getitem__, c.tolist()) for c in members.T]))
                    yield from rows(lang.lang, size, list(texts), counts)

    return run


def candidate_bits(docs: DataFrame, totals: dict[str, int], support: int, limit: int, lengths: tuple[int, int], unions) -> bytes:
    """The union of the phrases of some lengths that may reach ``support``, as a bitmap of 2^BITS bits."""
    found = cut_lineage(docs.mapInArrow(
        _mine(totals, support, limit, *lengths, unions), "piece int, lang string, below long, at binary, more binary"
    ))
    # Shards' thresholds less one add up to less than ``support``.
    below = found.where("piece < 0").groupBy("lang").agg(F.sum("below").alias("below")).agg(F.max("below")).first()[0] or 0
    pieces = found.where("piece >= 0").select("piece", "at", "more")
    reached = pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        _reaching(support - below), "piece int, bits binary"
    )
    union = bytearray((1 << BITS) // 8)
    size = PIECE_BITS // 8
    for row in reached.collect():  # at most the size of the bitmap
        union[row["piece"] * size : (row["piece"] + 1) * size] = row["bits"]
    drop_table(found)
    return bytes(union)


def phrase_counts(docs: DataFrame, support: int, text: str = "text", lang: str = "lang",
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, size, phrase, n of all phrases of 1 to ``LONGEST`` words with at least ``support`` occurrences.

    The row of size 0 counts all words of a language.
    """
    if not 1 <= support <= MOST:
        raise ValueError(f"support must lie between 1 and {MOST}")
    given = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    sizes = given.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size")).limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    totals = {r["lang"]: r["size"] for r in sizes}
    # Few large shards have higher thresholds than many small ones, and few tasks pass on fewer tables.
    context = docs.sparkSession.sparkContext
    parts = max(context.defaultParallelism, -(-sum(totals.values()) // (shard_bytes * TASK_SHARDS)))
    given = spread(given).coalesce(parts)
    # A task may get somewhat more than a shard; cutting the rest off would make a tiny one.
    limit = shard_bytes * 3 // 2
    found = []
    for lengths in TOGETHER:
        found.append(candidate_bits(given, totals, support, limit, lengths, context.broadcast(list(found))))
    counted = given.mapInArrow(_count(context.broadcast(found), limit * COUNTED_SHARDS), "lang string, size int, phrase string, n long")
    summed = counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return cut_lineage(summed.where((F.col("size") == 0) | (F.col("n") >= support)))


def _parts(counts: DataFrame, name: str, count: str) -> DataFrame:
    """Counts of parts, words once for each salt."""
    salts = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(WORD_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return counts.where("size BETWEEN 1 AND 3").select(
        "lang", F.col("phrase").alias(name), F.explode(salts).alias("salt"), F.col("n").alias(count)
    )


def scores(counts: DataFrame) -> DataFrame:
    """lang, size, phrase, a, l, r, score of all phrases of two words or more."""
    many = counts.where("size >= 2").withColumn("w", F.split("phrase", " ", -1))
    cuts = many.select(
        "lang", "size", "phrase", F.col("n").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    spread_over = F.pmod(F.xxhash64("phrase"), F.lit(WORD_SALTS)).cast("int")
    named = cuts.select(
        "lang", "size", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"),
        F.when(F.col("k") == 1, spread_over).otherwise(0).alias("head_salt"),
        F.when(F.col("size") - F.col("k") == 1, spread_over).otherwise(0).alias("tail_salt"),
    )
    heads = _parts(counts, "head", "l").withColumnRenamed("salt", "head_salt")
    tails = _parts(counts, "tail", "r").withColumnRenamed("salt", "tail_salt")
    both = named.join(heads, ["lang", "head", "head_salt"]).join(tails, ["lang", "tail", "tail_salt"])
    score = F.expr(f"({SCALE} * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    best = both.withColumn("score", score).groupBy("lang", "size", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score")


def outermost(scored: DataFrame) -> DataFrame:
    """``scored`` without phrases that a longer one mostly accounts for."""
    w = F.split("phrase", " ", -1)
    longer = scored.where("size > 2").select("lang", F.col("a").alias("outer"), "size", w.alias("w"))
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda n: F.transform(
            F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")
        ),
    ))
    most = longer.select("lang", "outer", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("outer").alias("outer")
    )
    covered = F.expr(f"100 * CAST(outer AS DECIMAL(20, 0)) >= {INSIDE} * CAST(a AS DECIMAL(20, 0))")
    return scored.join(most, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("outer")


def mine(docs: DataFrame, support: int = 30, top: int = 2000, text: str = "text", lang: str = "lang",
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    counts = phrase_counts(docs, support, text, lang, shard_bytes)
    scored = cut_lineage(scores(counts))
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # A language is ranked in salted parts first, so no task sorts all of it.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = outermost(scored).withColumn("salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    ).where(F.col("rank") <= top).drop("rank", "salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    n = counts.where("size = 0").select("lang", F.col("n").alias("n"))
    return ranked.where(F.col("rank") <= top).join(F.broadcast(n), "lang").select(  # MAX_LANGS rows at most
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
