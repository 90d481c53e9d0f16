"""All pairs of similar sentences, without comparing all sentences.

Two sentences are as similar as the number of different words they share over the summed
logarithms of their lengths. A sentence of n words thus needs a certain overlap with any partner
to reach a floor. With the words of a sentence in order of their rarity, two sentences that
share so many words share one already among the first of each: as many as can be left
out, and one more. Only sentences that meet in such a word, and whose sizes allow the
overlap, are compared.

Sentences of a short key, such as a document, are brought together once and compared in a task, by products
of the matrix of sentences and words; only long keys, and sentences of no key, go the way of rare words.
Both ways find all pairs.

Sentences with the same different words and the same length are one class: it is compared
once and carries its number of members.

Defined cases: NULL tokens and arrays count as no words; sentences without words, and pairs
whose lengths are both one, are similar to nothing; a class of several sentences is a
pair of itself.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordlode.functions.rows import explode_rows, sliced
from wordlode.functions.text import shared_over_length
from wordlode.session import cut_lineage

DIGITS = 9

# Words of a key up to which one task compares its sentences, and numbers of a matrix there.
KEY_WORDS = 30_000
CELLS = 4_000_000

FIELDS = ("a", "b", "copies_a", "copies_b", "shared", "n_a", "n_b")


def _needed(n: Column, floor: float) -> Column:
    """Words that a sentence of ``n`` words shares at least with a partner above the floor.

    The partner has one word or more; then it has as many as are shared, which raises the number again.
    A little is taken off, so that rounding takes no pair away.
    """
    once = F.greatest(F.ceil(floor * F.ln(n.cast("double")) - 1e-6), F.lit(1))
    return F.greatest(F.ceil(floor * (F.ln(n.cast("double")) + F.ln(once.cast("double"))) - 1e-6), F.lit(1)).cast("int")


def _present(sentences: DataFrame, tokens: str, id: str, keys: tuple[str, ...]) -> DataFrame:
    present = F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")), lambda t: t.isNotNull())
    return sentences.select(*keys, F.col(id).alias("class"), present.alias("t")).where(F.size("t") > 0)


def sentence_classes(sentences: DataFrame, tokens: str, id: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, class (its smallest id), n (words), words (different ones, sorted), copies."""
    return _present(sentences, tokens, id, keys).select(
        *keys, "class", F.size("t").alias("n"), F.array_sort(F.array_distinct("t")).alias("words")
    ).groupBy(*keys, "n", "words").agg(F.min("class").alias("class"), F.count("*").alias("copies"))


def _compared(sentences: list[list[str]], floor: float) -> list[tuple]:
    """FIELDS of the classes that may reach ``floor``; a class goes by the place of its first sentence."""
    classes, place = {}, {}
    for i, t in enumerate(sentences):
        classes.setdefault((len(t), frozenset(t)), []).append(i)
    found = [(m[0], m[0], len(m), len(m), len(words), n, n) for (n, words), m in classes.items() if len(m) > 1]
    first, copies = [m[0] for m in classes.values()], [len(m) for m in classes.values()]
    length = [n for n, _ in classes]
    at = np.array([place.setdefault(w, len(place)) for _, words in classes for w in words])
    who = np.repeat(np.arange(len(classes)), [len(words) for _, words in classes])
    # A word of one class only is shared by none.
    common = np.bincount(at) > 1
    who, at = who[common[at]], (np.cumsum(common) - 1)[at[common[at]]]
    k, n_words, logs = len(classes), int(common.sum()), np.log(length)
    step = max(1, CELLS // k)
    for top in range(0, k if n_words else 0, step):
        shared = np.zeros((min(step, k - top), k - top), np.float32)
        for left in range(0, n_words, step):
            here = (at >= left) & (at < left + step) & (who >= top)
            held = np.zeros((k - top, min(step, n_words - left)), np.float32)
            held[who[here] - top, at[here] - left] = 1
            shared += held[:len(shared)] @ held.T
        enough = floor * (logs[top : top + len(shared), None] + logs[None, top:]) - 1e-6
        for a, b in zip(*np.nonzero(np.triu((shared > 0) & (shared >= enough), 1))):
            i, j = a + top, b + top
            found.append((first[i], first[j], copies[i], copies[j], int(shared[a, b]), length[i], length[j]))
    return found


def _of_short_keys(rows: DataFrame, floor: float, keys: tuple[str, ...]) -> DataFrame:
    """keys and FIELDS of all classes that may reach ``floor``, a key's sentences (class, t) in one row."""
    arrow = pa.list_(pa.struct([(name, pa.int32()) for name in FIELDS]))

    def compare(texts):
        return [[dict(zip(FIELDS, map(int, row))) for row in _compared(sentences, floor)] for sentences in texts]

    kind = f"array<struct<{','.join(f'{name}:int' for name in FIELDS)}>>"
    # In the order of ids, so that the first sentence of a class is the smallest.
    held = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("class").isNull().alias("none"), "class", "t"))).alias("s")
    )
    met = held.select(*keys, F.col("s.class").alias("ids"), sliced(compare, kind, arrow)(F.col("s.t")).alias("met"))
    named = F.transform("met", lambda p: F.struct(
        F.get("ids", p.a).alias("a"), F.get("ids", p.b).alias("b"), (p.a == p.b).alias("same"),
        *[p[name].alias(name) for name in FIELDS[2:]],
    ))
    pairs = explode_rows(met, named, "p", *keys).where("p.same OR p.a < p.b")
    counted = [F.col(f"p.{name}").cast("long").alias(name) for name in ("copies_a", "copies_b")]
    return pairs.select(*keys, "p.a", "p.b", *counted, "p.shared", "p.n_a", "p.n_b")


def _by_rare_words(classes: DataFrame, floor: float, keys: tuple[str, ...]) -> DataFrame:
    """keys and FIELDS of all classes that meet in a rare word and may reach ``floor``."""
    words = classes.select(*keys, "class", "n", F.size("words").alias("d"), F.explode("words").alias("word"))
    seen = words.groupBy(*keys, "word").agg(F.count("*").alias("seen"))
    # A word in one class only leads nowhere, but takes its place in the order.
    ordered = words.join(seen, [*keys, "word"]).groupBy(*keys, "class", "n", "d").agg(
        F.array_sort(F.collect_list(F.struct("seen", "word"))).alias("by_rarity")
    )
    first = F.slice("by_rarity", F.lit(1), F.greatest(F.col("d") - _needed(F.col("n"), floor) + 1, F.lit(0)))
    index = cut_lineage(
        ordered.select(*keys, "class", "n", "d", F.explode(first).alias("w"))
        .where("w.seen > 1").select(*keys, F.col("w.word").alias("word"), "class", "n", "d")
    )
    left = index.select(*keys, "word", F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("d").alias("d_a"))
    right = index.select(*keys, "word", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("d").alias("d_b"))
    overlap = floor * (F.ln(F.col("n_a").cast("double")) + F.ln(F.col("n_b").cast("double"))) - 1e-6
    met = left.join(right, [*keys, "word"]).where((F.col("a") < F.col("b")) & (F.least("d_a", "d_b") >= overlap))
    pairs = met.select(*keys, "a", "b").distinct()
    side = {
        end: classes.select(
            *keys, F.col("class").alias(end), F.col("n").alias(f"n_{end}"), F.col("words").alias(f"words_{end}"),
            F.col("copies").alias(f"copies_{end}"),
        ) for end in ("a", "b")
    }
    both = pairs.join(side["a"], [*keys, "a"]).join(side["b"], [*keys, "b"]).select(
        *keys, "a", "b", "copies_a", "copies_b", F.size(F.array_intersect("words_a", "words_b")).alias("shared"), "n_a", "n_b"
    )
    same = classes.where("copies > 1").select(
        *keys, F.col("class").alias("a"), F.col("class").alias("b"), F.col("copies").alias("copies_a"),
        F.col("copies").alias("copies_b"), F.size("words").alias("shared"), F.col("n").alias("n_a"), F.col("n").alias("n_b"),
    )
    return both.unionByName(same)


def similar_pairs(
    sentences: DataFrame, tokens: str, id: str, floor: float, keys: tuple[str, ...] = (), key_words: int = KEY_WORDS
) -> DataFrame:
    """keys, a, b, copies_a, copies_b, shared, similarity of all classes at ``floor`` or above.

    ``a`` and ``b`` are the smallest ids of two classes, a < b, or of one class of several sentences.
    Sentences meet within ``keys`` only.
    """
    if floor <= 0:
        raise ValueError("a floor of 0 or below asks for all pairs")
    rows = cut_lineage(_present(sentences, tokens, id, keys))
    found = None
    if keys:
        sizes = rows.groupBy(*keys).agg(F.sum(F.size("t")).alias("_size"))
        long = cut_lineage(sizes.where(F.col("_size") > key_words).select(*keys))
        nulls = reduce(or_, [F.col(k).isNull() for k in keys])
        found = _of_short_keys(rows.where(~nulls).join(long, list(keys), "left_anti"), floor, keys)
        # A NULL key joins nothing.
        rows = cut_lineage(rows.where(~nulls).join(long, list(keys), "left_semi").unionByName(rows.where(nulls)))
    if found is None or not rows.isEmpty():
        classes = cut_lineage(sentence_classes(rows, "t", "class", keys))
        rest = _by_rare_words(classes, floor, keys)
        found = rest if found is None else found.unionByName(rest)
    scored = found.withColumn(
        "similarity", F.round(shared_over_length(F.col("shared"), F.col("n_a"), F.col("n_b")), DIGITS)
    )
    return scored.where(F.col("similarity") >= floor).drop("n_a", "n_b")
