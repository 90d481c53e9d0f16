"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text is a sparse vector x: its distinct hashed words, one bucket of each
structure statistic and of the recorded number of characters. The score is

    w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)

so all pairwise interactions cost one pass over the non-zero entries.

Defined cases: NULL and empty texts have the statistics of an empty text and no words;
a NULL or missing number of characters is a bucket of its own; with labels of one class only
every score is 1 or 0 as they say, and one half without any label; rows repeated score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wordlode.llm import chars
from wordlode.llm.rows import pieces, with_result
from wordlode.llm.sample import class_shares, in_order, labelled_sample

WORD_BITS = 14
WORDS = 1 << WORD_BITS
BINS = 12
RANK = 6
SYMBOLS = "#*$%&|<>"
STATISTICS = (
    "words", "letters", "capitals", "digits", "symbols", "bars", "marks", "ends", "lines",
    "word_length", "distinct_words", "repeated_lines", "recorded_chars",
)


@dataclass
class Model:
    cuts: np.ndarray  # statistics x (BINS - 1)
    w0: float
    w: np.ndarray
    v: np.ndarray


def _kinds() -> dict[str, np.ndarray]:
    def marked(signs: str) -> np.ndarray:
        found = np.zeros(0x110000, bool)
        found[[ord(c) for c in signs]] = True
        return found

    return {
        "letters": chars.table("isalpha"), "capitals": chars.table("isupper"),
        "digits": chars.table("isdigit"), "spaces": chars.table("isspace"),
        "symbols": marked(SYMBOLS), "bars": marked("|"), "marks": marked("!?"),
        "ends": marked(".;:,"), "lines": marked("\n"),
    }


def features(texts: list[str], recorded: np.ndarray):
    """Statistics per text, and text and bucket of each distinct hashed word."""
    n = len(texts)
    points, rows = chars.codes([t + " " for t in texts])
    count = {name: chars.sums(rows[kind[points]], n) for name, kind in _kinds().items()}
    blank = chars.table("isspace")[points]
    tokens = chars.sums(rows[1:][blank[1:] > blank[:-1]], n) + 0.0
    solid = np.maximum(chars.sums(rows[~blank], n), 1)
    per_token = np.maximum(tokens, 1)

    letters, inside, starts, word_rows = chars.framed(texts)
    ends = np.flatnonzero(inside[:-1] > inside[1:]) + 1
    hashed = chars.word_hashes(letters, starts, ends)
    keys = (word_rows << WORD_BITS) | (hashed >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    distinct = np.unique(keys)
    word_text, bucket = distinct >> WORD_BITS, distinct & (WORDS - 1)
    words = np.maximum(chars.sums(word_rows, n), 1)

    repeated = np.zeros(n)
    for i, text in enumerate(texts):
        lines = [line for line in text.split("\n") if line]
        repeated[i] = (len(lines) - len(set(lines))) / max(1, len(lines))
    statistics = np.stack([
        np.log1p(tokens), count["letters"] / solid, count["capitals"] / np.maximum(count["letters"], 1),
        count["digits"] / solid, count["symbols"] / per_token, count["bars"] / per_token,
        count["marks"] / per_token, count["ends"] / per_token, count["lines"] / per_token,
        solid / per_token, chars.sums(word_text, n) / np.sqrt(words), repeated,
        np.log1p(recorded),
    ], 1)
    return statistics, word_text, bucket


def _entries(statistics, word_text, bucket, cuts):
    """Text, feature and value of all non-zero entries, in the order of the texts."""
    n, k = statistics.shape
    bins = np.stack([np.searchsorted(cuts[j], statistics[:, j], side="right") for j in range(k)], 1)
    bins[np.isnan(statistics)] = BINS
    index = WORDS + np.arange(k) * (BINS + 1) + bins
    # The words of a text weigh as much together as one statistic.
    share = 1 / np.sqrt(np.maximum(chars.sums(word_text, n), 1))
    rows = np.concatenate([np.repeat(np.arange(n), k), word_text])
    feature = np.concatenate([index.ravel(), bucket])
    value = np.concatenate([np.ones(n * k), share[word_text]])
    return rows, feature, value


def _margins(n, rows, feature, value, w0, w, v):
    """The factorisation machine by the sum-of-squares identity; also the sums v x per text."""
    linear = chars.sums(rows, n, w[feature] * value)
    sums = np.stack([chars.sums(rows, n, v[feature, f] * value) for f in range(RANK)], 1)
    squares = sum(chars.sums(rows, n, (v[feature, f] * value) ** 2) for f in range(RANK))
    return w0 + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def _fit(n, rows, feature, value, y, weight, steps=150, rate=0.03, decay=2e-4):
    """Full-batch Adam on the weighted log loss."""
    used, local = np.unique(feature, return_inverse=True)
    random = np.random.default_rng(0)
    w0, w = np.zeros(1), np.zeros(len(used))
    v = random.normal(0, 0.05, (len(used), RANK))
    state = [(np.zeros_like(a), np.zeros_like(a)) for a in (w0, w, v)]
    for step in range(1, steps + 1):
        margin, sums = _margins(n, rows, local, value, w0[0], w, v)
        g = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        at = g[rows] * value
        own = chars.sums(local, len(used), at * value)
        g_v = np.stack([
            chars.sums(local, len(used), at * sums[rows, f]) - v[:, f] * own for f in range(RANK)
        ], 1)
        grads = (np.array([g.sum()]), chars.sums(local, len(used), at) + decay * w, g_v + decay * v)
        for a, grad, (m, s) in zip((w0, w, v), grads, state):
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-9)
    size = WORDS + len(STATISTICS) * (BINS + 1)
    full_w, full_v = np.zeros(size), np.zeros((size, RANK))
    full_w[used], full_v[used] = w, v
    return float(w0[0]), full_w, full_v


def _batches(texts: list[str], recorded: np.ndarray):
    for a, b in pieces([len(t) for t in texts]):
        yield a, b, features(texts[a:b], recorded[a:b])


FEATURES = "doc_id long, label long, statistics array<double>, words array<long>"


def _featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features of whole texts, found where the texts are: what reaches the driver does not grow with their length."""
    for frame in frames:
        for a, b, (statistics, word_text, bucket) in _batches(
            frame["text"].tolist(), frame["recorded"].to_numpy(dtype=float, na_value=np.nan)
        ):
            at = np.searchsorted(word_text, np.arange(b - a + 1))
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].iloc[a:b], "label": frame["label"].iloc[a:b], "statistics": list(statistics),
                "words": [bucket[x:y] for x, y in zip(at, at[1:])],
            })


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2500) -> Model | float:
    """Learns from at most ``per_class`` whole texts of each label.

    ``docs`` has doc_id, text and recorded (characters), ``labels`` doc_id and label.
    In the loss the labels weigh as much as they do among all rows. Without both labels, the
    score of every text.
    """
    taken = labelled_sample(docs, labels, ["recorded"], per_class)
    sample = in_order(taken.select("doc_id", "label", "text", "recorded").mapInPandas(_featured, FEATURES))
    y = sample["label"].to_numpy(float) if len(sample) else np.zeros(0)
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.5
    statistics = np.stack(sample["statistics"].to_numpy()).astype(float)
    bucket = np.concatenate(sample["words"].to_numpy()).astype(np.int64)
    word_text = np.repeat(np.arange(len(y)), [len(w) for w in sample["words"]])
    levels = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = np.stack([
        np.quantile(c[~np.isnan(c)], levels) if (~np.isnan(c)).any() else np.zeros(BINS - 1)
        for c in statistics.T
    ])
    rows, feature, value = _entries(statistics, word_text, bucket, cuts)
    share = class_shares(labels)
    weight = np.array([share[c] for c in y]) / np.array([(y == c).sum() for c in y])
    w0, w, v = _fit(len(y), rows, feature, value, y, weight)
    return Model(cuts, w0, w.astype(np.float32), v.astype(np.float32))


def score(docs: DataFrame, model: Model | float, text: str = "text", recorded: str = "n_chars") -> DataFrame:
    """``row`` and ``result``: how likely each whole text is of good quality, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m: Model | float = shared.value
        for batch, lengths in batches:
            texts = [t or "" for t in batch]
            known = lengths.to_numpy(dtype=float, na_value=np.nan)
            out = np.full(len(texts), m if isinstance(m, float) else 0.0)
            if isinstance(m, Model):
                for a, b, found in _batches(texts, known):
                    entries = _entries(*found, m.cuts)
                    margin, _ = _margins(b - a, *entries, m.w0, m.w, m.v)
                    out[a:b] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pd.Series(out)

    return with_result(docs, F.pandas_udf(run, "double").asNondeterministic(), text, recorded)
