"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its character n-grams, a window of words
is the mean of its words, and a softmax over two classes reads the window. Unseen
misspellings share n-grams with words that were seen. A document is as toxic as
its worst window: an average over the whole of a long text would drown one insult.

Embeddings and softmax are trained together. In the first round every window
carries the label of its document; in the later rounds the worst windows of each
document stand for it. A last logistic fit turns the worst window into the score.

As everything up to the worst window is linear, an n-gram counts by one number, its
embedding times the difference of the softmax weights.

Defined cases: NULL, empty and word-less texts get the score of a document without any
evidence; with labels of one class only every score is 1 or 0 as they say, and 0 without any
label. A sampled text above ``max_chars`` characters is learned from by eight stretches of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wordlode.llm import chars
from wordlode.llm.rows import pieces, with_result
from wordlode.llm.sample import class_shares, excerpt, in_order, labelled_sample

SIZES = (3, 4, 5)
BITS = 20
DIM = 6
WINDOW = 4
# Signs that stand for letters inside words.
INSIDE = "@$*"


@dataclass
class Model:
    effect: np.ndarray  # per n-gram bucket
    bias: float
    slope: float
    shift: float


def _words(texts: list[str]):
    """The type and bucket of each n-gram of the distinct words; type and text of each word."""
    points, inside, begin, types, word_text = chars.word_types(texts, INSIDE)
    found = [chars.ngrams(points, inside, size, BITS) for size in SIZES]
    at = np.concatenate([a for a, _ in found])
    owner = np.searchsorted(begin, at, "right") - 1
    return owner, np.concatenate([b for _, b in found]), types, word_text


def _windows(word_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last word of the window that starts at each word, within its text."""
    n = len(word_text)
    first = np.arange(n)
    end = np.searchsorted(word_text, word_text, side="right")
    return first, np.minimum(first + WINDOW, end)


def _word_values(words: np.ndarray, buckets: np.ndarray, effect: np.ndarray, n: int) -> np.ndarray:
    """Mean effect of each word's n-grams; words too short for one count 0."""
    return chars.sums(words, n, effect[buckets]) / np.maximum(chars.sums(words, n), 1)


def _worst(texts: list[str], effect: np.ndarray, bias: float) -> np.ndarray:
    """The largest margin of any window of each text; minus infinity without words."""
    owner, buckets, types, word_text = _words(texts)
    out = np.full(len(texts), -np.inf)
    if len(word_text):
        values = _word_values(owner, buckets, effect, types.max() + 1)[types]
        run = np.concatenate([[0.0], np.cumsum(values)])
        first, last = _windows(word_text)
        margins = (run[last] - run[first]) / WINDOW + bias
        starts = np.flatnonzero(np.diff(word_text, prepend=-1))
        out[word_text[starts]] = np.maximum.reduceat(margins, starts)
    return out


def _fit_windows(bag, n_types, types, first, last, target, weight, embed, soft, steps, rate):
    """Full-batch Adam on the weighted log loss of windows; changes embed and soft in place.

    ``bag`` holds the word type and the n-gram of each entry, ``types`` the type of each word.
    """
    owner, gram = bag
    count = np.maximum(chars.sums(owner, n_types), 1)
    state = [(np.zeros_like(a), np.zeros_like(a)) for a in (embed, soft)]
    for step in range(1, steps + 1):
        # Means over n-grams, then over the words of a window by running sums.
        vector = np.stack([chars.sums(owner, n_types, embed[gram, d]) / count for d in range(DIM)], 1)
        run = np.vstack([np.zeros(DIM), np.cumsum(vector[types], axis=0)])
        x = (run[last] - run[first]) / WINDOW
        logits = x @ soft[:DIM] + soft[DIM]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(target)), target] -= 1
        p *= weight[:, None]
        g_soft = np.vstack([x.T @ p, p.sum(axis=0)]) + 1e-4 * soft
        g_x = p @ soft[:DIM].T / WINDOW
        g_embed = np.empty_like(embed)
        for d in range(DIM):
            # Each word gets the gradients of all windows over it.
            over = chars.sums(first, len(types) + 1, g_x[:, d]) - chars.sums(last, len(types) + 1, g_x[:, d])
            g_type = chars.sums(types, n_types, np.cumsum(over)[:-1]) / count
            g_embed[:, d] = chars.sums(gram, len(embed), g_type[owner])
        g_embed += 1e-6 * embed
        for value, g, (m, v) in zip((embed, soft), (g_embed, g_soft), state):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit with a little shrinkage, by Newton steps."""
    design = np.stack([x, np.ones_like(x)], 1)
    shrink = np.array([1e-3, 1e-6])
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(shrink)
        b = b - np.clip(np.linalg.solve(h, design.T @ (weight * (p - y)) + shrink * b), -2, 2)
    return float(b[0]), float(b[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1200, max_chars: int = 8000,
          rounds: int = 3, steps: int = 20) -> Model | float:
    """Learns from at most ``per_class`` texts of each label, of longer ones from ``max_chars`` characters.

    ``docs`` has doc_id and text, ``labels`` doc_id and label (1 is toxic). A fourth of
    the sample is kept aside to turn margins into probabilities, with the labels
    in the shares that they have among all rows. Without both labels, the score of every text.
    """
    taken = labelled_sample(docs, labels, [], per_class)
    sample = in_order(taken.withColumn("text", excerpt(F.col("text"), max_chars)))
    y = sample["label"].to_numpy(np.int64) if len(sample) else np.zeros(0, np.int64)
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.0
    texts = sample["text"].tolist()
    aside = np.arange(len(texts)) % 4 == 3
    learn = np.flatnonzero(~aside)
    embed, used, soft = _train_windows([texts[i] for i in learn], y[learn], rounds, steps)
    effect = np.zeros(1 << BITS)
    effect[used] = embed @ (soft[:DIM, 1] - soft[:DIM, 0])
    bias = float(soft[DIM, 1] - soft[DIM, 0])
    share = class_shares(labels)
    fit = np.flatnonzero(aside) if len(set(y[aside].tolist())) == 2 else np.arange(len(texts))
    worst = _worst([texts[i] for i in fit], effect, bias)
    seen = np.isfinite(worst)
    known = y[fit][seen]
    weight = np.array([share[c] for c in known]) / np.bincount(known, minlength=2)[known] * len(known)
    return Model(effect.astype(np.float32), bias, *_logistic(worst[seen], known.astype(float), weight))


def _train_windows(texts, y, rounds, steps):
    """Embeddings of the n-grams seen, their buckets, and the softmax weights."""
    random = np.random.default_rng(0)
    soft = random.normal(0, 0.1, (DIM + 1, 2))
    soft[DIM] = 0
    owner, buckets, types, word_text = _words(texts)
    n_words, n_types = len(word_text), int(types.max(initial=-1)) + 1
    used, gram = np.unique(buckets, return_inverse=True)
    bag = (owner, gram)
    embed = random.normal(0, 0.1, (len(used), DIM))
    if not n_words:
        return embed, used, soft
    first, last = _windows(word_text)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    chosen = np.arange(n_words)
    for _ in range(rounds):
        own = word_text[chosen]
        weight = share[own] / np.bincount(own, minlength=len(texts))[own]
        _fit_windows(bag, n_types, types, first[chosen], last[chosen], y[own], weight, embed, soft, steps, 0.05)
        # From now on the worst windows stand for a text.
        effect = embed @ (soft[:DIM, 1] - soft[:DIM, 0])
        value = _word_values(*bag, effect, n_types)[types]
        run = np.concatenate([[0.0], np.cumsum(value)])
        order = np.lexsort((run[first] - run[last], word_text))
        starts = np.flatnonzero(np.diff(word_text[order], prepend=-1))
        rank = np.arange(n_words) - np.repeat(starts, np.diff(np.append(starts, n_words)))
        chosen = order[rank < np.where(y[word_text[order]] == 1, WINDOW, 4 * WINDOW)]
    return embed, used, soft


def score(docs: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """``row`` and ``result``: how likely each whole text is toxic, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m: Model | float = shared.value
        for batch in batches:
            texts = [t or "" for t in batch]
            out = np.full(len(texts), m if isinstance(m, float) else 0.0)
            if isinstance(m, Model):
                for a, b in pieces([len(t) for t in texts]):
                    worst = _worst(texts[a:b], m.effect, m.bias)
                    worst = np.where(np.isfinite(worst), worst, m.bias)
                    out[a:b] = 1 / (1 + np.exp(-np.clip(m.slope * worst + m.shift, -30, 30)))
            yield pd.Series(out)

    return with_result(docs, F.pandas_udf(run, "double").asNondeterministic(), text)
