"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned with follow-the-regularised-leader and an elastic net, so
most of them are exactly zero; a temperature fitted on rows kept aside makes the
probabilities honest. Document frequencies come from all rows that may be
learned from, the weights from a bounded sample of them.

A feature is (share of the text's n-grams) x idf, so the score of a text is one
sum over its n-grams and any length of text is read whole.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0, and so
is every text if there is nothing to learn from; ties go to the language first in
order; rows without a language or an id are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from wordlode.llm import chars
from wordlode.llm.rows import pieces, with_result
from wordlode.llm.sample import in_order, labelled_sample, remainder
from wordlode.session import spread

SIZES = (1, 2, 3)
BITS = 16
# Brings the shares of n-grams to vectors of about unit length.
SCALE = 10.0
UNKNOWN = "und"

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass
class Model:
    languages: list[str]
    buckets: np.ndarray  # those with a weight, sorted
    weights: np.ndarray  # buckets x languages, idf and scale included
    bias: np.ndarray
    temperature: float


def features(texts: list[str]):
    """The type and bucket of each n-gram of the distinct words; type and text of each word."""
    points, inside, begin, types, word_text = chars.word_types(texts)
    found = [chars.ngrams(points, inside, size, BITS) for size in SIZES]
    at = np.concatenate([a for a, _ in found])
    owner = np.searchsorted(begin, at, "right") - 1
    return owner, np.concatenate([b for _, b in found]), types, word_text


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one text and how often each occurs."""
    owner, buckets, types, _ = features([text])
    if not len(types):
        return np.zeros(0, np.int64), np.zeros(0)
    times = chars.sums(types, int(types.max()) + 1)[owner]
    at, place = np.unique(buckets, return_inverse=True)
    return at, chars.sums(place, len(at), times)


def _frequency(texts: list[str]) -> np.ndarray:
    """In how many of some texts each bucket occurs."""
    owner, buckets, types, word_text = features(texts)
    n_types = int(types.max(initial=-1)) + 1
    size = chars.sums(owner, n_types)
    order = np.argsort(owner, kind="stable")
    begin = np.cumsum(size) - size
    seen = np.zeros((len(texts), 1 << BITS), bool)
    # Each distinct word of each text once.
    pairs = np.unique(word_text * max(1, n_types) + types)
    kind = pairs % max(1, n_types)
    many = size[kind]
    shift = np.repeat(begin[kind] - (np.cumsum(many) - many), many)
    at = order[shift + np.arange(int(many.sum()))]
    seen[np.repeat(pairs // max(1, n_types), many), buckets[at]] = True
    return seen.sum(axis=0)


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, total = np.zeros(1 << BITS, np.int64), 0
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in pieces([max(len(t), 1 << 11) for t in texts], 1 << 19):
                found += _frequency(texts[a:b])
                total += b - a
        some = np.flatnonzero(found)
        yield pd.DataFrame({"bucket": [-1, *some.tolist()], "n": [total, *found[some].tolist()]})

    counted = (
        spread(docs).mapInPandas(count, "bucket int, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    frequency = np.zeros(1 << BITS, np.int64)
    real = counted[counted["bucket"] >= 0]
    frequency[real["bucket"].to_numpy()] = real["n"].to_numpy()
    return frequency, int(counted.loc[counted["bucket"] < 0, "n"].sum())


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int,
               dims: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05,
               l2: float = 0.01, epochs: int = 4) -> np.ndarray:
    """Weights dims x classes; an example is (indices, values). The last index is the bias."""
    z, n = np.zeros((dims, n_classes)), np.zeros((dims, n_classes))

    def weights(at):
        zs, ns = z[at], n[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, x = examples[i]
            w = weights(at)
            p = _softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(dims))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, between 1/20 and 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


FEATURES = "doc_id long, label string, buckets array<long>, counts array<double>"
MAX_LANGS = 10_000


def _featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n-grams of whole texts, counted where the texts are; each has ``1 << BITS`` buckets at most."""
    for frame in frames:
        found = [_counts(t) for t in frame["text"]]
        yield pd.DataFrame({
            "doc_id": frame["doc_id"], "label": frame["label"], "buckets": [a for a, _ in found], "counts": [c for _, c in found],
        })


def train(docs: DataFrame, sample_rows: int = 3000) -> Model | None:
    """Learns from ``docs`` (doc_id, text, lang); None if there is nothing to learn from.

    The weights see at most ``sample_rows`` whole texts, shared out evenly among the
    languages; a fifth of them is kept for the temperature.
    """
    known = docs.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder(F.col("doc_id")) != 2)
    )
    languages = sorted(r["lang"] for r in known.select("lang").distinct().limit(MAX_LANGS + 1).collect())
    if len(languages) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not languages:
        return None
    frequency, total = document_frequency(known.select("text"))
    idf = np.log((1 + total) / (1 + frequency)) + 0.1
    taken = labelled_sample(
        known.select("doc_id", "text"), known.select("doc_id", F.col("lang").alias("label")), [],
        -(-sample_rows // len(languages)),
    )
    sample = in_order(taken.select("doc_id", "label", "text").mapInPandas(_featured, FEATURES))
    dims, examples, labels = (1 << BITS) + 1, [], []
    place = {lang: i for i, lang in enumerate(languages)}
    for at, count, lang in zip(sample["buckets"].map(np.asarray), sample["counts"].map(np.asarray), sample["label"]):
        if len(at):
            x = count / count.sum() * idf[at] * SCALE
            examples.append((np.append(at, dims - 1), np.append(x, 1.0)))
            labels.append(place[lang])
    if not examples:
        return None
    labels = np.array(labels)
    aside = np.arange(len(examples)) % 5 == 4
    learn = np.flatnonzero(~aside)
    w = train_ftrl([examples[i] for i in learn], labels[learn], len(languages), dims)
    logits = np.array([x @ w[at] for (at, x), out in zip(examples, aside) if out])
    kept = np.flatnonzero((w[:-1] != 0).any(axis=1))
    return Model(
        languages, kept, (w[kept] * idf[kept, None] * SCALE).astype(np.float32), w[-1],
        fit_temperature(logits.reshape(-1, len(languages)), labels[aside]),
    )


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``row`` and ``result``: the language of each whole text and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: Model | None = shared.value
        if m is not None:
            # One more row for everything without a weight.
            place = np.full(1 << BITS, len(m.buckets))
            place[m.buckets] = np.arange(len(m.buckets))
            weights = np.vstack([m.weights, np.zeros((1, len(m.languages)), np.float32)])
        for batch in batches:
            texts = [t or "" for t in batch]
            names, scores = [], []
            for a, b in pieces([len(t) for t in texts]):
                n = b - a
                total = np.zeros(n)
                if m is not None:
                    owner, buckets, types, word_text = features(texts[a:b])
                    n_types = int(types.max(initial=-1)) + 1
                    at, logits = place[buckets], np.zeros((n, len(m.languages)))
                    total += chars.sums(word_text, n, chars.sums(owner, n_types)[types])
                    for k in range(len(m.languages)):
                        by_type = chars.sums(owner, n_types, weights[at, k])
                        logits[:, k] = chars.sums(word_text, n, by_type[types])
                    p = _softmax((logits / np.maximum(total, 1)[:, None] + m.bias) / m.temperature)
                    best = p.argmax(axis=1)
                for i in range(n):
                    known = total[i] > 0
                    names.append(m.languages[best[i]] if known else UNKNOWN)
                    scores.append(float(p[i, best[i]]) if known else 0.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return with_result(docs, F.pandas_udf(score, RESULT).asNondeterministic(), text)
