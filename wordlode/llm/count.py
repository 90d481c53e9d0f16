"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton gives every piece of the vocabulary that ends at a place;
dynamic programming keeps, for each place, the best score and the number of pieces
that lead there, and nothing to walk back along.

The vocabulary and scores are those of a public ``sentencepiece`` file, read as a unigram
model under the rules of the ``tokenizers`` library: pieces ending at one place are
tried from the longest on and replace another only by a greater score, so ties go to
the longest piece; a sign that is no piece by itself may also be unknown, at the
lowest score less ten, tried last, and then counts its UTF-8 bytes. A text gets one
blank in front, blanks become the mark U+2581, and control and byte pieces match nothing.

No piece has a mark behind another sign, so the best path of a text is that of
its words, and words seen before are not searched again.

Defined cases: NULL and empty texts have no tokens; rows repeated count alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wordlode.llm.rows import with_result

MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Words remembered in a worker, and the longest of them.
KEPT, KEPT_CHARS = 300_000, 64


class Counter(dict):
    """Number of tokens of a word; words not seen yet are searched."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.whole = any(MARK in piece.lstrip(MARK) for piece, _ in pieces)

    def search(self, word: str) -> int:
        """Pieces on the best path over ``word``."""
        size = len(word)
        best: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)
        single = [False] * size
        done = 0

        def close(end: int) -> None:
            # The unknown sign is the shortest way to a place and so is tried last.
            if not single[end - 1]:
                score = best[end - 1] + self.unknown
                if best[end] is None or score > best[end]:
                    best[end] = score
                    count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))

        for last, (length, gain) in self.automaton.iter(word):
            end = last + 1
            while done < end - 1:
                done += 1
                close(done)
            if length == 1:
                single[last] = True
            start = end - length
            score = best[start] + gain
            if best[end] is None or score > best[end]:
                best[end] = score
                count[end] = count[start] + 1
        while done < size:
            done += 1
            close(done)
        return count[size]

    def __missing__(self, word: str) -> int:
        n = self.search(MARK + word)
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.whole:
            return self.search(MARK + text.replace(" ", MARK))
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            words = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
            return sum(self[w[1:]] for w in words)
        return sum(map(self.__getitem__, text.split(" ")))


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a ``sentencepiece`` file with their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per worker process."""
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` and ``result``: the number of tokens of each whole text."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = counter(path)
        for batch in batches:
            yield pd.Series([known.count(t) for t in batch], dtype="int64")

    return with_result(docs, F.pandas_udf(run, "long").asNondeterministic(), text)
