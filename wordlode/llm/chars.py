"""Whole batches of texts as arrays of code points: words, character n-grams, sums by text."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd multipliers of the hashes.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FINISH = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=None)
def table(kind: str) -> np.ndarray:
    """For every code point: is it of this kind (a method of ``str``)."""
    test = getattr(str, kind)
    return np.fromiter((test(chr(c)) for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=None)
def word_table(extra: str) -> np.ndarray:
    """Letters, and digits and the characters of ``extra`` if there are any."""
    if not extra:
        return table("isalpha")
    found = table("isalnum").copy()
    found[[ord(c) for c in extra]] = True
    return found


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in one array, and the index of the text of each."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return joined, np.repeat(np.arange(len(texts)), lengths)


def framed(texts: list[str], extra: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words: code points (blank outside words), is-in-word, word starts, text of each word."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    points = np.frombuffer(
        (" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), "<u4"
    )
    inside = word_table(extra)[points]
    edge = np.flatnonzero(inside[1:] > inside[:-1]) + 1
    return np.where(inside, points, np.uint32(32)), inside, edge, np.searchsorted(np.cumsum(lengths), edge - 1, "right")


def word_types(texts: list[str], extra: str = ""):
    """The distinct words of some texts, so that each is looked at once.

    Returns the framed code points of one copy of each distinct word and their
    is-in-word marks, the first index of each of these words, and for every word
    of the texts its type and its text.
    """
    points, inside, starts, word_text = framed(texts, extra)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return points[:0], inside[:0], none, none, none
    ends = np.flatnonzero(inside[:-1] > inside[1:]) + 1
    _, one, types = np.unique(word_hashes(points, starts, ends), return_index=True, return_inverse=True)
    # Copies of [blank, word, blank] behind each other.
    first, size = starts[one] - 1, ends[one] - starts[one] + 2
    begin = np.cumsum(size) - size
    at = np.repeat(first - begin, size) + np.arange(int(size.sum()))
    return points[at], inside[at], begin, types, word_text


def ngrams(points: np.ndarray, inside: np.ndarray, size: int, bits: int):
    """Positions and hash buckets of the n-grams that lie in one framed word.

    A blank may only be the first or the last character.
    """
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = np.full(n, size, np.uint64)
    for k in range(size):
        hashed = hashed * _STEP + points[k : k + n]
    hashed ^= hashed >> np.uint64(29)
    hashed *= _FINISH
    if size == 1:
        valid = inside[:n]
    elif size == 2:
        valid = inside[:n] | inside[1:]
    else:
        valid = inside[1 : 1 + n].copy()
        for k in range(2, size - 1):
            valid &= inside[k : k + n]
    at = np.flatnonzero(valid)
    return at, (hashed[at] >> np.uint64(64 - bits)).astype(np.int64)


def _factors(n: int) -> np.ndarray:
    """An odd factor for each place in a word, the same in every process."""
    mixed = np.arange(1, n + 1, dtype=np.uint64) * _STEP
    for _ in range(2):
        mixed ^= mixed >> np.uint64(32)
        mixed *= _FINISH
    return mixed ^ (mixed >> np.uint64(32)) | np.uint64(1)


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word [start, end)."""
    size = ends - starts
    begin = np.cumsum(size) - size
    offset = np.arange(int(size.sum()), dtype=np.int64)
    letters = points[offset + np.repeat(starts - begin, size)].astype(np.uint64)
    offset -= np.repeat(begin, size)
    letters += np.uint64(1)
    letters *= _FINISH
    letters ^= letters >> np.uint64(31)
    letters *= _factors(int(size.max(initial=0)))[offset]
    return np.add.reduceat(letters, begin) * _STEP if len(starts) else np.zeros(0, np.uint64)


def sums(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum (or count) by row number."""
    return np.bincount(rows, weights, n)
