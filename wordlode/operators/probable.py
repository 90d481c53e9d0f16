"""Cutting texts into their most probable words.

All dictionary words in a run are arcs of a graph over its places, with the logarithm of
their share of all words as length; a character that is no word is an arc of its own,
less probable than any word. The longest path is found from the left. Stretches
of two or more characters that are no words are then cut by a hidden model of four states,
the character at the beginning, in the middle, at the end of a word, or a word by itself,
whose chances are counted on the dictionary.

Logarithms and sums are rounded to nine digits; of equal paths the one with the longer last
arc counts, of equal states the first of begin, middle, end, single. The dictionary
goes to the tasks in shards as for matching; the chances are one row a character.

Defined cases: empty and NULL words and those without a positive count are left out, repeated
ones add up; a NULL text has no tokens; without a dictionary every run is one stretch, and
without counts of a kind its chances are even.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from wordlode.functions.rows import STRINGS, sliced
from wordlode.operators.match import SHARD_CHARS, Dictionary
from wordlode.session import cut_lineage

DIGITS = 9
# Begin, middle, end, single: which may follow which.
STATES = "bmes"
FOLLOWS = {"b": "me", "m": "me", "e": "bs", "s": "bs"}
# Added to the counts of characters in a state.
ADDED = 0.5
# Different runs whose words a task remembers, and the longest of them.
KEPT_RUNS = 100_000
KEPT_CHARS = 64
# Different characters; code points bound them.
MAX_CHARS = 0x110000


class Chances(NamedTuple):
    """Rounded logarithms: of a first state, of a state after another, of a character in a state, of an unknown one."""

    first: dict[str, float]
    after: dict[tuple[str, str], float]
    char: dict[tuple[str, str], float]
    unknown: dict[str, float]


def log(x: float) -> float:
    return round(math.log(x), DIGITS)


def word_counts(words: DataFrame, column: str = "key", count: str = "n") -> DataFrame:
    """word, n: a dictionary with counts, each word once."""
    return cut_lineage(
        words.select(F.col(column).alias("word"), F.col(count).cast("long").alias("n"))
        .where("word <> '' AND n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    )


def chances(counted: DataFrame) -> Chances:
    """What the words of a dictionary say about the places of characters in words."""
    size = F.length("word")
    spelt = counted.select("n", size.alias("size"), F.posexplode(F.split("word", "")).alias("at", "char")).where("char <> ''")
    state = (
        F.when(F.col("size") == 1, "s").when(F.col("at") == 0, "b")
        .when(F.col("at") == F.col("size") - 1, "e").otherwise("m")
    )
    rows = spelt.groupBy(state.alias("state"), "char").agg(F.sum("n").alias("n")).limit(4 * MAX_CHARS).collect()
    char = {(r["state"], r["char"]): r["n"] for r in rows}
    kinds = {s: sum(n for (t, _), n in char.items() if t == s) for s in STATES}
    alphabet = len({c for _, c in char})
    whole = {s: kinds[s] + ADDED * (alphabet + 1) for s in STATES}
    # Words begin as often as they end; inside, a character goes on or ends the word.
    several, single, inner = kinds["b"], kinds["s"], kinds["m"]
    starts = {"b": (several + 1) / (several + single + 2), "s": (single + 1) / (several + single + 2)}
    words_of_two = counted.where(size == 2).agg(F.sum("n")).first()[0] or 0
    longer = several - words_of_two
    after = {("b", "m"): (longer + 1) / (several + 2), ("b", "e"): (words_of_two + 1) / (several + 2)}
    after |= {("m", "m"): (inner - longer + 1) / (inner + 2), ("m", "e"): (longer + 1) / (inner + 2)}
    after |= {(s, t): p for s in "es" for t, p in starts.items()}
    return Chances(
        {s: log(p) for s, p in starts.items()}, {k: log(p) for k, p in after.items()},
        {k: log((n + ADDED) / whole[k[0]]) for k, n in char.items()},
        {s: log(ADDED / whole[s]) for s in STATES},
    )


def cut_stretch(text: str, known: Chances) -> list[str]:
    """The words of a stretch of characters along the best states, which end a word at its end."""
    def emitted(state, char):
        return known.char.get((state, char), known.unknown[state])

    scores = {s: round(known.first[s] + emitted(s, text[0]), DIGITS) for s in known.first}
    back = []
    for char in text[1:]:
        now, origin = {}, {}
        for state in STATES:
            # The first of equal ones: ``max`` keeps it, as states are tried in their order.
            ways = [(round(scores[s] + known.after[s, state], DIGITS), s) for s in STATES if s in scores and state in FOLLOWS[s]]
            if ways:
                score, origin[state] = max(ways, key=lambda w: w[0])
                now[state] = round(score + emitted(state, char), DIGITS)
        scores = now
        back.append(origin)
    state = max((s for s in "es" if s in scores), key=lambda s: scores[s])
    states = [state]
    for origin in reversed(back):
        states.append(origin[states[-1]])
    states.reverse()
    words, begin = [], 0
    for i, state in enumerate(states):
        if state in "es":
            words.append(text[begin : i + 1])
            begin = i + 1
    return words


def best_path(run: str, arcs: list[list[tuple[int, float]]], unknown: float) -> list[tuple[str, bool]]:
    """The most probable pieces of a run, and whether each is a word.

    ``arcs`` has length and weight of the words that end at each place.
    """
    best, taken = [0.0], [(0, True)]
    for end in range(1, len(run) + 1):
        ways = [(round(best[end - size] + weight, DIGITS), size, True) for size, weight in arcs[end]]
        if not any(size == 1 for _, size, _ in ways):
            ways.append((round(best[end - 1] + unknown, DIGITS), 1, False))
        score, size, known = max(ways)
        best.append(score)
        taken.append((size, known))
    pieces, end = [], len(run)
    while end:
        size, known = taken[end]
        pieces.append((run[end - size : end], known))
        end -= size
    return pieces[::-1]


def _arcs(dictionary: Dictionary, runs: list[str]) -> list[list[list[tuple[int, float]]]]:
    """For each run, length and weight of the words that end at each of its places; each shard is met once."""
    found = [[[] for _ in range(len(run) + 1)] for run in runs]
    for tree in dictionary.automata():
        for arcs, run in zip(found, runs):
            for last, (term, weight) in tree.iter(run) if run else ():
                arcs[last + 1].append((len(term), weight))
    return found


def _cut(run: str, arcs, unknown: float, known: Chances) -> list[str]:
    tokens, loose = [], ""
    for piece, is_word in [*best_path(run, arcs, unknown), ("", True)]:
        if not is_word:
            loose += piece
            continue
        if loose:
            tokens.extend(cut_stretch(loose, known) if len(loose) > 1 else [loose])
            loose = ""
        if piece:
            tokens.append(piece)
    return tokens


def segment_probable(
    df: DataFrame, keys: list, text: Column, words: DataFrame, separator: str, column: str = "key", count: str = "n",
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """Cut texts into their most probable words: ``keys`` and an array ``tokens``.

    ``words`` has the words and their counts. Runs between separators are cut on their own; the
    tokens of a run join back to it. A run that comes again is cut once in a slice, and most are
    remembered beyond it.
    """
    counted = word_counts(words, column, count)
    total = counted.agg(F.sum("n")).first()[0] or 0
    weighted = counted.select("word", F.round(F.ln(F.col("n") / F.lit(float(total or 1))), DIGITS).alias("weight"))
    dictionary = Dictionary(weighted, "word", shard_chars, weight="weight")
    # Less probable than a word met once.
    unknown = log(0.5 / (total or 1))
    held = df.sparkSession.sparkContext.broadcast(chances(counted))  # a few numbers for each character

    kept: dict[str, list[str]] = {}  # of a task, as each gets a copy

    def cut(texts):
        # Runs of all texts of the slice, so that each automaton is met once.
        runs = {run for text in texts for run in text}
        found = {run: kept[run] for run in runs if run in kept}
        new = [run for run in runs if run not in found]
        found.update((run, _cut(run, arcs, unknown, held.value)) for run, arcs in zip(new, _arcs(dictionary, new)))
        for run in new:
            if len(run) <= KEPT_CHARS:
                if len(kept) >= KEPT_RUNS:
                    kept.clear()
                kept[run] = found[run]
        return [[t for run in text for t in found[run]] for text in texts]

    runs = F.split(F.coalesce(text, F.lit("")), separator)
    tokens = sliced(cut, "array<string>", STRINGS, dictionary.slice_bytes())(runs)
    return df.select(*keys, tokens.alias("tokens"))
