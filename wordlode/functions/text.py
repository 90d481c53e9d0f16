"""Column functions on text: cleaning, sentences, words, word rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# What counts as blank at the ends of a string: every Unicode white space.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Every character GB2312 can encode, ASCII included.
GB2312 = "".join(
    chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000
    and chr(c).encode("gb2312", "ignore")
)


def valid_text(col: Column) -> Column:
    """Bytes as text; what is not UTF-8 is dropped, a written U+FFFD is kept."""
    mark, noncharacter = F.lit("\ufffd"), F.lit("\ufdd0")
    text = F.replace(col.cast("string"), mark, noncharacter)
    text = F.replace(F.make_valid_utf8(text), mark, F.lit(""))
    return F.replace(text, noncharacter, mark)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def clean(col: Column, rules) -> Column:
    """Apply (pattern, replacement) rules in order, each to the last result."""
    for pattern, replacement in rules:
        col = F.regexp_replace(col, pattern, replacement)
    return col


def sentences(text: Column, delimiters: str) -> Column:
    """Sentences of a text; ``delimiters`` is the inside of a character class."""
    parts = F.transform(F.split(text, f"[{delimiters}]+"), strip)
    return F.filter(parts, lambda s: s != "")


def words(text: Column, separator: str, lower: bool = True) -> Column:
    """Words of a spaced script: split at ``separator``, blanks dropped."""
    text = F.lower(text) if lower else text
    return F.filter(F.split(text, separator), lambda w: w != "")


def drop_blank(tokens: Column) -> Column:
    return F.filter(F.transform(tokens, strip), lambda w: w != "")


def without(tokens: Column, stop_words) -> Column:
    """Tokens outside a short list; order and repeats stay as they are."""
    stop_words = list(stop_words)
    return F.filter(tokens, lambda w: ~w.isin(stop_words)) if stop_words else tokens


def phrase_count(text: Column, phrase: Column) -> Column:
    """How often a phrase occurs in a text without overlap."""
    removed = F.length(text) - F.length(F.replace(text, phrase, F.lit("")))
    return (removed / F.length(phrase)).cast("long")


def shared_over_length(shared: Column, n1: Column, n2: Column) -> Column:
    """Shared words over the summed log lengths; 0 where that is undefined."""
    scale = F.ln(n1.cast("double")) + F.ln(n2.cast("double"))
    return F.when((shared > 0) & (scale > 1e-12), shared / scale).otherwise(F.lit(0.0))


def sentence_similarity(a: Column, b: Column) -> Column:
    """Similarity of two word lists; lengths count repeats, shared words do not."""
    return shared_over_length(F.size(F.array_intersect(a, b)), F.size(a), F.size(b))


def in_charset(word: Column, charset: str | None = GB2312, forbidden: str = r"[~!@#$%^&* ]") -> Column:
    """No forbidden character, and every character encodable in the charset, if there is one.

    The charset becomes a constant array of marks by code point, so a character
    is looked up in one step.
    """
    if charset is None:
        return ~word.rlike(forbidden)
    members = set(charset)
    marks = "".join("1" if chr(c) in members else "0" for c in range(0x10000))
    by_code_point = F.split(F.lit(marks), "")
    encodable = F.forall(
        F.split(word, ""),
        lambda c: (c == "") | F.coalesce(F.get(by_code_point, F.ascii(c)) == "1", F.lit(False)),
    )
    return ~word.rlike(forbidden) & encodable


@dataclass(frozen=True)
class WordRule:
    """One condition a word must meet. ``at_len`` limits it to words of a length."""

    kind: str
    values: tuple = ()
    at_len: int | None = None


_CHECKS = {
    "must_match": lambda w, v: w.rlike(v[0]),
    "not_match": lambda w, v: ~w.rlike(v[0]),
    "min_len": lambda w, v: F.length(w) >= v[0],
    "not_contains": lambda w, v: ~reduce(or_, [w.contains(x) for x in v]),
    "not_first_char": lambda w, v: ~F.left(w, F.lit(1)).isin(*v),
    "not_last_char": lambda w, v: ~F.right(w, F.lit(1)).isin(*v),
    "not_first2": lambda w, v: ~F.left(w, F.lit(2)).isin(*v),
    "not_last2": lambda w, v: ~F.right(w, F.lit(2)).isin(*v),
    "not_single_repeated": lambda w, v: (F.length(w) <= 1)
    | (F.length(F.replace(w, F.left(w, F.lit(1)), F.lit(""))) > 0),
}


def acceptable(word: Column, rules) -> Column:
    """The conjunction of all word rules, as one expression."""
    result = F.lit(True)
    for rule in rules:
        check = _CHECKS[rule.kind](word, rule.values)
        if rule.at_len is not None:
            check = check | (F.length(word) != rule.at_len)
        result = result & check
    return result
