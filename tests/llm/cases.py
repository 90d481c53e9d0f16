"""Small tables that hold the cases every operator must get through."""

from __future__ import annotations

import random

# Extra columns whose names clash with those that the operators use inside.
EXTRA = (
    "row string, result string, fp long, hash long, key string, n long, at long, host string, kept string, "
    "words string, n_words string, score string, label string, component_id string"
)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def random_text(rnd: random.Random, words: int) -> str:
    return " ".join(
        "".join(rnd.choice("abcdefghéñ") for _ in range(rnd.randint(1, 7))) for _ in range(words)
    )


def odd_rows(seed: int = 0) -> list[tuple]:
    """Documents with NULLs, blanks, ties, repeated rows and a very long text."""
    rnd = random.Random(seed)
    texts = [None, "", " \t\n ", "a", "Word", "...", "日本語 テキスト 😀", "a" * 3000, "x y " * 30_000]
    texts += [random_text(rnd, n) for n in (3, 20, 200, 200, 2000)]
    texts += [texts[-1], texts[-2] + " tail", "Same line.\n" * 40]
    rows = [
        (i if i % 7 else None, t, rnd.choice(["en", "de", None]), rnd.choice(["s1", None]),
         len(t) if t is not None and i % 3 else None)
        for i, t in enumerate(texts)
    ]
    return rows + rows[:6] + [(3, "another text with the same id", None, None, None)]


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source, n_chars) with the extra columns."""
    names = [c.split()[0] for c in EXTRA.split(", ")]
    kinds = [c.split()[1] for c in EXTRA.split(", ")]
    extra = tuple(f"{n}!" if k == "string" else 7 for n, k in zip(names, kinds))
    return spark.createDataFrame([tuple(r) + extra for r in rows], DOCS)
