"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every number here is a column expression or an aggregate: no Python runs on the
executors. A rule has no fixed cutoff. One quantile sketch per language, source and
measure is built over all texts; the sketches are merged to languages and to all
rows. A text fails a measure if it lies beyond a fence

    third quartile + REACH x max(quartile distance, least distance of the measure)

(or below the mirrored one, for the mean length of words). The least distance keeps
a group whose texts are nearly alike from failing for a single sign. Groups of fewer
than ``least_rows`` texts take the fence of their language, and languages below it that
of all rows. The fences are joined to the texts by language and source.

Sketches hold every value of groups below ``SKETCH`` texts; above, ranks are off by
about a thousandth, so a text right at a fence may fall on either side.

Defined cases: a NULL, empty or blank text has no words, takes no part in the
sketches and fails the base rule; NULL languages and sources are groups like any
other; repeated rows stay rows and count each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordlode.session import cut_lineage

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# The smallest quartile distance taken for each measure.
MEASURES = {"symbol_ratio": 0.1, "dup_line_ratio": 0.1, "repeat_ratio": 0.1, "word_length": 1.5}
REACH = 3.0
SKETCH = 4096
LEAST_ROWS = 50
# Base rule: texts of fewer words, or with more percent of their words in repeated windows, fail.
LEAST_WORDS, MOST_REPEATED = 20, 30


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` and the base counts of each whole text.

    ``n_repeat_words`` counts the words inside windows of ``WINDOW`` words that occur at
    least twice. Each step is a projection of its own, so that an array is built once
    and not again in every lambda that looks into it.
    """
    t = F.col("t")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    words = F.filter(F.split(t, "[ \\t-\\r]+", -1), lambda w: w != "")
    # Shortest first: an array whose expressions are read twice is not folded into its reader.
    base = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).select(
        "row", lines.alias("lines"), F.transform(words, lambda w: F.xxhash64(w)).alias("words"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.xxhash64(F.slice("words", i + 1, WINDOW)),
    ))
    counted = base.select(
        "row", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # Equal windows lie side by side once sorted with their places; most texts have none.
    any_twin = F.size(F.array_distinct("windows")) < F.size("windows")
    numbers = ["row", "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    ordered = counted.select(*numbers, F.when(any_twin, F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )).alias("ordered"))
    twins = F.filter("ordered", lambda x, k: (
        F.coalesce(x["h"] == F.get("ordered", k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("ordered", k + 1)["h"], F.lit(False))
    ))
    places = ordered.select(*numbers, F.sort_array(F.transform(twins, lambda x: x["i"])).alias("places"))
    # Each window adds the words that the one before it has not covered.
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["total"] + i + WINDOW - F.greatest(i, acc["end"])).alias("total"),
            (i + WINDOW).alias("end"),
        ),
        lambda acc: acc["total"],
    )
    return places.select(*numbers, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _measures() -> dict[str, Column]:
    words = F.nullif(F.col("n_words"), F.lit(0)).cast("double")
    return {
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)).cast("double"),
        "repeat_ratio": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def fences(rows: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """lang, source and for each measure the bounds ``low_`` and ``high_`` that hold there.

    ``rows`` has lang, source and the measures. Sketches of groups are merged to
    those of languages and of all rows; they are not built again.
    """
    names = list(MEASURES)
    group = cut_lineage(rows.groupBy("lang", "source").agg(
        F.count(names[0]).alias("n"),
        *[F.kll_sketch_agg_double(m, F.lit(SKETCH)).alias(m) for m in names],
    ))

    def merged(prefix: str) -> list[Column]:
        return [F.sum("n").alias(f"{prefix}_n")] + [
            F.kll_merge_agg_double(m, F.lit(SKETCH)).alias(f"{prefix}_{m}") for m in names
        ]

    lang = group.groupBy(F.col("lang").alias("lang_of")).agg(*merged("lang"))
    every = group.agg(*merged("all"))
    # One row per group, per language and in all; the last is a single row.
    joined = group.join(lang, F.col("lang").eqNullSafe(F.col("lang_of"))).join(F.broadcast(every))

    def level(m: str) -> Column:
        return (
            F.when(F.col("n") >= least_rows, F.col(m))
            .when(F.col("lang_n") >= least_rows, F.col(f"lang_{m}")).otherwise(F.col(f"all_{m}"))
        )

    chosen = joined.select("lang", "source", *[level(m).alias(m) for m in names])
    quartiles = chosen.select("lang", "source", *[
        F.when(F.kll_sketch_get_n_double(m) > 0, F.kll_sketch_get_quantile_double(m, F.lit(q))).alias(f"{side}_{m}")
        for m in names for side, q in (("low", 0.25), ("high", 0.75))
    ])
    def reach(m: str) -> Column:
        return REACH * F.greatest(F.col(f"high_{m}") - F.col(f"low_{m}"), F.lit(MEASURES[m]))

    return quartiles.select("lang", "source", *[
        c for m in names for c in (
            (F.col(f"low_{m}") - reach(m)).alias(f"low_{m}"), (F.col(f"high_{m}") + reach(m)).alias(f"high_{m}"),
        )
    ])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          keys: tuple[str, ...] = ("doc_id",), least_rows: int = LEAST_ROWS) -> DataFrame:
    """``keys``, the base counts, base_failed and kept of every row."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = cut_lineage(measured(docs, text).select(
        F.struct(*[F.col(f"row.`{k}`").alias(k) for k in keys]).alias("key"),
        F.col(f"row.`{lang}`").alias("lang"), F.col(f"row.`{source}`").alias("source"), "n_lines", *counts,
    ))
    with_measures = rows.select("*", *[c.alias(m) for m, c in _measures().items()])
    bounds = cut_lineage(fences(with_measures.select("lang", "source", *MEASURES), least_rows))
    bounds = bounds.withColumnsRenamed({"lang": "lang_of", "source": "source_of"})
    joined = with_measures.join(
        bounds, F.col("lang").eqNullSafe(F.col("lang_of")) & F.col("source").eqNullSafe(F.col("source_of")),
        "left",
    )
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    beyond = F.col("word_length") < F.col("low_word_length")
    for m in MEASURES:
        beyond = beyond | (F.col(m) > F.col(f"high_{m}"))
    return joined.select(
        "key.*", *counts, base_failed.alias("base_failed"),
        (~base_failed & ~F.coalesce(beyond, F.lit(False))).alias("kept"),
    )
