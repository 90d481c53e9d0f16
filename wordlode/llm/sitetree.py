"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: elements with the same chain of labels (tag,
class, id) are one node. A node has

- a presentation importance: the entropy of the child sequences that it shows, over
  the logarithm of the pages that hold it, and
- a content importance: for each text block under it 1 - log(pages with this text) /
  log(pages with the node), on average. Text found on all pages counts 0.

Both meet in the composite importance (1 - g^l) presentation + g^l content, with g =
0.9 and l the number of child sequences. Branches below ``LEAST`` are cut from each page.

Entropy alone cannot tell an advert that differs on every page from an article, so
elements that are no article by tag, role or class (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments) have importance zero beforehand,
as has text outside an article that holds at least half of the text. A class or id counts
if it is a whole name of this kind; elements that only have such a word in a name
(with-sidebar, search-results) are left to the tree. No element goes by class or id
that holds an article, or most of the text where no article has any.

Pages with the same content count once, so copies of an article do not make it look
like a template, and hosts with fewer than ``LEAST_PAGES`` of them are not judged.

All counts are sums by (host, node, value), added up in each task before they are
shuffled; no host is gathered anywhere. The branches to cut are few, they come
from nodes that repeat; Spark broadcasts them if they are small and otherwise
joins by host, splitting large hosts.

Defined cases: NULL or empty html gives an empty text; a NULL url or one without a
host is read without a tree; a page that would lose all text to the tree keeps it.
Repeated pages stay rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wordlode.llm import dom
from wordlode.llm.rows import annotate
from wordlode.session import cut_lineage, spread

GAMMA = 0.9
LEAST = 0.2
LEAST_PAGES = 8
# Tasks that the pages of a host may be spread over.
SALTS = 16
_PAGES, _STYLE, _TEXT, _ABOVE = range(4)


def host(url: Column) -> Column:
    """Lower-case host of a URL; NULL if it has none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def _signs(page: str | None) -> tuple[int, set[tuple[int, int, int]]]:
    """Content hash of a page and its distinct signs (kind, node, value)."""
    blocks, styles = dom.read(page)
    main = dom.content(blocks)
    found = {(_STYLE, path, style) for path, style in styles} | {(_PAGES, path, 0) for path, _ in styles}
    for block in main:
        node = block.paths[-1]
        found.add((_TEXT, node, dom.normal(block.text)))
        found.update((_ABOVE, node, holder) for holder in block.paths[1:])
    return dom._hash("\n".join(b.text for b in main)), found


def _emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per page: its signs in three arrays."""
    for frame in frames:
        rows, seen = [], set()
        for site, page in zip(frame["host"], frame["html"]):
            whole, found = _signs(page)
            if (site, whole) not in seen:
                seen.add((site, whole))
                rows.append((site, whole, *(map(list, zip(*sorted(found))) if found else ([], [], []))))
        yield pd.DataFrame(rows, columns=["host", "page", "kind", "node", "value"])


def unimportant(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """host, cut: the nodes of each host's style tree below ``LEAST``."""
    site = host(F.col(f"`{url}`"))
    given = pages.where(site.isNotNull()).select(F.xxhash64(site).alias("host"), F.col(f"`{html}`").alias("html"))
    # Pages first, so that copies go before their signs are counted.
    distinct = given.mapInPandas(
        _emit, "host long, page long, kind array<int>, node array<long>, value array<long>"
    ).dropDuplicates(["host", "page"])
    held = (
        distinct.select("host", F.inline(F.arrays_zip("kind", "node", "value")))
        .groupBy("host", "node", "kind", "value").agg(F.count("*").alias("c"))
    )
    sums = held.groupBy("host", "node").agg(
        F.max(F.when(F.col("kind") == _PAGES, F.col("c"))).alias("pages"),
        # A node is its chain of labels, so the nodes above it are always the same.
        F.collect_set(F.when(F.col("kind") == _ABOVE, F.col("value"))).alias("above"),
        *[
            F.sum(F.when(F.col("kind") == kind, value)).alias(f"{name}_{part}")
            for kind, name in ((_STYLE, "style"), (_TEXT, "text"))
            for part, value in (("n", F.col("c")), ("log", F.col("c") * F.log("c")), ("kinds", F.lit(1)))
        ],
    ).where(F.col("pages") >= LEAST_PAGES)
    most = F.log("pages")
    nodes = cut_lineage(sums.select(
        "host", "node", "above", F.col("style_kinds").alias("kinds"),
        ((F.log("style_n") - F.col("style_log") / F.col("style_n")) / most).alias("presentation"),
        F.col("text_n").alias("n"), (F.col("text_n") - F.col("text_log") / most).alias("content"),
    ))
    under = (
        nodes.where("n > 0").select("host", F.explode("above").alias("node"), "n", "content")
        .groupBy("host", "node").agg((F.sum("content") / F.sum("n")).alias("below"))
    )
    fade = F.pow(F.lit(GAMMA), F.col("kinds"))
    importance = (1 - fade) * F.least(F.col("presentation"), F.lit(1.0)) + fade * F.col("below")
    return cut_lineage(
        nodes.select("host", "node", "kinds", "presentation").join(under, ["host", "node"])
        .where(importance < LEAST).groupBy("host").agg(F.collect_set("node").alias("cut"))
    )


def main_text(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``row`` and ``result``: the main text of each whole page."""
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for documents, cuts in batches:
            out = []
            for page, cut in zip(documents, cuts):
                blocks = dom.content(dom.read(page)[0])
                if cut is not None and len(cut):
                    gone = set(np.asarray(cut).tolist())
                    blocks = [b for b in blocks if gone.isdisjoint(b.paths)] or blocks
                out.append(" ".join(b.text for b in blocks))
            yield pd.Series(out, dtype=object)

    pages = spread(pages)
    cut = unimportant(pages, html, url)
    # A host's pages meet its cuts in many tasks; pages without a host meet none, wherever they are.
    name = host(F.col(f"`{url}`"))
    any_place = F.xxhash64(F.lit("page"), F.col(f"`{url}`"), F.col(f"`{html}`"))
    rows = annotate(pages, F.struct(
        F.coalesce(F.when(name.isNotNull(), F.xxhash64(name)), any_place).alias("at"),
        F.pmod(any_place, F.lit(SALTS)).cast("int").alias("salt"), name.isNotNull().alias("has_host"),
    ))
    salted = cut.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.join(
        salted,
        F.col("result.has_host") & (F.col("result.at") == F.col("host")) & (F.col("result.salt") == F.col("salt")), "left",
    )
    udf = F.pandas_udf(read, "string").asNondeterministic()
    return joined.select("row", udf(F.col(f"row.`{html}`"), F.col("cut")).alias("result"))
