"""URL filters by rules and by trust and distrust that spread over links between hosts.

A rule is a host, a path and an action; it fits its host and all subdomains where the
path of the url starts with its own. The longest rule that fits decides (host and path
together; of equally long ones that of the longer host, then one that blocks).

Pages that no rule fits are judged by their host. Trust starts at hosts with pages that
rules allow, distrust at those with pages that rules block, each by their part of the
host's pages; both are personalised PageRanks over one graph of hosts, trust along the
links (a good host links to good hosts), distrust against them (who links to a bad host
is bad). A walk ends at a host that has nowhere to go. Shares of both add up to one; a
host is blocked if its distrust is above ``ratio`` times its trust and above ``floor`` times
the mean share of a host. Hosts that neither reaches are allowed.

Everything is a column expression, an aggregate or a join: no Python runs on the
executors. Links are counted per pair of hosts before they are shuffled, the links of a
large host are spread over blocks, and the pages of a host are spread over salts when
they meet its verdict.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits no
rule and is allowed; a NULL or empty html has no links; links inside comments and
scripts count like others; links of a host to itself, and relative ones, are no edges;
repeated rows count each; a host is the text between ``//`` and the next ``/?#`` as it
stands, port included, A-Z lower-cased; an empty table gives no rows.
"""

from __future__ import annotations

import math
import string
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, functions as F

from wordlode.session import checkpoint_in_place, cut_lineage, drop_table

DAMPING = 0.85
# Shares rest when both kinds together move by less than this in a step.
TOLERANCE = 1e-9
MAX_STEPS = 1000
# Links of one host that may sit together.
BLOCK_LINKS = 1_000_000
SALTS = 64
RATIO, FLOOR = 1.0, 1.0
# Two shares closer than this are equal.
EQUAL = 1e-9

LINK = r"""(?i)<a(?:rea)?\s(?:[^>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


class Rule(NamedTuple):
    host: str
    path: str
    action: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def with_host(pages: DataFrame, url: str, *kept: Column) -> DataFrame:
    """``kept``, host and path of each url."""
    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    rest = pages.select(*kept, F.when(F.instr(u, "://") > 0, F.substr(u, F.instr(u, "://") + 3)).alias("_rest"))
    host = F.regexp_extract(F.coalesce("_rest", F.lit("")), "^[^/?#]*", 0)
    split = rest.select("*", host.alias("_host"))
    names = [c for c in split.columns if c not in ("_rest", "_host")]
    behind = F.coalesce(F.substr("_rest", F.length("_host") + 1), F.lit(""))
    return split.select(
        *names, lower_ascii(F.col("_host")).alias("host"), F.regexp_extract(behind, "^[^?#]*", 0).alias("path"),
    )


def fitting(rules: list[Rule]) -> tuple[Column, Column]:
    """The text and the action of the longest rule that fits ``host`` and ``path``; NULL if none."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last one wrapped around is tried first.
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.action == "block")):
        fits = (
            ((F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host)))
            & F.startswith("path", F.lit(rule.path))
        )
        text, action = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.action)).otherwise(action)
    return text, action


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """src, dst, links: how many links lead from one host to another."""
    rows = with_host(pages, url, F.col(f"`{html}`").alias("_html"))
    found = rows.select("host", F.explode_outer(F.regexp_extract_all("_html", F.lit(LINK), 1)).alias("dst"))
    named = found.where("dst IS NOT NULL AND host <> ''").select(
        F.col("host").alias("src"), lower_ascii(F.col("dst")).alias("dst")
    )
    return named.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread_from(edges: DataFrame, seeds: DataFrame, block_links: int = BLOCK_LINKS) -> DataFrame:
    """kind, node, share: personalised PageRank of every kind of seed over its own edges.

    ``edges`` has kind, src, dst, links; ``seeds`` has kind, node, seed. The shares of a kind add up
    to one. Edges are shuffled once and stay where they are; a step moves ranks and partial
    sums and is one written table.
    """
    seeds = cut_lineage(seeds.where("seed > 0"))
    total = seeds.groupBy("kind").agg(F.sum("seed").alias("total"))
    seeds = seeds.join(F.broadcast(total), "kind").select(  # one row per kind
        "kind", "node", (F.col("seed") / F.col("total")).alias("seed")
    )
    none = F.lit(None).cast("long")
    nodes = (
        edges.select("kind", F.col("src").alias("node"), F.lit(0.0).alias("seed"), "links", F.lit(1).alias("edges"))
        .unionByName(edges.select("kind", F.col("dst").alias("node"), F.lit(0.0).alias("seed"), none.alias("links"), F.lit(0).alias("edges")))
        .unionByName(seeds.select("kind", "node", "seed", none.alias("links"), F.lit(0).alias("edges")))
        .groupBy("kind", "node")
        .agg(F.sum("seed").alias("seed"), F.sum("links").alias("links"), F.sum("edges").alias("edges"))
    )
    # Hosts without links have no blocks.
    blocks = F.when(F.col("links") > 0, F.ceil(F.col("edges") / block_links).cast("long"))
    nodes = cut_lineage(nodes.select("kind", "node", "seed", "links", "edges", blocks.alias("blocks")))
    n_edges = nodes.agg(F.sum("edges")).first()[0] or 0
    state = nodes.select("kind", "node", "seed", F.col("seed").alias("rank"), "blocks")
    if n_edges:
        cores = edges.sparkSession.sparkContext.defaultParallelism
        parts = max(cores, math.ceil(n_edges / BLOCK_LINKS))
        out = nodes.where("blocks IS NOT NULL").select("kind", F.col("node").alias("src"), F.col("links").alias("all"), "blocks")
        # ``out`` has one row per host and kind; a host with very many links is dealt by AQE.
        shares = edges.join(out, ["kind", "src"]).select(
            "kind", "src", F.pmod(F.xxhash64("dst"), F.col("blocks")).alias("block"), "dst",
            (F.col("links") / F.col("all")).alias("share"),
        )
        shares = checkpoint_in_place(
            shares,
            lambda df: df.repartition(parts, "kind", "src", "block").sortWithinPartitions("kind", "src", "block"),
        ).persist(StorageLevel.MEMORY_AND_DISK)
        before = nodes
        for _ in range(MAX_STEPS):
            sent = state.where("blocks IS NOT NULL AND rank > 0").select(
                "kind", F.col("node").alias("src"), "rank",
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            )
            received = sent.join(shares, ["kind", "src", "block"]).select(
                "kind", F.col("dst").alias("node"), (F.col("rank") * F.col("share")).alias("inflow"),
                F.lit(0.0).alias("seed"), F.lit(0.0).alias("old"), none.alias("blocks"),
            )
            kept = state.select("kind", "node", F.lit(0.0).alias("inflow"), "seed", F.col("rank").alias("old"), "blocks")
            seen = Observation()
            state = cut_lineage(
                received.unionByName(kept).groupBy("kind", "node")
                .agg(*[F.sum(c).alias(c) for c in ("inflow", "seed", "old", "blocks")])
                .withColumn("rank", DAMPING * F.col("inflow") + (1 - DAMPING) * F.col("seed"))
                .observe(seen, F.sum(F.abs(F.col("rank") - F.col("old"))).alias("moved"))
                .drop("inflow", "old")
            )
            drop_table(before)
            before = state
            if (seen.get["moved"] or 0.0) < TOLERANCE:
                break
        else:
            raise RuntimeError(f"shares still moved by {seen.get['moved']} after {MAX_STEPS} steps")
        shares.unpersist()
    whole = state.groupBy("kind").agg(F.sum("rank").alias("whole"))
    return state.join(F.broadcast(whole), "kind").select(  # one row per kind
        "kind", "node", F.coalesce(F.col("rank") / F.nullif("whole", F.lit(0.0)), F.lit(0.0)).alias("share")
    )


def host_shares(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """host, trust, distrust of every host that has pages, links or is linked to."""
    text, action = fitting(rules)
    ruled = with_host(pages, url).where("host <> ''").select("host", action.alias("action"))
    hosts = cut_lineage(ruled.groupBy("host").agg(
        F.avg(F.col("action").eqNullSafe("allow").cast("int")).alias("allowed"),
        F.avg(F.col("action").eqNullSafe("block").cast("int")).alias("blocked"),
    ))
    seeds = hosts.select(F.col("host").alias("node"), F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("allowed").alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), F.col("blocked").alias("seed")),
    )).alias("s")).select("s.kind", "node", "s.seed")
    links = cut_lineage(host_links(pages, url, html))
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    shares = spread_from(edges, seeds)
    known = hosts.select(F.col("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    return known.unionByName(shares.select(
        F.col("node").alias("host"),
        F.when(F.col("kind") == "trust", F.col("share")).otherwise(0.0).alias("trust"),
        F.when(F.col("kind") == "distrust", F.col("share")).otherwise(0.0).alias("distrust"),
    )).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))


def blocked_hosts(shares: DataFrame, ratio: float = RATIO, floor: float = FLOOR) -> DataFrame:
    """Hosts whose distrust outweighs their trust."""
    n = shares.agg(F.count("*").alias("hosts"))
    return shares.join(F.broadcast(n)).where(  # a single row
        (F.col("distrust") > F.col("trust") * ratio * (1 + EQUAL))
        & (F.col("distrust") * F.col("hosts") > floor * (1 + EQUAL))
    ).select("host")


def judge(
    pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", keys: tuple[str, ...] = ("page_id",),
    ratio: float = RATIO, floor: float = FLOOR,
) -> DataFrame:
    """``row`` (the columns ``keys``), host, path, rule and verdict of every page."""
    bad = cut_lineage(blocked_hosts(cut_lineage(host_shares(pages, rules, url, html)), ratio, floor))
    text, action = fitting(rules)
    row = F.struct(*[F.col(f"`{k}`").alias(k) for k in keys])
    rows = with_host(pages, url, row.alias("row")).select("row", "host", "path", text.alias("rule"), action.alias("action"))
    # The pages of a host meet its verdict in many tasks: hosts that are blocked stand once for each salt.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row", "path"), F.lit(SALTS)).cast("int"))
    doomed = bad.select("host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("bad"))
    met = salted.join(doomed, ["host", "salt"], "left")
    verdict = F.coalesce("action", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow")))
    return met.select("row", "host", "path", "rule", verdict.alias("verdict"))
