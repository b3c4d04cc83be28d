"""Bounded walks over the link graph, robots rules, and the union of discoveries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.fixed import ALWAYS_ALLOWED_HOSTS, DEFAULT_MAX_DEPTH, DEFAULT_MAX_PAGES
from crawlspark.functions.url import authority, contains_any, percent_decode
from crawlspark.lineage import cut_lineage
from crawlspark.operators.lookup import join_lookup, on_listed
from crawlspark.operators.ordered import row_numbers

WALK = ["dept_key", "seed_ord"]


def bounded_walk(seeds: DataFrame, edges: DataFrame, max_depth: int = DEFAULT_MAX_DEPTH) -> DataFrame:
    """Breadth-first discovery from every seed: dept_key, seed_ord, url, depth, trail.

    ``seeds``: dept_key, seed_ord, url and optionally a max_depth of their own;
    ``max_depth`` holds where that is missing or NULL. The rounds end once no
    walk has a new url within its limit.
    ``edges``: page_id, url, targets - one row per fetched page. A url without
    edges (not fetched, or blocked) is discovered but leads nowhere.

    ``trail`` holds the positions of the links taken. Among urls of one depth
    its order is the order in which a first-in-first-out queue would meet them,
    so no ordinal has to be numbered over a whole walk.

    Each round writes its new urls as a table; a small frontier is then
    broadcast against the edges, a large one is joined by url.
    """
    start = seeds.select(
        *WALK,
        "url",
        F.lit(0).alias("depth"),
        F.array().cast("array<int>").alias("trail"),
        _own("max_depth", seeds, max_depth).alias("limit"),
    ).dropDuplicates([*WALK, "url"])
    rounds = [cut_lineage(start, "walk-0")]

    sites = cut_lineage(rounds[0].select(authority(F.col("url")).alias("site")).distinct(), "walk-sites")
    inside = on_listed(edges, sites, authority(F.col("url")))
    # Of a page fetched more than once the latest version counts.
    graph = cut_lineage(
        inside.groupBy("url").agg(F.max_by("targets", "page_id").alias("targets")), "walk-edges"
    )

    while not rounds[-1].isEmpty():
        depth = len(rounds)
        steps = (
            rounds[-1]
            .where(F.col("limit") >= depth)
            .join(graph, "url")
            .select(*WALK, "limit", "trail", F.posexplode("targets").alias("pos", "target"))
        )
        found = (
            steps.groupBy(*WALK, F.col("target").alias("url"))
            .agg(F.min(F.concat("trail", F.array("pos"))).alias("trail"), F.max("limit").alias("limit"))
            .withColumn("depth", F.lit(depth))
        )
        visited = reduce(DataFrame.unionByName, rounds).select(*WALK, "url")
        fresh = found.join(visited, [*WALK, "url"], "left_anti").select(*rounds[0].columns)
        rounds.append(cut_lineage(fresh, f"walk-{depth}"))
    return reduce(DataFrame.unionByName, rounds).select(*WALK, "url", "depth", "trail")


def walk_order() -> list[Column]:
    """Columns that put the urls of a walk in discovery order."""
    return [F.col("depth"), F.col("trail"), F.col("url")]


def binding_rules(rules: DataFrame, agent: str = "*") -> DataFrame:
    """The rules that bind ``agent``, one per host and prefix: host, prefix, line_no, path_prefix, allow.

    A section that names the agent wins over the general one; of several the
    first does. Of equal prefixes the first line counts. ``prefix`` is what a
    path has to begin with, which for ``*`` is nothing.
    """
    token = agent.split("/")[0].lower()
    named = F.col("agent") != "*"
    binding = rules.where(~named | (F.lit(token).contains(F.lower("agent")) & (F.col("agent") != "")))
    section = binding.where(named).groupBy("host").agg(F.min(F.struct("line_no", "agent")).alias("section"))
    own = join_lookup(binding, section, "host").where(F.col("agent") == F.coalesce("section.agent", F.lit("*")))
    decoded = percent_decode(F.col("path_prefix"))
    # An empty prefix forbids nothing.
    read = own.select(
        "host",
        F.when(decoded == "*", F.lit("")).otherwise(decoded).alias("prefix"),
        F.struct("line_no", decoded.alias("path_prefix"), (F.col("allow") | (decoded == "")).alias("allow")).alias("rule"),
    )
    return read.groupBy("host", "prefix").agg(F.min("rule").alias("rule")).select("host", "prefix", "rule.*")


def _of(host: Column, path: Column) -> Column:
    return F.concat_ws("\n", host, path)


def robots_allowed(
    urls: DataFrame,
    rules: DataFrame,
    agent: str = "*",
    always_allowed: list[str] | None = None,
    respect_robots: bool = True,
) -> DataFrame:
    """``urls`` with ``allowed``: the first rule whose prefix fits decides, without one it is allowed.

    A path is cut to the lengths that the host's prefixes have, and each of
    these beginnings is looked up: as many rows as there are such lengths,
    however many rules the host has. Each path of a host is asked for once.
    """
    if not respect_robots:
        return urls.withColumn("allowed", F.lit(True))
    always = ALWAYS_ALLOWED_HOSTS if always_allowed is None else always_allowed
    binding = cut_lineage(binding_rules(rules, agent), "robots-rules")
    # No longer than the longest prefix of the host.
    lengths = binding.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    local = F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*+://[^/?#]*+([^#]*)", 1)
    asked = percent_decode(F.when(local == "", F.lit("/")).otherwise(local))
    rows = urls.withColumn("_host", authority(F.col("url"))).withColumn("_path", asked)
    paths = rows.where(~contains_any(F.col("_host"), always)).select(F.col("_host").alias("host"), F.col("_path").alias("path")).distinct()
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    cut = join_lookup(paths, lengths, "host", "inner").select("host", "path", F.explode(fitting).alias("n"))
    beginnings = cut.select(
        _of(F.col("host"), F.col("path")).alias("asked"), _of(F.col("host"), F.substring("path", F.lit(1), F.col("n"))).alias("beginning")
    )
    looked_up = binding.select(_of(F.col("host"), F.col("prefix")).alias("beginning"), F.struct("line_no", "path_prefix", "allow").alias("rule"))
    first = (
        join_lookup(beginnings, looked_up, "beginning", "inner")
        .groupBy("asked")
        .agg(F.min("rule").alias("rule"))
        .select("asked", F.col("rule.allow").alias("_allow"))
    )
    joined = join_lookup(rows.withColumn("asked", _of(F.col("_host"), F.col("_path"))), first, "asked")
    return joined.select(*[joined[c] for c in urls.columns], F.coalesce("_allow", F.lit(True)).alias("allowed"))


def union_discoveries(*strategies: DataFrame) -> DataFrame:
    """First occurrence of each url per seed over strategies in the order given.

    Each has dept_key, seed_ord, url, depth, trail; adds ``strategy`` (from 0).
    """
    numbered = [s.select(*WALK, "url", F.lit(i).alias("strategy"), "depth", "trail") for i, s in enumerate(strategies)]
    everything = reduce(DataFrame.unionByName, numbered)
    return (
        everything.groupBy(*WALK, "url")
        .agg(F.min(F.struct("strategy", "depth", "trail")).alias("first"))
        .select(*WALK, "url", "first.*")
    )


def page_cap(discovered: DataFrame, max_pages: int = DEFAULT_MAX_PAGES) -> DataFrame:
    """The first pages of each seed in discovery order.

    A column ``max_pages`` bounds the seeds of its department; the parameter
    holds where it is missing or NULL. Places are numbered over range
    partitions, so a long walk spreads over tasks whatever its bound.
    """
    lead = ["strategy"] if "strategy" in discovered.columns else []
    one_key = discovered.withColumn("walk", F.to_json(F.struct(*WALK)))
    placed = row_numbers(one_key, "walk", [*lead, "depth", "trail", "url"], "place")
    return placed.where(F.col("place") <= _own("max_pages", discovered, max_pages)).drop("place", "walk")


def _own(name: str, rows: DataFrame, default: int) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in rows.columns else F.lit(default)
