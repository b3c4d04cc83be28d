"""Queries over the link graph of pages: walks, robots rules, unions, caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.functions.url import authority
from crawlspark.operators import links, walk
from crawlspark.operators.departments import select_departments
from crawlspark.operators.ordered import row_numbers
from workload.common import SQL_ANCHORS, SQL_PAGES, lang, table


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(seeds, edges): pages of a host form a binary tree by page_id; each page also has its own links.

    The first page of a host is its seed, the language its department.
    """
    pages = table(spark, sf_dir, "pages")
    numbered = row_numbers(
        pages.select("page_id", "url", authority(F.col("url")).alias("host")), "host", ["page_id"], "k"
    )
    parents = numbered.select("host", F.floor(F.col("k") / 2).alias("k"), F.col("url").alias("child"), F.col("k").alias("child_k"))
    # At most two children per page.
    children = (
        numbered.join(parents, ["host", "k"])
        .groupBy("page_id")
        .agg(F.array_sort(F.collect_list(F.struct("child_k", "child"))).alias("children"))
    )
    edges = (
        links.walk_edges(pages)
        .join(children, "page_id", "left")
        .select(
            "page_id",
            "url",
            F.concat(
                F.coalesce(F.col("children.child"), F.array().cast("array<string>")), "targets"
            ).alias("targets"),
        )
    )
    seeds = numbered.where(F.col("k") == 1).select(
        lang(F.col("url")).alias("dept_key"), F.col("page_id").cast("int").alias("seed_ord"), "url"
    )
    return seeds, edges


def walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walks as deep as their department says; one says nothing and goes three deep."""
    seeds, edges = graph(spark, sf_dir)
    limit = F.when(F.col("dept_key") == "en", 4).when(F.col("dept_key") == "de", 2).when(F.col("dept_key") == "fr", 1)
    return walk.bounded_walk(seeds.withColumn("max_depth", limit), edges)


def bounded_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walked(spark, sf_dir).select(
        "dept_key", F.col("seed_ord").cast("long").alias("seed_ord"), "url", F.col("depth").cast("long").alias("depth")
    )


def walk_page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap for each department; one has none of its own."""
    limit = F.when(F.col("dept_key") == "en", 9).when(F.col("dept_key") == "de", 1500).when(F.col("dept_key") == "fr", 2)
    return walk.page_cap(walked(spark, sf_dir).withColumn("max_pages", limit)).select(
        "dept_key", F.col("seed_ord").cast("long").alias("seed_ord"), "url"
    )


def discovery_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk, then the pages a host lists, then archive links of the seed page."""
    seeds, edges = graph(spark, sf_dir)
    pages = table(spark, sf_dir, "pages")
    marked = seeds.select(*walk.WALK, "url", authority(F.col("url")).alias("host"))
    none = F.array().cast("array<int>")
    listed = marked.drop("url").join(
        pages.select(authority(F.col("url")).alias("host"), "url"), "host"
    ).select(*walk.WALK, "url", F.lit(0).alias("depth"), none.alias("trail"))
    archived = marked.join(
        links.archive_links(pages, ["tion", "en"]).withColumnRenamed("page_url", "url"), "url"
    ).select(*walk.WALK, F.col("target_url").alias("url"), F.lit(0).alias("depth"), F.array("ord").alias("trail"))
    return walk.union_discoveries(walk.bounded_walk(seeds, edges, 3), listed, archived).select(
        "dept_key",
        F.col("seed_ord").cast("long").alias("seed_ord"),
        "url",
        F.col("strategy").cast("long").alias("strategy"),
    )


def robots_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from pages: plain http pages forbid their own number range, tagged ones allow theirs."""
    pages = table(spark, sf_dir, "pages")
    url = F.col("url")
    prefix = F.regexp_extract(url, r"^https?://[^/]+(/[a-z]+/[0-9])", 1)
    rules = pages.where(url.startswith("http://") | url.contains("utm_source")).select(
        authority(url).alias("host"),
        F.col("page_id").cast("int").alias("line_no"),
        F.lit("*").alias("agent"),
        url.contains("utm_source").alias("allow"),
        prefix.alias("path_prefix"),
    )
    return walk.robots_allowed(pages.select("url"), rules, always_allowed=["blog."])


def department_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("dept_key"), F.col("n_name").alias("name")
    )
    return select_departments(nations, ["3", "17", "NATION_5", "NATION_17", "FRANCE"])


QUERIES = {
    "bounded_walk": bounded_walk,
    "walk_page_cap": walk_page_cap,
    "discovery_union": discovery_union,
    "robots_filter": robots_filter,
    "department_selection": department_selection,
}

_GRAPH = (
    "WITH RECURSIVE "
    + SQL_ANCHORS
    + r""",
n AS (SELECT page_id, url, host, lang, row_number() OVER (PARTITION BY host ORDER BY page_id) AS k FROM p),
own AS (SELECT url, target, min(pos) AS pos FROM a GROUP BY url, target),
edges AS (
  SELECT parent.url AS src, child.url AS dst, child.k AS pos
  FROM n AS parent JOIN n AS child ON parent.host = child.host AND child.k // 2 = parent.k
  UNION ALL SELECT url, target, 1000000000 + pos FROM own),
seeds AS (SELECT lang AS dept_key, page_id AS seed_ord, url, host FROM n WHERE k = 1),
w AS (
  SELECT dept_key, seed_ord, url, 0 AS depth, CAST([] AS BIGINT[]) AS trail FROM seeds
  UNION ALL
  SELECT w.dept_key, w.seed_ord, edges.dst, w.depth + 1, list_append(w.trail, edges.pos)
  FROM w JOIN edges ON w.url = edges.src WHERE w.depth < {depth}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dept_key, seed_ord, url ORDER BY depth, trail) AS nth FROM w),
found AS (SELECT dept_key, seed_ord, url, depth, trail FROM ranked WHERE nth = 1)"""
)

_DEPTH = "CASE dept_key WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 1 ELSE 3 END"

SQL = {
    "bounded_walk": _GRAPH.replace("{depth}", _DEPTH)
    + """
SELECT dept_key, CAST(seed_ord AS BIGINT) AS seed_ord, url, CAST(depth AS BIGINT) AS depth FROM found""",
    "walk_page_cap": _GRAPH.replace("{depth}", _DEPTH)
    + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY dept_key, seed_ord ORDER BY depth, trail, url) AS place FROM found)
SELECT dept_key, CAST(seed_ord AS BIGINT) AS seed_ord, url FROM placed 
WHERE place <= CASE dept_key WHEN 'en' THEN 9 WHEN 'de' THEN 1500 WHEN 'fr' THEN 2 ELSE 1000 END""",
    "discovery_union": _GRAPH.replace("{depth}", "3")
    + """,
everything AS (
  SELECT dept_key, seed_ord, url, 0 AS strategy FROM found
  UNION ALL SELECT s.dept_key, s.seed_ord, p.url, 1 FROM seeds s JOIN p ON s.host = p.host
  UNION ALL SELECT s.dept_key, s.seed_ord, a.target, 2 FROM seeds s JOIN a ON s.url = a.url
    WHERE regexp_matches(lower(a.text) || ' ' || lower(a.href), 'tion|en'))
SELECT dept_key, CAST(seed_ord AS BIGINT) AS seed_ord, url, CAST(min(strategy) AS BIGINT) AS strategy
FROM everything GROUP BY dept_key, seed_ord, url""",
    "robots_filter": f"""
WITH {SQL_PAGES},
u AS (SELECT url, host, regexp_extract(url, '^https?://[^/]+([^#]*)', 1) AS path FROM p),
r AS (
  SELECT host, page_id AS line_no, url LIKE '%utm_source%' AS allow,
    regexp_extract(url, '^https?://[^/]+(/[a-z]+/[0-9])', 1) AS prefix
  FROM p WHERE url LIKE 'http://%' OR url LIKE '%utm_source%'),
j AS (
  SELECT u.url, u.host, arg_min(r.allow, r.line_no) AS allow
  FROM u LEFT JOIN r ON u.host = r.host AND starts_with(u.path, r.prefix) GROUP BY u.url, u.host)
SELECT url, contains(host, 'blog.') OR coalesce(allow, true) AS allowed FROM j""",
    "department_selection": """
SELECT CAST(n_nationkey AS VARCHAR) AS dept_key, n_name AS name FROM nation
WHERE CAST(n_nationkey AS VARCHAR) IN ('3', '17', 'NATION_5', 'NATION_17', 'FRANCE')
  OR n_name IN ('3', '17', 'NATION_5', 'NATION_17', 'FRANCE')""",
}
