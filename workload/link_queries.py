"""Queries over pages: extraction, classification, archives, forms, profiles, seeds and sitemaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.functions.fixed import ARCHIVE_WORDS, DOCUMENT_URL_PATTERNS, DOCUMENT_WORDS, WEB_PAGE_WORDS
from crawlspark.functions.url import authority
from crawlspark.operators import links, profile
from crawlspark.operators.departments import documents_found
from crawlspark.operators.forms import search_requests
from crawlspark.operators.rules import LinkRule, classify
from crawlspark.sources.seeds import departments_of_seeds, seeds_from_lines
from crawlspark.sources.sitemaps import sitemap_urls
from workload.common import SQL_ANCHORS, SQL_PAGES, lang, marked_up, table

ANCHOR = r'<a href="(/[^"]*)">'

MIXED = {
    "en": '<a class="v" href="/web/viewer.html?file=..$1.pdf">',
    "fr": "<a href=\"javascript:show('t','$1.PDF')\">",
    "de": '<iframe src="$1?format=pdf"></iframe><a href="#x">',
    "es": "<b data-url='docs$1.pdf'><a>",
}
MIXED_TARGET = """
  CASE lang WHEN 'en' THEN site || href || '.pdf' WHEN 'fr' THEN site || href || '.PDF'
    WHEN 'de' THEN site || href || '?format=pdf' WHEN 'es' THEN folder || 'docs' || href || '.pdf' END"""

HIDDEN = {
    "en": '<a hidden href="$1.pdf">',
    "fr": '<a style="color:red;display:none" href="$1.pdf">',
    "de": '<a title="Download it" href="/download$1">',
    "es": '<a href="#" data-href="x/pdf$1">',
}

FORMS = {
    "en": '<form action="/find" method="POST"><input type="text" name="q"><input type="hidden" name="lang" value="en">'
    "<input type='hidden' name=\"lang\" value=\"en2\"></form><nav>",
    "fr": '<form><input type="search" name="mot" placeholder="Search site"></form><nav>',
    "de": '<form action="suche?x=1"><input type="text" name="vorname"><input type="text" name="suchquery"></form><nav>',
    "es": '<form action="/no"><input type="text" name="zip"></form><nav>',
}

RULES = [
    LinkRule(1, "text", "contains", "tion", ["ment"]),
    LinkRule(2, "text", "contains", "en", ["ou", "ch"]),
    LinkRule(3, "url", "pattern", r"/[a-m][^/]*$"),
    LinkRule(4, "url", "pattern", r"\?utm_source"),
    LinkRule(5, "url", "contains", ".html"),
]


def host_link_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.link_counts_by_site(table(spark, sf_dir, "pages"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.page_links(table(spark, sf_dir, "pages"))
    return found.select("page_url", "kind", F.col("pos").cast("long").alias("pos"), "href", "text", "target_url")


def same_site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.page_links(marked_up(spark, sf_dir, ANCHOR, {"en": '<a href="//other.example$1">', "fr": '<a href="..$1?q">'}))
    return found.select(
        "page_url", "target_url", links.same_site(F.col("page_url"), F.col("target_url")).alias("internal")
    ).distinct()


def document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.document_links(marked_up(spark, sf_dir, ANCHOR, MIXED))
    return found.select("page_url", F.col("ord").cast("long").alias("ord"), "target_url")


def link_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.classified_links(marked_up(spark, sf_dir, ANCHOR, MIXED))
    return found.groupBy("kind", "rule_ord").agg(F.count("*").alias("links"))


def link_classify_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    subjects = links.page_links(pages).select(F.col("target_url").alias("url"), "text").unionByName(
        pages.select("url", F.lit("").alias("text"))
    )
    ruled = subjects.select(F.coalesce(classify(F.col("url"), F.col("text"), RULES), F.lit(0)).alias("rule_ord"))
    return ruled.groupBy("rule_ord").agg(F.count("*").alias("links"))


def hidden_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.hidden_links(marked_up(spark, sf_dir, ANCHOR, HIDDEN))


def archive_year_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.archive_links(marked_up(spark, sf_dir, r'<a href="/', {"de": '<a href="/2019/'}))
    return found.select("page_url", F.col("ord").cast("long").alias("ord"), "target_url")


def search_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = search_requests(marked_up(spark, sf_dir, "<nav>", FORMS))
    pairs = F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return plan.select(
        "page_url",
        F.col("form_pos").cast("long").alias("form_pos"),
        "term",
        "method",
        "form_url",
        F.array_join(F.array_sort(pairs), "&").alias("params"),
    )


def search_result_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.search_result_links(marked_up(spark, sf_dir, ANCHOR, {"de": '<a href="found$1.pdf">', "fr": '<a href="/files$1">'}))


def found_by_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = marked_up(spark, sf_dir, ANCHOR, MIXED)
    visited = pages.select(lang(F.col("url")).alias("dept_key"), "url")
    search = search_result_links(spark, sf_dir).select(lang(F.col("page_url")).alias("dept_key"), "target_url")
    return documents_found(visited, links.document_links(pages), search)


def script_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.script_weight(marked_up(spark, sf_dir, "<p>", {"fr": '<p onclick="go()">'}), RULES[:1])


def site_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    urls = links.page_links(pages).select(F.col("target_url").alias("url")).unionByName(pages.select("url"))
    return profile.site_profile(urls, ["example.com", ".org"])


def page_text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.page_text(table(spark, sf_dir, "pages"))


def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as a Markdown list: a header, its own address twice, two more, and an empty department."""
    url = F.col("url")
    site = F.regexp_extract(url, r"^(https?://[^/?#]*)", 1)
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("## 1. "), authority(url), F.lit(" ("), F.upper(lang(url)), F.lit("):")),
        F.concat(F.lit("1. **Home**: "), url, F.lit(".")),
        F.concat(F.lit("2. **Again**: "), url),
        F.concat(F.lit("3. More (see "), site, F.lit("/a), "), site, F.lit("/b;")),
        F.lit("## 2. Empty Part:"),
        F.lit("no address"),
    )
    return table(spark, sf_dir, "pages").select(
        url.alias("file"), F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )


def markdown_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = seeds_from_lines(seed_lines(spark, sf_dir))
    return seeds.select("dept_key", "name", F.col("seed_ord").cast("long").alias("seed_ord"), "url")


def markdown_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return departments_of_seeds(seeds_from_lines(seed_lines(spark, sf_dir)))


def sitemap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps from pages: an index at the location its language stands for and a part per page.

    Spanish pages are listed directly, the parts of German pages are cut off.
    """
    url, code = F.col("url"), lang(F.col("url"))
    host = authority(url)
    part = F.concat(F.lit("https://"), host, F.lit("/part-"), F.col("page_id").cast("string"), F.lit(".xml"))
    escaped = F.replace(url, F.lit("&"), F.lit("&amp;"))
    name = F.lit(' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">')
    listed = F.concat(
        F.lit("<urlset"), name, F.lit("<url><loc>"), escaped, F.lit("</loc></url><url><loc>https://else.example/x</loc></url>"),
        F.when(code != "de", F.lit("</urlset>")).otherwise(F.lit("")),
    )
    index = F.concat(F.lit("<sitemapindex"), name, F.lit("<sitemap><loc>"), part, F.lit("</loc></sitemap></sitemapindex>"))
    location = (
        F.when(code == "en", F.concat(F.lit("https://"), host, F.lit("/sitemap.xml")))
        .when(code == "fr", F.concat(F.lit("https://"), host, F.lit("/sitemap_index.xml")))
        .when(code == "de", F.concat(F.lit("https://"), host, F.lit("/sitemaps.xml")))
        .otherwise(F.concat(F.lit("http://"), host, F.lit("/sitemap.xml")))
    )
    rows = F.array(
        F.struct(location.alias("sitemap_url"), F.when(code == "es", listed).otherwise(index).alias("xml")),
        F.struct(part.alias("sitemap_url"), listed.alias("xml")),
    )
    return table(spark, sf_dir, "pages").select(host.alias("host"), F.explode(rows).alias("s")).select("host", "s.*")


def sitemap_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap_urls(sitemap_table(spark, sf_dir))


QUERIES = {
    "host_link_report": host_link_report,
    "page_links": page_links,
    "same_site_links": same_site_links,
    "document_links": document_links,
    "link_kinds": link_kinds,
    "link_classify_by_rule": link_classify_by_rule,
    "hidden_links": hidden_links,
    "archive_year_links": archive_year_links,
    "search_plan": search_plan,
    "search_result_links": search_result_links,
    "found_by_department": found_by_department,
    "script_weight": script_weight,
    "site_profile": site_profile,
    "page_text_table": page_text_table,
    "markdown_seeds": markdown_seeds,
    "markdown_departments": markdown_departments,
    "sitemap_listing": sitemap_listing,
}

_SEARCH_HITS = r"""
  SELECT DISTINCT url AS page_url, lang, target FROM (
    SELECT url, lang, text, CASE lang WHEN 'de' THEN folder || 'found' || href || '.pdf'
      WHEN 'fr' THEN site || '/files' || href ELSE target END AS target FROM a)
  WHERE lang IN ('de', 'fr') OR contains(lower(target), '.pdf')
    OR (regexp_matches(lower(text), '""" + "|".join(DOCUMENT_WORDS) + r"""')
        AND NOT regexp_matches(lower(text), '""" + "|".join(WEB_PAGE_WORDS) + r"""'))
    OR regexp_matches(target, '(?i)""" + "|".join(DOCUMENT_URL_PATTERNS) + r"""')"""

_SEEDS = SQL_PAGES + r""",
s AS (
  SELECT url AS file, host, regexp_replace(lower(host), '[^\p{L}\p{N}_\s]', '', 'g') AS dept_key,
    unnest([url, site || '/a', site || '/b']) AS seed, unnest([0, 1, 2]) AS seed_ord
  FROM p)"""

SQL = {
    "host_link_report": f"""
WITH {SQL_ANCHORS}
SELECT host AS site, CAST(count(*) AS BIGINT) AS links, CAST(count(DISTINCT target) AS BIGINT) AS distinct_targets,
  CAST(count(*) FILTER (regexp_extract(target, '^https?://([^/?#]*)', 1) = host) AS BIGINT) AS internal,
  CAST(count(*) FILTER (regexp_extract(target, '^https?://([^/?#]*)', 1) <> host) AS BIGINT) AS external
FROM a GROUP BY host""",
    "page_links": f"""
WITH {SQL_ANCHORS}
SELECT url AS page_url, 'anchor' AS kind, CAST(pos AS BIGINT) AS pos, href, text, target AS target_url FROM a""",
    "same_site_links": f"""
WITH {SQL_ANCHORS},
t AS (SELECT url, lang, CASE lang WHEN 'en' THEN regexp_extract(site, '^(https?:)', 1) || '//other.example' || href
    WHEN 'fr' THEN CASE WHEN regexp_matches(folder, '^https?://[^/]+/[a-z]+/$') THEN site || href || '?q'
      ELSE site || '/' || lang || href || '?q' END
    ELSE target END AS target FROM a)
SELECT DISTINCT url AS page_url, target AS target_url, lang <> 'en' AS internal FROM t""",
    "document_links": f"""
WITH {SQL_ANCHORS},
m AS (SELECT url, {MIXED_TARGET} AS target, pos FROM a),
f AS (SELECT url, target, min(pos) AS pos FROM m GROUP BY url, target)
SELECT url AS page_url, CAST(row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS BIGINT) AS ord, target AS target_url
FROM f""",
    "link_kinds": f"""
WITH {SQL_ANCHORS}
SELECT CASE lang WHEN 'en' THEN 'viewer' WHEN 'fr' THEN 'script' WHEN 'de' THEN 'frame' ELSE 'data' END AS kind,
  CAST(CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 25 ELSE 1 END AS INTEGER) AS rule_ord, CAST(count(*) AS BIGINT) AS links
FROM a GROUP BY ALL""",
    "link_classify_by_rule": f"""
WITH {SQL_ANCHORS},
s AS (SELECT target AS url, text FROM a UNION ALL SELECT url, '' FROM pages)
SELECT CAST(CASE WHEN contains(lower(text), 'tion') AND NOT contains(lower(text), 'ment') THEN 1
    WHEN contains(lower(text), 'en') AND NOT contains(lower(text), 'ou') AND NOT contains(lower(text), 'ch') THEN 2
    WHEN regexp_matches(url, '(?i)/[a-m][^/]*$') THEN 3
    WHEN contains(lower(url), '?utm_source') THEN 4
    WHEN contains(lower(url), '.html') THEN 5 ELSE 0 END AS INTEGER) AS rule_ord,
  CAST(count(*) AS BIGINT) AS links
FROM s GROUP BY 1""",
    "hidden_links": f"""
WITH {SQL_ANCHORS},
h AS (SELECT url, CASE lang WHEN 'de' THEN site || '/download' || href WHEN 'es' THEN folder || 'x/pdf' || href
    ELSE site || href || '.pdf' END AS target, lang FROM a)
SELECT DISTINCT url AS page_url, kind, target AS target_url FROM (
  SELECT url, target, 'hidden' AS kind FROM h WHERE lang IN ('en', 'fr')
  UNION ALL SELECT url, target, 'anchor' FROM h WHERE lang <> 'es'
  UNION ALL SELECT url, target, 'data' FROM h WHERE lang = 'es')""",
    "archive_year_links": f"""
WITH {SQL_ANCHORS},
h AS (SELECT url, text, CASE lang WHEN 'de' THEN '/2019' || href ELSE href END AS href, site, pos FROM a),
f AS (SELECT url, site || href AS target, min(pos) AS pos FROM h
  WHERE regexp_matches(lower(text) || ' ' || lower(href), '{"|".join(ARCHIVE_WORDS)}')
    OR regexp_matches(href, '\\b(19|20)\\d{{2}}\\b') OR regexp_matches(text, '\\b(19|20)\\d{{2}}\\b')
  GROUP BY url, site || href)
SELECT url AS page_url, CAST(row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS BIGINT) AS ord, target AS target_url
FROM f""".replace("\\\\", "\\"),
    "search_plan": f"""
WITH {SQL_PAGES},
t AS (SELECT unnest(['PDF', 'document', 'publication']) AS term)
SELECT url AS page_url, CAST(0 AS BIGINT) AS form_pos, term,
  CASE lang WHEN 'en' THEN 'post' ELSE 'get' END AS method,
  CASE lang WHEN 'en' THEN site || '/find' WHEN 'fr' THEN url ELSE folder || 'suche?x=1' END AS form_url,
  CASE lang WHEN 'en' THEN 'lang=en2&q=' || term WHEN 'fr' THEN 'mot=' || term ELSE 'suchquery=' || term END AS params
FROM p, t WHERE lang <> 'es'""",
    "search_result_links": f"""
WITH {SQL_ANCHORS}
SELECT page_url, target AS target_url FROM ({_SEARCH_HITS})""",
    "found_by_department": f"""
WITH {SQL_ANCHORS}
SELECT DISTINCT dept_key, target_url FROM (
  SELECT lang AS dept_key, {MIXED_TARGET} AS target_url FROM a
  UNION ALL SELECT lang, target FROM ({_SEARCH_HITS}))""",
    "script_weight": f"""
WITH {SQL_ANCHORS},
c AS (
  SELECT url, lower(CASE lang WHEN 'fr' THEN replace(html, '<p>', '<p onclick="go()">') ELSE html END) AS t FROM p),
n AS (
  SELECT url, len(string_split(t, '<script')) + len(string_split(t, 'javascript:')) + len(string_split(t, 'onclick='))
    + len(string_split(t, 'onload=')) - 4 AS signs FROM c),
k AS (
  SELECT url, count(DISTINCT target) AS documents FROM a
  WHERE contains(lower(text), 'tion') AND NOT contains(lower(text), 'ment') GROUP BY url)
SELECT n.url, CAST(signs AS BIGINT) AS script_signs, CAST(coalesce(documents, 0) AS BIGINT) AS document_count,
  signs > 10 AND coalesce(documents, 0) = 0 AS requires_browser
FROM n LEFT JOIN k ON n.url = k.url""",
    "site_profile": f"""
WITH {SQL_ANCHORS},
u AS (SELECT target AS url, host FROM a UNION ALL SELECT url, host FROM p),
x AS (SELECT url, host, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT host AS site, CASE WHEN contains(path, '.') THEN lower(regexp_extract(path, '\\.([^.]*)$', 1)) ELSE '' END AS extension,
  CAST(count(*) AS BIGINT) AS urls, CAST(count(*) FILTER (host <> '') AS BIGINT) AS valid,
  CAST(count(*) FILTER (host = '') AS BIGINT) AS invalid,
  CAST(count(*) FILTER (host LIKE '%example.com' OR host LIKE '%.org') AS BIGINT) AS government
FROM x GROUP BY 1, 2""".replace("\\\\", "\\"),
    "page_text_table": f"""
WITH {SQL_PAGES},
raw AS (
  SELECT url, regexp_extract(html, '<title[^>]*>([^<]*)', 1) AS title, regexp_replace(clean, '<[^>]*>', ' ', 'g') AS text FROM p),
one AS (
  SELECT url, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM raw),
done AS (
  SELECT url,
    replace(replace(replace(replace(replace(replace(title, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' ') AS title,
    replace(replace(replace(replace(replace(replace(text, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' ') AS text
  FROM one)
SELECT url, title, text, CAST(length(text) AS BIGINT) AS text_length FROM done""".replace("\\\\", "\\"),
    "markdown_seeds": f"""
WITH {_SEEDS},
f AS (SELECT dept_key, seed, min((file, seed_ord)) AS place, arg_min(host, (file, seed_ord)) AS name FROM s GROUP BY dept_key, seed)
SELECT dept_key, name, CAST(row_number() OVER (PARTITION BY dept_key ORDER BY place) - 1 AS BIGINT) AS seed_ord, seed AS url FROM f""",
    "markdown_departments": f"""
WITH {_SEEDS}
SELECT dept_key, max(host) AS name, CAST(3 AS INTEGER) AS max_depth, CAST(500 AS INTEGER) AS max_pages FROM s GROUP BY dept_key""",
    "sitemap_listing": f"""
WITH {SQL_PAGES},
k AS (SELECT *, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS rank FROM p),
f AS (SELECT host, min(rank) AS rank FROM k GROUP BY host)
SELECT DISTINCT k.host, url FROM k JOIN f ON k.host = f.host AND k.rank = f.rank WHERE lang <> 'de'""",
}
