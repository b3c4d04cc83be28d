"""Tables, stand-ins for crawl inputs, and shared SQL."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.functions.url import authority

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
NOW_US = int(NOW.timestamp()) * 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str) -> Column:
    """Microseconds of the epoch of a zone-less timestamp, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({ts} as timestamp_ntz))")


def at(us: Column) -> Column:
    return F.timestamp_micros(us)


def us_of(ts: str) -> Column:
    return F.unix_micros(F.col(ts)).alias(f"{ts}_us")


def lang(url: Column) -> Column:
    """Language segment of a page's address, the stand-in for a department."""
    return F.regexp_extract(url, r"^https?://[^/]+/([a-z]{2})/", 1)


def marked_up(spark: SparkSession, sf_dir: str, pattern: str, forms: dict[str, str]) -> DataFrame:
    """Pages whose markup is rewritten by language, so that every link form occurs."""
    pages = table(spark, sf_dir, "pages")
    html = F.col("html")
    for code, form in forms.items():
        html = F.when(lang(F.col("url")) == code, F.regexp_replace("html", pattern, form)).otherwise(html)
    return pages.select("page_id", "url", html.alias("html"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests: domain, url, ts_us, event_type, value."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("host"), F.col("user_id").cast("string")).alias("domain"),
        F.concat(F.lit("https://host"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string")).alias("url"),
        micros("ts").alias("ts_us"),
        "event_type",
        "value",
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as download results: the source is the event type's first letter and the key in props."""
    rows = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    return rows.select(
        F.concat(F.lit("Department "), (F.col("user_id").cast("string"))).alias("department"),
        F.concat(F.lit("doc/"), F.col("event_id").cast("string")).alias("url"),
        (~failed).alias("success"),
        F.when(~failed, F.concat(F.lit("store/"), F.col("event_id").cast("string"))).alias("file_path"),
        F.when(failed, F.concat(F.lit("Network error: "), "props")).alias("error"),
        F.floor(F.col("value") * 100000).cast("long").alias("file_size"),
        (F.col("event_type") == "view").alias("skipped"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the label columns where there are any."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").withColumn("url", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")))


def links_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.withColumn("host", authority(F.col("url")))


# SQL shared by the checks -------------------------------------------------

SQL_PAGES = r"""
p AS (
  SELECT page_id, url, html,
    regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^(https?://[^/?#]*)', 1) AS site,
    regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang,
    regexp_extract(url, '^(https?://[^?#]*/)', 1) AS folder,
    regexp_replace(html, '<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'gis') AS clean
  FROM pages)"""

# One row per anchor of the given pages: href is root-relative there and text is plain.
SQL_ANCHORS = SQL_PAGES + r""",
a0 AS (
  SELECT page_id, url, host, site, lang, folder,
    unnest(regexp_extract_all(clean, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
    unnest(regexp_extract_all(clean, '<a href="([^"]*)">([^<]*)</a>', 2)) AS text,
    unnest(range(len(regexp_extract_all(clean, '<a href="([^"]*)">([^<]*)</a>', 1)))) AS pos
  FROM p),
a AS (SELECT *, site || href AS target FROM a0)"""

SQL_EVENTS = r"""
ev AS (
  SELECT event_id, 'host' || user_id AS domain, 'https://host' || user_id || '/' || event_id AS url,
    epoch_us(ts) AS ts_us, event_type, value
  FROM events)"""

SQL_RESULTS = r"""
r AS (
  SELECT 'Department ' || user_id AS department, 'doc/' || event_id AS url,
    event_type <> 'error' AS success,
    CASE WHEN event_type <> 'error' THEN 'store/' || event_id END AS file_path,
    CASE WHEN event_type = 'error' THEN 'Network error: ' || props END AS error,
    CAST(floor(value * 100000) AS BIGINT) AS file_size,
    event_type = 'view' AS skipped
  FROM events)"""

SQL_DOCUMENTS = r"""
d AS (
  SELECT documents.*, quality, toxic, 'doc/' || documents.doc_id AS url
  FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)"""
