"""Queries over state between runs: freshness, new documents, upserts, registry, validation, layout."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions.names import file_name
from crawlspark.operators import incremental, layout, validate
from crawlspark.operators.incremental import url_hash
from crawlspark.operators.links import page_links
from crawlspark.schemas import DOC_CACHE, FILE_REGISTRY, PAGE_CACHE
from crawlspark.session import checkpoint_root
from crawlspark.sources import buckets
from crawlspark.sources.sinks import save_documents
from crawlspark.sources.state import load_state, save_state
from workload.common import (
    NOW,
    NOW_US,
    SQL_ANCHORS,
    SQL_DOCUMENTS,
    SQL_EVENTS,
    SQL_PAGES,
    at,
    documents,
    events,
    lang,
    table,
    us_of,
)

DAY_US = 86_400_000_000
START_US = 1_704_067_200_000_000  # 2024-01-01


def doc_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents were seen before; when follows from their length and number."""
    docs = documents(spark, sf_dir).where(F.col("quality").isNotNull())
    found = F.lit(START_US) + F.col("n_chars") * 60_000_000
    return docs.select(
        url_hash(F.col("url")).alias("url_hash"),
        "url",
        at(found).alias("discovered_time"),
        F.col("source").alias("source_page"),
        at(found + F.col("doc_id") * 1_000_000).alias("last_seen"),
    )


def page_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts viewed: crawled at the last view, one crawl per view, documents by purchase."""
    per = events(spark, sf_dir).groupBy("domain").agg(
        F.max(F.when(F.col("event_type") == "view", F.col("ts_us"))).alias("us"),
        F.count_if(F.col("event_type") == "purchase").alias("pdf_count"),
        F.count_if(F.col("event_type") == "view").alias("crawl_count"),
    )
    url = F.concat(F.lit("https://"), "domain")
    return per.where(F.col("us").isNotNull()).select(
        url_hash(url).alias("url_hash"), url.alias("url"), at(F.col("us")).alias("last_crawled"), "pdf_count", "crawl_count"
    )


def stale_pages_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = events(spark, sf_dir).select(F.concat(F.lit("https://"), "domain").alias("url"), "event_id")
    return incremental.stale_pages_only(pages, page_cache(spark, sf_dir), NOW, 24)


def new_documents_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.new_documents_only(documents(spark, sf_dir).select("url"), doc_cache(spark, sf_dir))


def cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = documents(spark, sf_dir).where(F.col("lang").isin("de", "fr")).select("url", F.col("lang").alias("source_page"))
    state = incremental.upsert_documents(doc_cache(spark, sf_dir), seen, NOW)
    return state.select("url_hash", "url", us_of("discovered_time"), "source_page", us_of("last_seen"))


def page_cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawled = events(spark, sf_dir).where(F.col("event_type") == "signup").groupBy("domain").agg(
        F.count("*").alias("pdf_count")
    ).select(F.concat(F.lit("https://"), "domain").alias("url"), "pdf_count")
    state = incremental.upsert_pages(page_cache(spark, sf_dir), crawled, NOW)
    return state.select("url_hash", "url", us_of("last_crawled"), "pdf_count", "crawl_count")


def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.cache_stats(doc_cache(spark, sf_dir), page_cache(spark, sf_dir), NOW)


def cache_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.expired_counts(doc_cache(spark, sf_dir), page_cache(spark, sf_dir), NOW, 20)


def cache_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = incremental.drop_expired(doc_cache(spark, sf_dir), "last_seen", NOW, 20)
    return kept.select("url_hash", "url", us_of("last_seen"))


def _path(doc_id: Column) -> Column:
    return F.concat(F.lit("store/"), doc_id.cast("string"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-German documents are registered with the hash of their text."""
    docs = documents(spark, sf_dir).where(F.col("lang") != "de")
    return docs.select(
        url_hash(F.col("url")).alias("url_hash"),
        "url",
        _path(F.col("doc_id")).alias("local_path"),
        at(F.lit(START_US) + F.col("doc_id") * 1_000_000).alias("download_time"),
        F.col("n_chars").alias("file_size"),
        F.sha2("text", 256).alias("file_hash"),
        F.when(F.col("lang") != "fr", F.lit("Mon")).alias("last_modified"),
        F.md5("text").alias("etag"),
        F.col("n_chars").alias("content_length"),
    )


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers for documents: good ones 200, bad ones 404, unlabelled ones none; toxic ones have changed."""
    docs = documents(spark, sf_dir).where(F.col("quality").isNotNull())
    return docs.select(
        "url",
        F.lit("HEAD").alias("method"),
        at(F.lit(START_US) + F.col("n_chars") * 1_000_000).alias("ts"),
        F.lit(1).alias("attempt"),
        F.when(F.col("quality") == 1, F.lit(200)).otherwise(F.lit(404)).alias("status"),
        F.when(F.col("lang") == "fr", F.lit("Application/PDF; v=1"))
        .when(F.col("lang") == "de", F.lit("application/octet-stream"))
        .otherwise(F.lit("text/html"))
        .alias("content_type"),
        F.when(F.col("lang") == "es", F.lit('attachment; filename="X.PDF"')).alias("content_disposition"),
        F.when(F.col("toxic") == 1, F.md5(F.reverse("text"))).otherwise(F.md5("text")).alias("etag"),
        F.when(F.col("lang") != "fr", F.lit("Mon")).alias("last_modified"),
        (F.col("n_chars") * 16384).alias("content_length"),
        F.lit(None).cast("string").alias("error"),
    )


def change_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    candidates = docs.select("url", _path(F.col("doc_id")).alias("local_path"))
    stored = docs.where(F.col("source") != "src3").select(_path(F.col("doc_id")).alias("local_path"))
    return incremental.change_decision(candidates, stored, registry(spark, sf_dir), heads(spark, sf_dir))


def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).where((F.col("lang") == "de") | (F.col("toxic") == 1))
    downloads = docs.select(
        "url", F.concat(F.lit("new/"), F.col("doc_id").cast("string")).alias("local_path"), F.encode("text", "UTF-8").alias("body")
    )
    state = incremental.upsert_registry(registry(spark, sf_dir), downloads, heads(spark, sf_dir), NOW)
    return state.select(
        "url_hash", "url", "local_path", us_of("download_time"), "file_size", "file_hash", "last_modified", "etag", "content_length"
    )


def registry_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.registry_stats(registry(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of labelled documents; toxic ones are empty."""
    docs = documents(spark, sf_dir).where(F.col("quality").isNotNull())
    return docs.select(
        _path(F.col("doc_id")).alias("local_path"), F.when(F.col("toxic") == 1, F.lit(0)).otherwise(F.col("n_chars")).alias("file_size")
    )


def stored_already(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = documents(spark, sf_dir).select("url", _path(F.col("doc_id")).alias("local_path"))
    return incremental.stored_already(candidates, _stored(spark, sf_dir))


def not_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = documents(spark, sf_dir).select("url", _path(F.col("doc_id")).alias("local_path"))
    return incremental.not_stored(candidates, _stored(spark, sf_dir))


def candidate_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as addresses of every kind the checks tell apart."""
    docs = documents(spark, sf_dir)
    tail = (
        F.when(F.col("source") == "src1", F.lit(".PDF"))
        .when(F.col("source") == "src2", F.lit(".pdf?X-Amz-Signature=1"))
        .otherwise(F.lit(""))
    )
    return docs.select(F.concat("url", tail).alias("url"), F.col("url").alias("old_url"), F.col("source").alias("department"))


def _renamed_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = candidate_urls(spark, sf_dir).select("old_url", F.col("url").alias("new_url"))
    log = heads(spark, sf_dir).withColumnRenamed("url", "old_url")
    return log.join(names, "old_url").drop("old_url").withColumnRenamed("new_url", "url")


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as files: English ones complete, German ones without a trailer, the rest plain text."""
    docs = documents(spark, sf_dir)
    body = (
        F.when(F.col("lang") == "en", F.concat(F.lit("%PDF-1.7"), "text", F.lit("%%EOF")))
        .when(F.col("lang") == "de", F.concat(F.lit("%PDF-"), "text"))
        .otherwise(F.col("text"))
    )
    return docs.select("url", F.encode(body, "UTF-8").alias("body"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = candidate_urls(spark, sf_dir).select("url")
    return validate.url_verdicts(candidates, incremental.latest_by_url(_renamed_heads(spark, sf_dir), "HEAD"))


def sniffed_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = documents(spark, sf_dir).select("url")
    return validate.sniffed_verdicts(candidates, heads(spark, sf_dir), bodies(spark, sf_dir))


def content_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.content_checks(bodies(spark, sf_dir), min_bytes=400)


def content_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.content_summary(validate.content_checks(bodies(spark, sf_dir), min_bytes=400))


def oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.oversized(heads(spark, sf_dir), 20)


def download_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    candidates = docs.select(F.col("source").alias("department"), "url", _path(F.col("doc_id")).alias("local_path"))
    log = heads(spark, sf_dir)
    gets = log.withColumn("error", F.when(F.col("content_type") == "text/html", F.lit("timeout"))).withColumn(
        "status", F.when(F.col("error").isNull(), F.col("status"))
    )
    stored = _stored(spark, sf_dir)
    decisions = incremental.change_decision(candidates.select("url", "local_path"), stored, registry(spark, sf_dir), log)
    verdicts = validate.sniffed_verdicts(candidates, log, bodies(spark, sf_dir))
    unsaved = docs.where(F.col("source") == "src5").select("url")
    return validate.download_outcome(
        candidates, decisions, verdicts, gets, validate.content_checks(bodies(spark, sf_dir)), stored, unsaved, 20
    )


def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as departments, their suppliers as seeds; nations of region 2 have no name."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("dept_key"), F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("name")
    )
    seeds = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("dept_key"), F.col("s_name").alias("url")
    )
    return validate.config_violations(nations, seeds)


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = page_links(pages).select("page_url", F.col("target_url").alias("url"))
    everything = found.unionByName(pages.select(F.col("url").alias("page_url"), "url"))
    return everything.select("url", F.concat(F.lit("Dept. of "), lang(F.col("page_url")), F.lit(" (X) - y")).alias("department")).distinct()


def file_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.with_layout(_targets(spark, sf_dir), "/data", "/run/")


def path_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.path_collisions(layout.with_layout(_targets(spark, sf_dir), "/data"))


def _title(html: Column) -> Column:
    return F.regexp_extract(html, r"<title>([^<]*)", 1)


def portable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "pages").select(F.concat(_title(F.col("html")), F.lit(".pdf")).alias("name"))
    return layout.changed_names(names)


def titled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("url", file_name(F.col("url"), _title(F.col("html"))).alias("file_name"))


def content_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.content_duplicates(registry(spark, sf_dir))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/crawlspark/{name}-{uuid.uuid4().hex}"


def state_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document cache saved, upserted and saved again; the last complete version is read."""
    folder = _folder(spark, "doc-cache")
    save_state(doc_cache(spark, sf_dir), folder)
    seen = documents(spark, sf_dir).where(F.col("lang") == "es").select("url", F.col("lang").alias("source_page"))
    save_state(incremental.upsert_documents(load_state(spark, folder, DOC_CACHE), seen, NOW), folder)
    return load_state(spark, folder, DOC_CACHE).select("url", us_of("discovered_time"), us_of("last_seen"))


def cache_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document cache in buckets: saved, and merged with what a run has seen."""
    folder = _folder(spark, "doc-buckets")
    _first_version(spark, folder, DOC_CACHE, doc_cache(spark, sf_dir))
    seen = documents(spark, sf_dir).where(F.col("lang").isin("de", "fr")).select("url", F.col("lang").alias("source_page"))
    buckets.merge_buckets(spark, folder, DOC_CACHE, seen, lambda rows, new: incremental.upsert_documents(rows, new, NOW))
    state = buckets.load_buckets(spark, folder, DOC_CACHE)
    return state.select("url_hash", "url", us_of("discovered_time"), "source_page", us_of("last_seen"))


def page_cache_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "page-buckets")
    _first_version(spark, folder, PAGE_CACHE, page_cache(spark, sf_dir))
    crawled = events(spark, sf_dir).where(F.col("event_type") == "signup").groupBy("domain").agg(
        F.count("*").alias("pdf_count")
    ).select(F.concat(F.lit("https://"), "domain").alias("url"), "pdf_count")
    buckets.merge_buckets(spark, folder, PAGE_CACHE, crawled, lambda rows, new: incremental.upsert_pages(rows, new, NOW))
    state = buckets.load_buckets(spark, folder, PAGE_CACHE)
    return state.select("url_hash", "url", us_of("last_crawled"), "pdf_count", "crawl_count")


def registry_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "registry-buckets")
    _first_version(spark, folder, FILE_REGISTRY, registry(spark, sf_dir))
    docs = documents(spark, sf_dir).where((F.col("lang") == "de") | (F.col("toxic") == 1))
    files = docs.select(
        "url",
        F.concat(F.lit("new/"), F.col("doc_id").cast("string")).alias("local_path"),
        F.octet_length("text").cast("long").alias("file_size"),
        F.sha2("text", 256).alias("file_hash"),
    )
    answers = heads(spark, sf_dir)
    buckets.merge_buckets(
        spark, folder, FILE_REGISTRY, files, lambda rows, new: incremental.upsert_registry_files(rows, new, answers, NOW)
    )
    return buckets.load_buckets(spark, folder, FILE_REGISTRY).select(
        "url_hash", "url", "local_path", us_of("download_time"), "file_size", "file_hash", "last_modified", "etag", "content_length"
    )


def _first_version(spark: SparkSession, folder: str, schema: T.StructType, rows: DataFrame) -> None:
    buckets.merge_buckets(spark, folder, schema, rows, lambda _, new: new)


def live_state_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left on disk after two runs and pruning: rows per bucket, in the run whose files hold it.

    The second run sees the documents that are labelled as toxic.
    """
    folder = _folder(spark, "live-buckets")
    _first_version(spark, folder, DOC_CACHE, doc_cache(spark, sf_dir))
    seen = documents(spark, sf_dir).where("toxic = 1").select("url", F.col("lang").alias("source_page"))
    buckets.merge_buckets(spark, folder, DOC_CACHE, seen, lambda rows, new: incremental.upsert_documents(rows, new, NOW))
    buckets.prune_buckets(spark, folder, keep=1)
    # Read by its files, not by its manifest.
    return spark.read.parquet(f"{folder}/data").groupBy(F.col("bucket").cast("string").alias("bucket"), "version").agg(
        F.count("*").alias("documents")
    ).select("bucket", F.col("version").cast("long").alias("version"), "documents")


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored by department directory and read back."""
    folder = _folder(spark, "documents")
    docs = documents(spark, sf_dir)
    files = docs.select("url", F.encode("text", "UTF-8").alias("body"))
    placed = layout.with_layout(docs.select("url", F.col("source").alias("department")), prefix="run")
    save_documents(files, placed, folder)
    return spark.read.parquet(folder).select(
        "url", "dept_dir", "file_name", "s3_key", F.sha2("body", 256).alias("file_hash")
    )


QUERIES = {
    "state_versions": state_versions,
    "cache_upsert_buckets": cache_upsert_buckets,
    "page_cache_upsert_buckets": page_cache_upsert_buckets,
    "registry_upsert_buckets": registry_upsert_buckets,
    "live_state_files": live_state_files,
    "stored_documents": stored_documents,
    "stale_pages_only": stale_pages_only,
    "new_documents_only": new_documents_only,
    "cache_upsert": cache_upsert,
    "page_cache_upsert": page_cache_upsert,
    "cache_stats": cache_stats,
    "cache_retention": cache_retention,
    "cache_kept": cache_kept,
    "change_decision": change_decision,
    "registry_upsert": registry_upsert,
    "registry_stats": registry_stats,
    "stored_already": stored_already,
    "not_stored": not_stored,
    "url_verdicts": url_verdicts,
    "sniffed_verdicts": sniffed_verdicts,
    "content_checks": content_checks,
    "content_summary": content_summary,
    "oversized": oversized,
    "download_outcome": download_outcome,
    "config_violations": config_violations,
    "file_layout": file_layout,
    "path_collisions": path_collisions,
    "portable_names": portable_names,
    "titled_names": titled_names,
    "content_duplicates": content_duplicates,
}

_DOC_CACHE = (
    SQL_DOCUMENTS
    + f""",
dc AS (
  SELECT md5(url) AS url_hash, url, {START_US} + n_chars * 60000000 AS found_us, source,
    {START_US} + n_chars * 60000000 + doc_id * 1000000 AS seen_us
  FROM d WHERE quality IS NOT NULL)"""
)
_PAGE_CACHE = (
    SQL_EVENTS
    + """,
pc AS (
  SELECT 'https://' || domain AS url, max(ts_us) FILTER (event_type = 'view') AS us,
    count(*) FILTER (event_type = 'purchase') AS pdf_count, count(*) FILTER (event_type = 'view') AS crawl_count
  FROM ev GROUP BY domain HAVING us IS NOT NULL)"""
)
_REGISTRY = (
    SQL_DOCUMENTS
    + f""",
reg AS (
  SELECT url, 'store/' || doc_id AS local_path, {START_US} + doc_id * 1000000 AS us, n_chars AS file_size, sha256(text) AS file_hash,
    CASE WHEN lang <> 'fr' THEN 'Mon' END AS last_modified, md5(text) AS etag, n_chars AS content_length
  FROM d WHERE lang <> 'de'),
hd AS (
  SELECT url, CASE WHEN quality = 1 THEN 200 ELSE 404 END AS status,
    CASE lang WHEN 'fr' THEN 'application/pdf; v=1' WHEN 'de' THEN 'application/octet-stream' ELSE 'text/html' END AS content_type,
    lang = 'es' AS named, CASE WHEN toxic = 1 THEN md5(reverse(text)) ELSE md5(text) END AS etag,
    CASE WHEN lang <> 'fr' THEN 'Mon' END AS last_modified, n_chars * 16384 AS content_length
  FROM d WHERE quality IS NOT NULL)"""
)
_DECISION = """
dec AS (
  SELECT d.url, 'store/' || doc_id AS local_path,
    CASE WHEN NOT ({stored}) THEN 'not stored' WHEN reg.url IS NULL THEN 'not registered'
      WHEN hd.status = 200 AND (hd.etag IS DISTINCT FROM reg.etag OR hd.last_modified IS DISTINCT FROM reg.last_modified) THEN 'changed'
      ELSE 'unchanged' END AS reason
  FROM d LEFT JOIN reg ON d.url = reg.url LEFT JOIN hd ON d.url = hd.url)"""
# The trailer is plain text, so looking for it among the last characters and then
# by its distance from the end in bytes is the same as cutting bytes.
_BODIES = """
b AS (
  SELECT url, lang, CASE lang WHEN 'en' THEN '%PDF-1.7' || text || '%%EOF' WHEN 'de' THEN '%PDF-' || text ELSE text END AS body FROM d),
cc AS (
  SELECT url, CAST(strlen(body) AS BIGINT) AS bytes, sha256(body) AS file_hash,
    CASE WHEN strlen(body) = 0 THEN 'empty' WHEN NOT starts_with(body, '%PDF-') THEN 'wrong header'
      WHEN strlen(body) < {least} THEN 'too short' ELSE 'ok' END AS reason,
    contains(body, '%%EOF') AND strlen(regexp_extract(body, '(?s)(%%EOF(?:[^%]|%[^%]|%%[^E])*)$', 1)) BETWEEN 1 AND 1024 AS has_trailer
  FROM b)"""
_SNIFF = """
sv AS (
  SELECT d.url, CASE WHEN hd.status IS NULL THEN 'no answer' WHEN hd.status <> 200 THEN 'bad status'
      WHEN contains(hd.content_type, 'application/pdf') THEN 'content type' WHEN hd.named THEN 'disposition'
      WHEN hd.content_type IN ('', 'application/octet-stream') AND starts_with(b.body, '%PDF') THEN 'signature'
      ELSE 'not a document' END AS verdict
  FROM d LEFT JOIN hd ON d.url = hd.url LEFT JOIN b ON d.url = b.url)"""
_TARGETS = (
    SQL_ANCHORS
    + r""",
u AS (
  SELECT DISTINCT url, 'Dept. of ' || lang || ' (X) - y' AS department, 'Dept-of-' || lang || '-X-y' AS folder_name
  FROM (SELECT target AS url, lang FROM a UNION ALL SELECT url, lang FROM p)),
q AS (
  SELECT *, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM u),
l AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS last, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM q),
src AS (
  SELECT *, CASE WHEN last <> '' THEN last WHEN len(parts) > 0 THEN replace(host, 'www.', '') || '-' || array_to_string(parts[-2:], '-')
    ELSE replace(host, 'www.', '') || '-document' END AS whole FROM l),
cl AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(whole, '^(\.*[^.].*)\.[^.]*$', '\1'), '[^\p{L}\p{N}_\s-]', '', 'g'), '[-\s]+', '-', 'g'), '-') AS clean
  FROM src),
named AS (SELECT url, department, folder_name, left(CASE WHEN clean = '' THEN 'document-' || md5(url) ELSE clean END, 100) || '.pdf' AS file_name FROM cl)"""
)
_TITLES = SQL_PAGES + r""",
t AS (SELECT url, regexp_extract(html, '<title>([^<]*)', 1) AS title FROM p)"""

SQL = {
    "state_versions": f"""
WITH {_DOC_CACHE},
n AS (SELECT url FROM d WHERE lang = 'es')
SELECT coalesce(dc.url, n.url) AS url, CAST(coalesce(found_us, {NOW_US}) AS BIGINT) AS discovered_time_us,
  CAST(CASE WHEN n.url IS NOT NULL THEN {NOW_US} ELSE seen_us END AS BIGINT) AS last_seen_us
FROM dc FULL JOIN n ON dc.url = n.url""",
    "live_state_files": f"""
WITH {_DOC_CACHE},
t AS (SELECT url, substr(md5(url), 1, 2) AS bucket FROM d WHERE toxic = 1),
a AS (SELECT url, substr(md5(url), 1, 2) AS bucket FROM dc UNION SELECT url, bucket FROM t)
SELECT bucket, CAST(CASE WHEN bucket IN (SELECT bucket FROM t) THEN 1 ELSE 0 END AS BIGINT) AS version, CAST(count(*) AS BIGINT) AS documents
FROM a GROUP BY bucket""",
    "stored_documents": f"""
WITH {SQL_DOCUMENTS}
SELECT url, source AS dept_dir, doc_id || '.pdf' AS file_name, 'run/' || source || '/' || doc_id || '.pdf' AS s3_key,
  sha256(text) AS file_hash FROM d""",
    "stale_pages_only": f"""
WITH {_PAGE_CACHE}
SELECT 'https://' || domain AS url, event_id FROM ev
WHERE NOT EXISTS (SELECT 1 FROM pc WHERE pc.url = 'https://' || ev.domain AND {NOW_US} - pc.us < {DAY_US})""",
    "new_documents_only": f"""
WITH {_DOC_CACHE}
SELECT url FROM d WHERE NOT EXISTS (SELECT 1 FROM dc WHERE dc.url_hash = md5(d.url))""",
    "cache_upsert": f"""
WITH {_DOC_CACHE},
n AS (SELECT url, lang FROM d WHERE lang IN ('de', 'fr'))
SELECT md5(coalesce(dc.url, n.url)) AS url_hash, coalesce(dc.url, n.url) AS url,
  CAST(coalesce(found_us, {NOW_US}) AS BIGINT) AS discovered_time_us, coalesce(source, lang) AS source_page,
  CAST(CASE WHEN n.url IS NOT NULL THEN {NOW_US} ELSE seen_us END AS BIGINT) AS last_seen_us
FROM dc FULL JOIN n ON dc.url = n.url""",
    "page_cache_upsert": f"""
WITH {_PAGE_CACHE},
n AS (SELECT 'https://' || domain AS url, count(*) AS pdf_count FROM ev WHERE event_type = 'signup' GROUP BY domain)
SELECT md5(coalesce(pc.url, n.url)) AS url_hash, coalesce(pc.url, n.url) AS url,
  CAST(CASE WHEN n.url IS NOT NULL THEN {NOW_US} ELSE us END AS BIGINT) AS last_crawled_us,
  CAST(coalesce(n.pdf_count, pc.pdf_count) AS BIGINT) AS pdf_count,
  CAST(coalesce(crawl_count, 0) + CASE WHEN n.url IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS crawl_count
FROM pc FULL JOIN n ON pc.url = n.url""",
    "cache_stats": f"""
WITH {_DOC_CACHE}, {_PAGE_CACHE}
SELECT CAST((SELECT count(*) FROM dc) AS BIGINT) AS total_cached_documents,
  CAST((SELECT count(*) FROM dc WHERE {NOW_US} - seen_us < {DAY_US}) AS BIGINT) AS recent_documents,
  CAST((SELECT count(*) FROM pc) AS BIGINT) AS total_cached_pages,
  CAST((SELECT count(*) FROM pc WHERE {NOW_US} - us < {DAY_US}) AS BIGINT) AS recent_pages,
  (SELECT coalesce(CAST({NOW_US} - min(found_us) AS DOUBLE) / 3.6e9, 0.0) FROM dc) AS cache_age_hours""",
    "cache_retention": f"""
WITH {_DOC_CACHE}, {_PAGE_CACHE}
SELECT CAST((SELECT count(*) FROM dc WHERE {NOW_US} - seen_us > {20 * DAY_US}) AS BIGINT) AS removed_documents,
  CAST((SELECT count(*) FROM pc WHERE {NOW_US} - us > {20 * DAY_US}) AS BIGINT) AS removed_pages""",
    "cache_kept": f"""
WITH {_DOC_CACHE}
SELECT url_hash, url, CAST(seen_us AS BIGINT) AS last_seen_us FROM dc WHERE {NOW_US} - seen_us <= {20 * DAY_US}""",
    "change_decision": f"""
WITH {_REGISTRY}, {_DECISION.format(stored="d.source <> 'src3'")}
SELECT url, local_path, reason, reason <> 'unchanged' AS download FROM dec""",
    "registry_upsert": f"""
WITH {_REGISTRY},
n AS (
  SELECT d.url, 'new/' || doc_id AS local_path, strlen(text) AS file_size, sha256(text) AS file_hash, hd.last_modified, hd.etag, hd.content_length
  FROM d LEFT JOIN hd ON d.url = hd.url AND hd.status = 200 WHERE lang = 'de' OR toxic = 1)
SELECT md5(url) AS url_hash, url, local_path, CAST({NOW_US} AS BIGINT) AS download_time_us, CAST(file_size AS BIGINT) AS file_size,
  file_hash, last_modified, etag, CAST(content_length AS BIGINT) AS content_length FROM n
UNION ALL
SELECT md5(url), url, local_path, us, file_size, file_hash, last_modified, etag, content_length FROM reg
WHERE url NOT IN (SELECT url FROM n)""",
    "registry_stats": f"""
WITH {_REGISTRY}
SELECT CAST(count(*) AS BIGINT) AS total_files, CAST(sum(file_size) AS BIGINT) AS total_size,
  CAST(sum(file_size) AS DOUBLE) / 1048576.0 AS total_size_mb FROM reg""",
    "stored_already": f"""
WITH {SQL_DOCUMENTS}
SELECT url, 'store/' || doc_id AS local_path, n_chars AS file_size FROM d WHERE quality IS NOT NULL AND toxic <> 1 AND n_chars > 0""",
    "not_stored": f"""
WITH {SQL_DOCUMENTS}
SELECT url, 'store/' || doc_id AS local_path FROM d WHERE quality IS NULL OR toxic = 1 OR n_chars = 0""",
    "url_verdicts": f"""
WITH {_REGISTRY},
v AS (
  SELECT d.url || CASE source WHEN 'src1' THEN '.PDF' WHEN 'src2' THEN '.pdf?X-Amz-Signature=1' ELSE '' END AS url,
    CASE WHEN source = 'src2' THEN 'signed' WHEN hd.status IS NULL THEN 'no answer' WHEN hd.status <> 200 THEN 'bad status'
      WHEN contains(hd.content_type, 'application/pdf') THEN 'content type' WHEN source = 'src1' THEN 'url ending'
      WHEN hd.named THEN 'disposition' ELSE 'not a document' END AS verdict
  FROM d LEFT JOIN hd ON d.url = hd.url)
SELECT url, verdict, verdict IN ('signed', 'content type', 'url ending', 'disposition') AS valid FROM v""",
    "sniffed_verdicts": f"""
WITH {_REGISTRY}, {_BODIES.format(least=100)}, {_SNIFF}
SELECT url, verdict, verdict IN ('content type', 'disposition', 'signature') AS valid FROM sv""",
    "content_checks": f"""
WITH {SQL_DOCUMENTS}, {_BODIES.format(least=400)}
SELECT url, bytes, file_hash, reason, has_trailer, reason = 'ok' AS valid FROM cc""",
    "content_summary": f"""
WITH {SQL_DOCUMENTS}, {_BODIES.format(least=400)}
SELECT reason, CAST(count(*) AS BIGINT) AS bodies, CAST(sum(bytes) AS BIGINT) AS bytes,
  CAST(count(*) FILTER (NOT has_trailer) AS BIGINT) AS without_trailer FROM cc GROUP BY reason""",
    "oversized": f"""
WITH {_REGISTRY}
SELECT url, CAST(content_length AS BIGINT) AS content_length,
  'File too large (' || format('{{:.1f}}', content_length / 1048576.0) || 'MB), skipping' AS error
FROM hd WHERE content_length / 1048576.0 > 20""",
    "download_outcome": f"""
WITH {_REGISTRY}, {_DECISION.format(stored="quality IS NOT NULL")}, {_BODIES.format(least=100)}, {_SNIFF},
o AS (
  SELECT d.source AS department, d.url, dec.local_path, dec.reason = 'unchanged' AS skip, cc.bytes,
    CASE WHEN toxic = 1 THEN 0 ELSE n_chars END AS stored_size,
    CASE WHEN dec.reason = 'unchanged' THEN NULL
      WHEN sv.verdict NOT IN ('content type', 'disposition', 'signature') THEN 'URL does not point to a valid PDF file'
      WHEN hd.content_type = 'text/html' THEN 'Network error: timeout'
      WHEN hd.status <> 200 THEN 'Network error: HTTP ' || hd.status
      WHEN hd.content_length / 1048576.0 > 20 THEN 'File too large (' || format('{{:.1f}}', hd.content_length / 1048576.0) || 'MB), skipping'
      WHEN cc.reason <> 'ok' THEN 'Downloaded content is not a valid PDF file'
      WHEN d.source = 'src5' THEN 'Failed to save file locally' END AS error
  FROM d JOIN dec ON d.url = dec.url JOIN cc ON d.url = cc.url JOIN sv ON d.url = sv.url LEFT JOIN hd ON d.url = hd.url)
SELECT department, url, error IS NULL AS success, CASE WHEN error IS NULL THEN local_path END AS file_path, error,
  CAST(CASE WHEN error IS NOT NULL THEN 0 WHEN skip THEN stored_size ELSE bytes END AS BIGINT) AS file_size,
  error IS NULL AND skip AS skipped FROM o""",
    "config_violations": """
SELECT CAST(n_nationkey AS VARCHAR) AS dept_key, 'department has no name' AS violation FROM nation WHERE n_regionkey = 2
UNION ALL
SELECT CAST(n_nationkey AS VARCHAR), 'department has no seed url' FROM nation
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)""",
    "file_layout": f"""
WITH {_TARGETS}
SELECT url, department, file_name, '/data/' || folder_name || '/' || file_name AS local_path,
  'run/' || folder_name || '/' || file_name AS s3_key FROM named""",
    "path_collisions": f"""
WITH {_TARGETS}
SELECT '/data/' || folder_name || '/' || file_name AS local_path, CAST(count(DISTINCT url) AS BIGINT) AS urls, min(url) AS first_url
FROM named GROUP BY 1 HAVING count(DISTINCT url) > 1""",
    "portable_names": f"""
WITH {_TITLES},
n AS (SELECT DISTINCT title || '.pdf' AS name FROM t),
s0 AS (
  SELECT name, trim(regexp_replace(regexp_replace(regexp_replace(name, '[<>:"/\\\\|?*]', '_', 'g'), '[\\x00-\\x1f\\x7f-\\x9f]', '', 'g'), '[_\\s]+', '_', 'g'), ' .') AS portable
  FROM n),
s AS (
  SELECT name, CASE WHEN regexp_matches(upper(split_part(portable, '.', 1)), '^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$') THEN '_' || portable
    ELSE portable END AS portable FROM s0),
c AS (SELECT portable, count(*) AS sharing FROM s GROUP BY portable)
SELECT s.name, s.portable, CAST(c.sharing AS BIGINT) AS sharing FROM s JOIN c ON s.portable = c.portable WHERE s.name <> s.portable""",
    "titled_names": f"""
WITH {_TITLES},
c AS (SELECT url, trim(regexp_replace(regexp_replace(title, '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g'), '[-\\s]+', '-', 'g'), '-') AS clean FROM t)
SELECT url, left(CASE WHEN clean = '' THEN 'document-' || md5(url) ELSE clean END, 100) || '.pdf' AS file_name FROM c""",
    "content_duplicates": f"""
WITH {_REGISTRY}
SELECT file_hash, CAST(count(*) AS BIGINT) AS copies, min(url) AS first_url, CAST(sum(file_size) - max(file_size) AS BIGINT) AS wasted_bytes
FROM reg GROUP BY file_hash HAVING count(*) > 1""",
}

# The state in buckets has the rows that the state as a whole has.
for _name in ("cache_upsert", "page_cache_upsert", "registry_upsert"):
    SQL[f"{_name}_buckets"] = SQL[_name]
