"""Table schemas. State tables are read with these, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content_disposition", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("last_modified", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("error", T.StringType()),
        # How long the request took; NULL where it was not measured.
        T.StructField("duration_us", T.LongType()),
    ]
)

DEPARTMENTS = T.StructType(
    [
        T.StructField("dept_key", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("max_depth", T.IntegerType()),
        T.StructField("max_pages", T.IntegerType()),
    ]
)

SEEDS = T.StructType(
    [
        T.StructField("dept_key", T.StringType()),
        T.StructField("seed_ord", T.IntegerType()),
        T.StructField("url", T.StringType()),
    ]
)

ROBOTS_RULES = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("agent", T.StringType()),
        T.StructField("allow", T.BooleanType()),
        T.StructField("path_prefix", T.StringType()),
    ]
)

SITEMAPS = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("sitemap_url", T.StringType()),
        T.StructField("xml", T.StringType()),
    ]
)

BODIES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("body", T.BinaryType()),
    ]
)

DOC_CACHE = T.StructType(
    [
        T.StructField("url_hash", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("discovered_time", T.TimestampType()),
        T.StructField("source_page", T.StringType()),
        T.StructField("last_seen", T.TimestampType()),
    ]
)

PAGE_CACHE = T.StructType(
    [
        T.StructField("url_hash", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("last_crawled", T.TimestampType()),
        T.StructField("pdf_count", T.LongType()),
        T.StructField("crawl_count", T.LongType()),
    ]
)

FILE_REGISTRY = T.StructType(
    [
        T.StructField("url_hash", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("local_path", T.StringType()),
        T.StructField("download_time", T.TimestampType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("last_modified", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("content_length", T.LongType()),
    ]
)

FETCH_RESULT = T.StructType(
    [
        T.StructField("department", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("file_size", T.LongType()),
    ]
)

PROGRESS_EVENTS = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("department", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("file_size", T.LongType()),
    ]
)
