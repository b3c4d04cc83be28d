"""State between runs: caches of documents and pages, and the file registry.

Keys are md5 of the URL. Incoming rows are made unique per key first (copies
collapse before the shuffle), so each join meets one row per key on either side.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.operators.lookup import join_lookup

DAY_SECONDS = 86_400


def url_hash(url: Column) -> Column:
    return F.md5(url)


def _now(now: datetime) -> Column:
    return F.lit(now).cast("timestamp")


def _age_us(now: datetime, since: Column) -> Column:
    return F.unix_micros(_now(now)) - F.unix_micros(since)


def stale_pages_only(pages: DataFrame, page_cache: DataFrame, now: datetime, max_age_hours: float = 24) -> DataFrame:
    """Pages (url, ...) not crawled less than ``max_age_hours`` ago; unknown pages stay."""
    limit_us = int(max_age_hours * 3600 * 1_000_000)
    fresh = page_cache.where(_age_us(now, F.col("last_crawled")) < limit_us).select("url_hash")
    return (
        pages.withColumn("url_hash", url_hash(F.col("url"))).join(fresh, "url_hash", "left_anti").drop("url_hash")
    )


def new_documents_only(documents: DataFrame, doc_cache: DataFrame) -> DataFrame:
    """Documents (url, ...) whose url is not in the cache."""
    return (
        documents.withColumn("url_hash", url_hash(F.col("url")))
        .join(doc_cache.select("url_hash"), "url_hash", "left_anti")
        .drop("url_hash")
    )


def upsert_documents(doc_cache: DataFrame, seen: DataFrame, now: datetime) -> DataFrame:
    """Document cache after a run that saw ``seen`` (url, source_page).

    New documents are discovered now; known ones only get a new last_seen.
    """
    incoming = seen.groupBy("url").agg(F.min("source_page").alias("new_source")).select(
        url_hash(F.col("url")).alias("url_hash"), F.col("url").alias("new_url"), "new_source", F.lit(True).alias("is_seen")
    )
    joined = doc_cache.join(incoming, "url_hash", "full_outer")
    return joined.select(
        "url_hash",
        F.coalesce("url", "new_url").alias("url"),
        F.coalesce(F.col("discovered_time"), _now(now)).alias("discovered_time"),
        F.coalesce("source_page", "new_source").alias("source_page"),
        F.when(F.col("is_seen"), _now(now)).otherwise(F.col("last_seen")).alias("last_seen"),
    )


def upsert_pages(page_cache: DataFrame, crawled: DataFrame, now: datetime) -> DataFrame:
    """Page cache after a run that crawled ``crawled`` (url, pdf_count)."""
    incoming = crawled.groupBy("url").agg(F.max("pdf_count").cast("long").alias("new_count")).select(
        url_hash(F.col("url")).alias("url_hash"), F.col("url").alias("new_url"), "new_count", F.lit(True).alias("is_crawled")
    )
    joined = page_cache.join(incoming, "url_hash", "full_outer")
    crawled_now = F.coalesce(F.col("is_crawled"), F.lit(False))
    return joined.select(
        "url_hash",
        F.coalesce("url", "new_url").alias("url"),
        F.when(crawled_now, _now(now)).otherwise(F.col("last_crawled")).alias("last_crawled"),
        F.when(crawled_now, F.col("new_count")).otherwise(F.col("pdf_count")).alias("pdf_count"),
        (F.coalesce("crawl_count", F.lit(0)) + crawled_now.cast("long")).cast("long").alias("crawl_count"),
    )


def cache_stats(doc_cache: DataFrame, page_cache: DataFrame, now: datetime) -> DataFrame:
    """One row: totals, entries of the last day, hours since the oldest discovery."""
    day_us = DAY_SECONDS * 1_000_000
    documents = doc_cache.agg(
        F.count("*").alias("total_cached_documents"),
        F.count_if(_age_us(now, F.col("last_seen")) < day_us).alias("recent_documents"),
        F.coalesce(_age_us(now, F.min("discovered_time")).cast("double") / 3.6e9, F.lit(0.0)).alias("cache_age_hours"),
    )
    pages = page_cache.agg(
        F.count("*").alias("total_cached_pages"),
        F.count_if(_age_us(now, F.col("last_crawled")) < day_us).alias("recent_pages"),
    )
    # One row on either side.
    return documents.join(F.broadcast(pages), F.lit(True))


def _expired(since: str, now: datetime, max_age_days: int) -> Column:
    return _age_us(now, F.col(since)) > max_age_days * DAY_SECONDS * 1_000_000


def drop_expired(state: DataFrame, since: str, now: datetime, max_age_days: int = 30) -> DataFrame:
    """State rows that are not older than ``max_age_days`` by column ``since``."""
    return state.where(~F.coalesce(_expired(since, now, max_age_days), F.lit(True)))


def expired_counts(doc_cache: DataFrame, page_cache: DataFrame, now: datetime, max_age_days: int = 30) -> DataFrame:
    """One row: how many documents and pages retention removes."""
    def removed(since: str, name: str) -> Column:
        return F.count_if(F.coalesce(_expired(since, now, max_age_days), F.lit(True))).alias(name)

    documents = doc_cache.agg(removed("last_seen", "removed_documents"))
    pages = page_cache.agg(removed("last_crawled", "removed_pages"))
    return documents.join(F.broadcast(pages), F.lit(True))


def latest_by_url(log: DataFrame, method: str | None = None) -> DataFrame:
    """Latest observation per url, all columns."""
    rows = log if method is None else log.where(F.col("method") == method)
    rest = [c for c in rows.columns if c not in ("url", "ts")]
    picked = rows.groupBy("url").agg(F.max(F.struct("ts", *rest)).alias("last"))
    return picked.select("url", "last.*")


def latest_versions(facts: DataFrame) -> DataFrame:
    """Of a page that was fetched more than once the facts of the version with the largest page_id.

    ``facts``: page_id, url and what was found in the page. HTML itself is
    reduced to such facts first, so none of it is shuffled.
    """
    rest = [c for c in facts.columns if c not in ("url", "page_id")]
    last = facts.groupBy("url").agg(F.max_by(F.struct("page_id", *rest), "page_id").alias("last"))
    return last.select("last.page_id", "url", *[f"last.{c}" for c in rest])


def stored_decision(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Without a registry: candidates (url, local_path) are downloaded unless a non-empty file is stored."""
    files = stored.where(F.col("file_size") > 0).select("local_path").distinct().withColumn("is_stored", F.lit(True))
    found = F.col("is_stored").isNotNull()
    return join_lookup(candidates, files, "local_path").select(
        *candidates.columns, F.when(found, "stored").otherwise("not stored").alias("reason"), (~found).alias("download")
    )


def change_decision(
    candidates: DataFrame, stored: DataFrame, registry: DataFrame, heads: DataFrame, force: bool = False
) -> DataFrame:
    """Whether each candidate (url, local_path) is to be downloaded, and why.

    ``stored``: local_path of existing files. ``heads``: latest observation per
    url (url, status, etag, last_modified). Reasons in order: forced, not
    stored, not registered, changed, unchanged. Without an answer of status 200
    the file counts as unchanged.
    """
    files = stored.select("local_path").distinct().withColumn("is_stored", F.lit(True))
    known = registry.select(
        F.col("url_hash"),
        F.col("etag").alias("known_etag"),
        F.col("last_modified").alias("known_modified"),
        F.lit(True).alias("is_registered"),
    )
    answers = heads.where(F.col("status") == 200).select(
        "url", F.col("etag").alias("remote_etag"), F.col("last_modified").alias("remote_modified"), F.lit(True).alias("has_answer")
    )
    # Many urls may share one path, so that join has to stand a hot key.
    joined = (
        join_lookup(candidates, files, "local_path")
        .withColumn("url_hash", url_hash(F.col("url")))
        .join(known, "url_hash", "left")
        .join(answers, "url", "left")
    )
    same = F.col("remote_etag").eqNullSafe(F.col("known_etag")) & F.col("remote_modified").eqNullSafe(
        F.col("known_modified")
    )
    reason = (
        F.when(F.lit(force), F.lit("forced"))
        .when(F.col("is_stored").isNull(), F.lit("not stored"))
        .when(F.col("is_registered").isNull(), F.lit("not registered"))
        .when(F.col("has_answer") & ~same, F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    return joined.select(*candidates.columns, reason.alias("reason")).withColumn(
        "download", F.col("reason") != "unchanged"
    )


def upsert_registry(registry: DataFrame, downloads: DataFrame, heads: DataFrame, now: datetime) -> DataFrame:
    """Registry after ``downloads`` (url, local_path, body), with headers where known."""
    sized = downloads.select(
        "url",
        "local_path",
        F.octet_length("body").cast("long").alias("file_size"),
        F.sha2("body", 256).alias("file_hash"),
    )
    return upsert_registry_files(registry, sized, heads, now)


def upsert_registry_files(registry: DataFrame, files: DataFrame, heads: DataFrame, now: datetime) -> DataFrame:
    """Registry after ``files`` (url, local_path, file_size, file_hash) were stored, with headers where known."""
    fresh = files.select(
        url_hash(F.col("url")).alias("url_hash"),
        "url",
        F.struct("file_size", "file_hash", "local_path").alias("file"),
    ).groupBy("url_hash", "url").agg(F.max("file").alias("file"))
    answers = heads.where(F.col("status") == 200).select("url", "last_modified", "etag", "content_length")
    incoming = fresh.join(answers, "url", "left").select(
        "url_hash", F.struct("url", "file", "last_modified", "etag", "content_length").alias("new")
    )
    joined = registry.join(incoming, "url_hash", "full_outer")

    def pick(new: str, old: str) -> Column:
        return F.when(F.col("new").isNotNull(), F.col(f"new.{new}")).otherwise(F.col(old)).alias(old)

    return joined.select(
        "url_hash",
        pick("url", "url"),
        pick("file.local_path", "local_path"),
        F.when(F.col("new").isNotNull(), _now(now)).otherwise(F.col("download_time")).alias("download_time"),
        pick("file.file_size", "file_size"),
        pick("file.file_hash", "file_hash"),
        pick("last_modified", "last_modified"),
        pick("etag", "etag"),
        pick("content_length", "content_length"),
    )


def registry_stats(registry: DataFrame) -> DataFrame:
    """One row: files, bytes, megabytes."""
    totals = registry.agg(
        F.count("*").alias("total_files"), F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("total_size")
    )
    return totals.withColumn("total_size_mb", F.col("total_size").cast("double") / F.lit(1048576.0))


def stored_already(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates (url, local_path) with a non-empty stored file, with its size."""
    sizes = stored.where(F.col("file_size") > 0).groupBy("local_path").agg(F.max("file_size").alias("file_size"))
    return join_lookup(candidates, sizes, "local_path", "inner").select(*candidates.columns, "file_size")


def not_stored(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates without a non-empty stored file."""
    return candidates.join(stored.where(F.col("file_size") > 0).select("local_path"), "local_path", "left_anti").select(
        *candidates.columns
    )
