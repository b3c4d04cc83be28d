"""Streaming queries over the events table; each ends when all of it has been read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlspark.operators import links
from crawlspark.session import checkpoint_root
from crawlspark.sources.tables import stream_pages
from crawlspark.streaming import counters, first_seen, gaps, sessions, upserts
from workload.common import SQL_ANCHORS, SQL_EVENTS, micros, table, us_of
from workload.pacing_queries import _GAP_US, GAP_SECONDS

#: Days after which a link counts as new again, seconds of a slot of the gap audit, and pause that ends a session.
RETENTION_DAYS, SLOT_SECONDS, PAUSE_SECONDS = 3.0, 86_400, 43_200

#: Batches that the events come in, and the share of them that comes one batch late.
BATCHES, ONE_IN = 3, 7
#: Half a batch's stretch of time: of the events that come a batch late, some are too late.
LATENESS_SECONDS = 5 * 86_400
#: More than two stretches, so that no event is too late.
LONG_LATENESS_SECONDS = 21 * 86_400


def _staged(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The events by batch: stretches of time, with some events a batch too late."""
    rows = table(spark, sf_dir, "events")
    us = micros("ts")
    first, last = rows.agg(F.min(us), F.max(us)).first()
    stretch = F.floor((us - F.lit(first)) * BATCHES / F.lit(last - first + 1))
    late = (F.pmod("event_id", F.lit(ONE_IN)) == 0).cast("int")
    host = F.concat(F.lit("host"), F.col("user_id").cast("string"))
    rows.select(
        "event_id",
        host.alias("domain"),
        F.concat(F.lit("https://"), host).alias("url"),
        us.alias("ts_us"),
        F.timestamp_micros(us).alias("ts"),
        "event_type",
        "value",
        F.least(stretch + late, F.lit(BATCHES - 1)).cast("int").alias("batch"),
    ).write.partitionBy("batch").parquet(f"{folder}/staged")


def _in_batches(spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame], StreamingQuery]) -> list[StreamingQuery]:
    """Let the batches arrive one after the other; ``start`` takes the stream up where it was left."""
    _staged(spark, sf_dir, folder)
    schema = spark.read.parquet(f"{folder}/staged").drop("batch").schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(f"{folder}/arrived"))
    done = []
    for number in range(BATCHES):
        system.rename(path(f"{folder}/staged/batch={number}"), path(f"{folder}/arrived/{number}"))
        done.append(start(spark.readStream.schema(schema).parquet(f"{folder}/arrived/*")))
        _finish(done[-1])
    return done


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/crawlspark/stream-{name}-{uuid.uuid4().hex}"


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _progress(events: DataFrame) -> DataFrame:
    return events.select(
        "ts", F.col("domain").alias("department"), F.col("event_type").alias("action"), F.floor("value").cast("long").alias("file_size")
    )


def streaming_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of every window, with the events that came after the watermark had closed it.

    Every batch writes the windows it changed; the last version of each counts.
    """
    folder = _folder(spark, "counters")

    def start(events: DataFrame) -> StreamingQuery:
        return counters.stream_counters(_progress(events), f"{folder}/out", f"{folder}/checkpoint", "1 day", f"{LATENESS_SECONDS} seconds")

    _in_batches(spark, sf_dir, folder, start)
    arrived = _progress(spark.read.parquet(f"{folder}/arrived/*"))
    found = counters.counted_and_late(counters.latest_counters(spark, f"{folder}/out"), arrived, "1 day")
    return found.select(us_of("window_start"), "department", "action", "n", "total_size", "late", "late_size")


def first_seen_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that weren't seen for three days, where every sight counts."""
    folder = _folder(spark, "first-seen")
    places = (f"{folder}/out", f"{folder}/checkpoint")
    _in_batches(
        spark, sf_dir, folder, lambda events: first_seen.stream_first_seen(events, *places, RETENTION_DAYS, LATENESS_SECONDS)
    )
    first_seen.release_sights(spark, *places, RETENTION_DAYS)
    found = first_seen.first_sights(spark, places[0]).withColumn("kind", F.lit("first"))
    return found.unionByName(first_seen.late_sights(spark, places[0]).withColumn("kind", F.lit("late")))


def page_cache_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "page-cache")

    def start(events: DataFrame) -> StreamingQuery:
        crawled = events.select("ts", "url", F.floor("value").cast("long").alias("pdf_count"))
        return upserts.stream_upserts(crawled, "pages", folder, f"{folder}/checkpoint")

    _in_batches(spark, sf_dir, folder, start)
    state = upserts.streamed_state(spark, "pages", folder)
    return state.select("url_hash", "url", us_of("last_crawled"), "pdf_count", "crawl_count")


def doc_cache_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas of three batches, of which the first two are folded into the state."""
    folder = _folder(spark, "doc-cache")

    def start(events: DataFrame) -> StreamingQuery:
        seen = events.select("ts", "url", F.col("event_type").alias("source_page"))
        return upserts.stream_upserts(seen, "documents", folder, f"{folder}/checkpoint")

    _in_batches(spark, sf_dir, folder, start)
    upserts.compact(spark, "documents", folder, 1)
    state = upserts.streamed_state(spark, "documents", folder)
    return state.select("url_hash", "url", us_of("discovered_time"), "source_page", us_of("last_seen"))


def gap_audit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests too soon after the one before, and requests too late to tell."""
    folder = _folder(spark, "gaps")
    places = (f"{folder}/out", f"{folder}/checkpoint")

    def start(events: DataFrame) -> StreamingQuery:
        requests = events.select(F.concat("url", F.lit("/"), F.col("event_id").cast("string")).alias("url"), "domain", "ts_us")
        return gaps.stream_gap_violations(requests, *places, GAP_SECONDS, LATENESS_SECONDS, SLOT_SECONDS)

    _in_batches(spark, sf_dir, folder, start)
    gaps.release_pending(spark, *places, GAP_SECONDS)
    late = gaps.late_requests(spark, places[0]).select("*", F.lit(None).cast("long").alias("gap_us"), F.lit("late").alias("kind"))
    return gaps.violations(spark, places[0]).withColumn("kind", F.lit("violation")).unionByName(late)


def domain_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions of every domain: activity without a pause of half a day."""
    folder = _folder(spark, "sessions")

    def start(events: DataFrame) -> StreamingQuery:
        activity = events.select("domain", "ts", F.floor("value").cast("long").alias("bytes"))
        return sessions.stream_sessions(activity, f"{folder}/out", f"{folder}/checkpoint", f"{PAUSE_SECONDS} seconds", f"{LONG_LATENESS_SECONDS} seconds")

    _in_batches(spark, sf_dir, folder, start)
    found = sessions.closed_sessions(spark, f"{folder}/out")
    return found.select("domain", us_of("session_start"), us_of("session_end"), "requests", "bytes")


def page_links_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link extraction keeps no state, so the batch operator runs on a stream of pages as it is."""
    folder = _folder(spark, "page-links")
    pages = stream_pages(spark, f"{sf_dir}/pages.parquet*")
    _finish(
        links.page_links(pages)
        .select("page_url", "target_url")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.parquet(f"{folder}/out")


QUERIES = {
    "page_links_stream": page_links_stream,
    "streaming_counters": streaming_counters,
    "first_seen_stream": first_seen_stream,
    "page_cache_stream": page_cache_stream,
    "doc_cache_stream": doc_cache_stream,
    "gap_audit_stream": gap_audit_stream,
    "domain_sessions_stream": domain_sessions_stream,
}

# Batch of every event and the watermark, in milliseconds, that the batches before have left.
_BATCHES = SQL_EVENTS + f""",
span AS (SELECT min(ts_us) AS first, max(ts_us) AS last FROM ev),
bt AS (
  SELECT ev.*, 'https://' || domain AS link, least(CAST(floor((ts_us - first) * {BATCHES} / CAST(last - first + 1 AS DOUBLE)) AS BIGINT)
    + CASE WHEN event_id % {ONE_IN} = 0 THEN 1 ELSE 0 END, {BATCHES - 1}) AS batch FROM ev, span),
mk AS (
  SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LATENESS_SECONDS * 1000} AS mark
  FROM (SELECT batch, max(ts_us // 1000) AS newest FROM bt GROUP BY batch)),
st AS (SELECT bt.*, mark, coalesce(ts_us // 1000 < mark, FALSE) AS late FROM bt JOIN mk ON bt.batch = mk.batch)"""


SQL = {
    "page_links_stream": f"""
WITH {SQL_ANCHORS}
SELECT url AS page_url, target AS target_url FROM a""",
    "streaming_counters": f"""
WITH {_BATCHES},
w AS (SELECT *, ts_us // 86400000000 * 86400000000 AS start, floor(value) AS size,
  coalesce((ts_us // 86400000000 + 1) * 86400000 <= mark, FALSE) AS closed FROM st)
SELECT CAST(start AS BIGINT) AS window_start_us, domain AS department, event_type AS action,
  CAST(count(*) FILTER (NOT closed) AS BIGINT) AS n, CAST(coalesce(sum(size) FILTER (NOT closed), 0) AS BIGINT) AS total_size,
  CAST(count(*) FILTER (closed) AS BIGINT) AS late, CAST(coalesce(sum(size) FILTER (closed), 0) AS BIGINT) AS late_size
FROM w GROUP BY start, domain, event_type""",
    "first_seen_stream": f"""
WITH {_BATCHES},
o AS (SELECT link, ts_us, lag(ts_us) OVER (PARTITION BY link ORDER BY ts_us) AS before FROM st WHERE NOT late)
SELECT md5(link) AS url_hash, link AS url, ts_us, 'first' AS kind FROM o
WHERE before IS NULL OR ts_us - before > {int(RETENTION_DAYS * 86_400_000_000)}
UNION ALL SELECT md5(link), link, ts_us, 'late' FROM st WHERE late""",
    "page_cache_stream": f"""
WITH {SQL_EVENTS}
SELECT md5('https://' || domain) AS url_hash, 'https://' || domain AS url, CAST(max(ts_us) AS BIGINT) AS last_crawled_us,
  CAST(arg_max(CAST(floor(value) AS BIGINT), (ts_us, CAST(floor(value) AS BIGINT))) AS BIGINT) AS pdf_count, CAST(count(*) AS BIGINT) AS crawl_count
FROM ev GROUP BY domain""",
    "doc_cache_stream": f"""
WITH {SQL_EVENTS}
SELECT md5('https://' || domain) AS url_hash, 'https://' || domain AS url, CAST(min(ts_us) AS BIGINT) AS discovered_time_us,
  arg_min(event_type, (ts_us, event_type)) AS source_page, CAST(max(ts_us) AS BIGINT) AS last_seen_us
FROM ev GROUP BY domain""",
    "gap_audit_stream": f"""
WITH {_BATCHES},
o AS (SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY domain ORDER BY ts_us, url) AS gap_us FROM st WHERE NOT late)
SELECT url, domain, ts_us, gap_us, 'violation' AS kind FROM o WHERE gap_us < {_GAP_US}
UNION ALL SELECT url, domain, ts_us, NULL, 'late' FROM st WHERE late""",
    "domain_sessions_stream": f"""
WITH {SQL_EVENTS},
fin AS (SELECT max(ts_us // 1000) - {LONG_LATENESS_SECONDS * 1000} AS mark FROM ev),
k AS (SELECT domain, ts_us, floor(value) AS bytes FROM ev),
o AS (SELECT *, coalesce(ts_us - lag(ts_us) OVER (PARTITION BY domain ORDER BY ts_us) > {PAUSE_SECONDS * 1_000_000}, TRUE) AS opens FROM k),
n AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY ts_us RANGE UNBOUNDED PRECEDING) AS session FROM o),
g AS (SELECT domain, min(ts_us) AS s, max(ts_us) + {PAUSE_SECONDS * 1_000_000} AS e, count(*) AS requests, sum(bytes) AS bytes FROM n GROUP BY domain, session)
SELECT domain, s AS session_start_us, e AS session_end_us, CAST(requests AS BIGINT) AS requests, CAST(bytes AS BIGINT) AS bytes
FROM g, fin WHERE e <= mark * 1000""",
}
