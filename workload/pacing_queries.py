"""Queries over requests and attempts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators import attempts, pacing
from crawlspark.operators.ordered import row_numbers
from crawlspark.session import checkpoint_root
from crawlspark.sources import tables
from workload.common import SQL_EVENTS, events

# Requests that last up to two days make domains wait.
DURATION = "CAST(round(value * 360000000) AS BIGINT)"
GAP_SECONDS = 3600.0


def gap_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = events(spark, sf_dir).select("domain", "event_id", F.col("ts_us").alias("arrival_us"), F.expr(DURATION).alias("duration_us"))
    return pacing.gap_plan(requests, GAP_SECONDS, order="event_id")


def gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pacing.gap_audit(events(spark, sf_dir), GAP_SECONDS, order="event_id")


def gap_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).select("domain", "event_id", "ts_us")
    return pacing.gap_violations(log, GAP_SECONDS, order="event_id")


def error_text() -> Column:
    kind = F.col("event_type")
    shown = F.floor("value").cast("long").cast("string")
    return (
        F.when(kind == "error", F.concat(F.lit("Connection Timeout after "), shown))
        .when(kind == "click", F.concat(F.lit("HTTP 404 for "), F.col("url")))
        .when(kind == "view", F.lit("Temporary trouble"))
        .when(kind == "signup", F.lit("HTTP 503"))
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("error", error_text()).withColumn("success", F.col("error").isNull())


def attempt_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of a domain as series of three attempts, one after the other."""
    numbered = row_numbers(failures(spark, sf_dir), "domain", ["ts_us", "event_id"], "k")
    series = F.concat_ws("/", "domain", F.floor((F.col("k") - 1) / 3))
    attempt = ((F.col("k") - 1) % 3 + 1).cast("int")
    return attempts.attempt_outcome(numbered.select(series.alias("series"), attempt.alias("attempt"), "success", "error"), key="series")


def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.error_classes(failures(spark, sf_dir))


def fetch_trouble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests written as a fetch log and read back as one."""
    status = F.regexp_extract("error", r"HTTP ([0-9]+)", 1)
    known = {
        "url": F.col("event_id").cast("string"),
        "method": F.lit("GET"),
        "ts": F.timestamp_micros("ts_us"),
        "attempt": F.lit(1),
        "status": F.when(status != "", status.cast("int")),
        "error": F.col("error"),
    }
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.FETCH_LOG]
    folder = f"{checkpoint_root(spark)}/crawlspark/fetch-log-{uuid.uuid4().hex}"
    failures(spark, sf_dir).select(*columns).write.parquet(folder)
    log = tables.read_fetch_log(spark, folder)
    return attempts.fetch_trouble(log).select(F.col("url").cast("long").alias("event_id"), "retry")


def domains_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pacing.domains_tracked(events(spark, sf_dir))


def domain_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pacing.domain_count(events(spark, sf_dir))


QUERIES = {
    "gap_plan": gap_plan,
    "gap_audit": gap_audit,
    "gap_violations": gap_violations,
    "attempt_outcome": attempt_outcome,
    "error_classes": error_classes,
    "fetch_trouble": fetch_trouble,
    "domains_tracked": domains_tracked,
    "domain_count": domain_count,
}

_GAP_US = int(GAP_SECONDS * 1_000_000)
_GAPS = SQL_EVENTS + """,
g AS (SELECT domain, event_id, ts_us, ts_us - lag(ts_us) OVER (PARTITION BY domain ORDER BY ts_us, event_id) AS gap_us FROM ev)"""
_FAILURES = SQL_EVENTS + """,
f AS (
  SELECT *, CASE event_type WHEN 'error' THEN 'Connection Timeout after ' || CAST(floor(value) AS BIGINT)
    WHEN 'click' THEN 'HTTP 404 for ' || url WHEN 'view' THEN 'Temporary trouble' WHEN 'signup' THEN 'HTTP 503' END AS error
  FROM ev),
h AS (
  SELECT *, error IS NOT NULL AND regexp_matches(lower(error),
    'timeout|connection|network|temporary|server error|500|502|503|504|429') AS retryable FROM f)"""

SQL = {
    "gap_plan": f"""
WITH {SQL_EVENTS},
r AS (SELECT domain, event_id, ts_us AS arrival_us, {DURATION} AS duration_us, greatest({_GAP_US}, {DURATION}) AS hold_us FROM ev),
c AS (
  SELECT *, coalesce(sum(hold_us) OVER (PARTITION BY domain ORDER BY arrival_us, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held FROM r),
s AS (SELECT *, held + max(arrival_us - held) OVER (PARTITION BY domain ORDER BY arrival_us, event_id) AS start_us FROM c)
SELECT domain, event_id, arrival_us, duration_us, CAST(hold_us AS BIGINT) AS hold_us, CAST(start_us AS BIGINT) AS start_us,
  CAST(start_us - arrival_us AS BIGINT) AS wait_us FROM s""",
    "gap_audit": f"""
WITH {_GAPS}
SELECT domain, CAST(count(*) AS BIGINT) AS requests, CAST(count(*) FILTER (gap_us < {_GAP_US}) AS BIGINT) AS violations,
  CAST(min(gap_us) AS BIGINT) AS min_gap_us, CAST(sum(gap_us) AS DOUBLE) / CAST(nullif(count(gap_us), 0) AS DOUBLE) AS mean_gap_us
FROM g GROUP BY domain""",
    "gap_violations": f"""
WITH {_GAPS}
SELECT domain, event_id, ts_us, gap_us FROM g WHERE gap_us < {_GAP_US}""",
    "attempt_outcome": f"""
WITH {_FAILURES},
o AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ts_us, event_id) - 1 AS place FROM h),
n AS (SELECT *, domain || '/' || (place // 3) AS series, place % 3 + 1 AS attempt FROM o),
k AS (SELECT *, min(CASE WHEN NOT retryable THEN attempt END) OVER (PARTITION BY series) AS stop,
    max(attempt) OVER (PARTITION BY series) AS last FROM n)
SELECT series, error IS NULL AS success,
  CASE WHEN stop IS NULL AND attempt = 3 THEN 'Failed after 3 attempts: ' || error ELSE error END AS error,
  CAST(attempt AS BIGINT) AS attempts, CAST(pow(2, attempt - 1) - 1 AS BIGINT) AS planned_wait_s
FROM k WHERE attempt = coalesce(stop, last)""",
    "error_classes": f"""
WITH {_FAILURES}
SELECT CASE WHEN contains(lower(error), 'timeout') THEN 'timeout' WHEN contains(lower(error), 'temporary') THEN 'temporary'
    ELSE coalesce(nullif(regexp_extract(lower(error), '500'), ''), nullif(regexp_extract(lower(error), '502'), ''),
      nullif(regexp_extract(lower(error), '503'), ''), nullif(regexp_extract(lower(error), '504'), ''),
      nullif(regexp_extract(lower(error), '429'), ''), 'other') END AS error_class,
  retryable, CAST(count(*) AS BIGINT) AS failures
FROM h WHERE error IS NOT NULL GROUP BY 1, 2""",
    "fetch_trouble": f"""
WITH {_FAILURES}
SELECT event_id, event_type IN ('error', 'signup') AS retry FROM f""",
    "domains_tracked": f"""
WITH {SQL_EVENTS}
SELECT domain, CAST(count(*) AS BIGINT) AS urls FROM ev GROUP BY domain""",
    "domain_count": f"""
WITH {SQL_EVENTS}
SELECT CAST(count(DISTINCT domain) AS BIGINT) AS domains_tracked FROM ev""",
}
