"""Request pacing per domain: a plan that keeps the gap, and an audit of a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.functions.url import authority
from crawlspark.operators.ordered import largest_before, ordered_chunks, previous_value, with_carry

SECOND = 1_000_000


def gap_plan(
    requests: DataFrame, gap_seconds: float = 1.0, order: str = "url", chunks: int | None = None
) -> DataFrame:
    """Start of each request when a domain serves one at a time, at least a gap apart.

    ``requests``: domain, arrival_us, duration_us (whole microseconds) and a
    column ``order`` that settles equal arrivals. Adds start_us and wait_us.

    A request holds its domain for g = max(gap, duration). With C the sum of g
    over earlier rows, start = C + running max(arrival - C): two running
    values, no recurrence. Between chunks only the time the domain is free
    again is handed on, by the same formula over the chunk totals.
    """
    gap = int(round(gap_seconds * SECOND))
    held = requests.withColumn("hold_us", F.greatest(F.lit(gap).cast("long"), F.col("duration_us")))
    split = ordered_chunks(held, "domain", ["arrival_us", order], chunks)

    rows = Window.partitionBy("domain", "chunk").orderBy("arrival_us", order)
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    sofar = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        split.withColumn("offset_us", F.coalesce(F.sum("hold_us").over(earlier), F.lit(0)))
        .withColumn("slack_us", F.max(F.col("arrival_us") - F.col("offset_us")).over(sofar))
    )
    totals = local.groupBy("domain", "chunk").agg(
        F.sum("hold_us").alias("total_us"),
        F.max(F.col("arrival_us") - F.col("offset_us")).alias("slack_us"),
    )
    chunk_rows = Window.partitionBy("domain").orderBy("chunk")
    before = chunk_rows.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset_us", F.coalesce(F.sum("total_us").over(before), F.lit(0)))
    free = F.col("offset_us") + F.max(F.col("slack_us") - F.col("offset_us")).over(before)

    start = F.col("offset_us") + F.greatest(F.col("slack_us"), F.coalesce(F.col("carry"), F.col("slack_us")))
    return (
        with_carry(local, offsets, "domain", free)
        .withColumn("start_us", start)
        .withColumn("wait_us", F.col("start_us") - F.col("arrival_us"))
        .drop("chunk", "offset_us", "slack_us", "carry")
    )


def request_gaps(log: DataFrame, order: str = "url", chunks: int | None = None) -> DataFrame:
    """``log`` (domain, ts_us, ...) with gap_us to the domain's request before, NULL for the first."""
    return previous_value(log, "domain", ["ts_us", order], "ts_us", chunks).withColumn(
        "gap_us", F.col("ts_us") - F.col("previous")
    ).drop("previous")


def gap_violations(log: DataFrame, gap_seconds: float = 1.0, order: str = "url", chunks: int | None = None) -> DataFrame:
    """Requests that came less than the gap after the one before on their domain."""
    return request_gaps(log, order, chunks).where(F.col("gap_us") < int(round(gap_seconds * SECOND)))


def gap_audit(log: DataFrame, gap_seconds: float = 1.0, order: str = "url", chunks: int | None = None) -> DataFrame:
    """Per domain: requests, violations, min_gap_us, mean_gap_us (NULL with a single request)."""
    gap = int(round(gap_seconds * SECOND))
    # The gaps are written out on the way, so only what they need goes along.
    narrow = log.select(*dict.fromkeys(["domain", "ts_us", order]))
    return request_gaps(narrow, order, chunks).groupBy("domain").agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("gap_us") < gap).alias("violations"),
        F.min("gap_us").alias("min_gap_us"),
        (F.sum("gap_us").cast("double") / F.nullif(F.count("gap_us"), F.lit(0)).cast("double")).alias("mean_gap_us"),
    )


def busy_time(fetches: DataFrame, key: str = "department", chunks: int | None = None) -> DataFrame:
    """Per ``key`` the time in which at least one of its fetches (start_us, end_us) was under way: busy_us, fetches.

    Overlapping fetches count once. A fetch adds what of it lies after the end
    of all that started before; rows without a start are left out, and one
    without an end, or with an end before its start, takes no time. A busy key
    is spread over range partitions.
    """
    timed = fetches.where("start_us is not null").select(
        key, "start_us", F.greatest("start_us", F.coalesce("end_us", "start_us")).alias("end_us")
    )
    reached = largest_before(timed, key, ["start_us", "end_us"], "end_us", "reached_us", chunks)
    added = F.greatest(F.col("end_us") - F.greatest("start_us", "reached_us"), F.lit(0))
    return reached.groupBy(key).agg(F.sum(added).cast("long").alias("busy_us"), F.count("*").alias("fetches"))


def domains_tracked(urls: DataFrame) -> DataFrame:
    """One row per domain with its number of urls."""
    return urls.groupBy(authority(F.col("url")).alias("domain")).agg(F.count("*").alias("urls"))


def domain_count(urls: DataFrame) -> DataFrame:
    """One row: how many domains there are."""
    return domains_tracked(urls).agg(F.count("*").alias("domains_tracked"))
