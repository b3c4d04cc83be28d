"""Sessions of activity per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def domain_sessions(activity: DataFrame, pause: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Runs of activity (domain, ts, bytes) without a longer pause: domain, session_start, session_end, requests, bytes.

    A session ends one pause after its last activity. On a stream it is given
    once the watermark has passed its end, and its state is dropped then; a
    table has all of its sessions.
    """
    rows = activity.withWatermark("ts", lateness) if activity.isStreaming else activity
    return (
        rows.groupBy(F.session_window("ts", pause).alias("session"), "domain")
        .agg(F.count("*").alias("requests"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"))
        .select("domain", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "requests", "bytes")
    )


def stream_sessions(
    activity: DataFrame, out: str, checkpoint: str, pause: str = "30 minutes", lateness: str = "10 minutes"
) -> StreamingQuery:
    """Write the sessions that the watermark has passed to ``out``."""
    return (
        domain_sessions(activity, pause, lateness)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_sessions(spark: SparkSession, out: str) -> DataFrame:
    """All sessions written so far."""
    return spark.read.parquet(out)
