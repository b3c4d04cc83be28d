"""Live counters per department and action."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEYS = ["window_start", "department", "action"]


def windowed_counters(events: DataFrame, window: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Counts in tumbling windows: window_start, department, action, n, total_size.

    Works on a stream (state is dropped once the watermark has passed a
    window) and, with the same result, on a table.
    """
    rows = events.withWatermark("ts", lateness) if events.isStreaming else events
    return (
        rows.groupBy(F.window("ts", window).alias("window"), "department", "action")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("total_size"),
        )
        .select(F.col("window.start").alias("window_start"), "department", "action", "n", "total_size")
    )


def stream_counters(
    events: DataFrame, out: str, checkpoint: str, window: str = "1 hour", lateness: str = "10 minutes"
) -> StreamingQuery:
    """Write the windows that each batch changed to ``out``; an event whose window the watermark has passed is dropped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        windowed_counters(events, window, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_counters(spark: SparkSession, out: str) -> DataFrame:
    """The last version of every window that ``stream_counters`` has written."""
    versions = spark.read.parquet(out).groupBy(*KEYS).agg(F.max(F.struct("batch_id", "n", "total_size")).alias("last"))
    return versions.select(*KEYS, "last.n", "last.total_size")


def counted_and_late(counted: DataFrame, events: DataFrame, window: str = "1 hour") -> DataFrame:
    """The counters with what is missing in them of all ``events``: n, total_size, late, late_size.

    A window that only late events fall into has a row as well.
    """
    everything = windowed_counters(events, window).select(*KEYS, F.col("n").alias("all_n"), F.col("total_size").alias("all_size"))
    n, size = F.coalesce("n", F.lit(0)), F.coalesce("total_size", F.lit(0))
    return everything.join(counted, KEYS, "left").select(
        *KEYS, n.alias("n"), size.alias("total_size"), (F.col("all_n") - n).alias("late"), (F.col("all_size") - size).alias("late_size")
    )
