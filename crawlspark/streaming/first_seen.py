"""First sight of links on a stream, with retention."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from crawlspark.operators.incremental import url_hash
from crawlspark.operators.ordered import previous_value
from crawlspark.operators.pacing import SECOND
from crawlspark.session import use_rocksdb

FOUND = "kind string, url_hash string, url string, ts_us long"
COLUMNS = ["kind", "url_hash", "url", "ts_us"]
LAST = "hashes array<string>, last_us array<long>"
WAITING = "slot long, hashes array<string>, urls array<string>, ts_us array<long>"
DAY_US = 86_400 * SECOND

#: Buckets that urls are dealt to; a key of the state is one of them.
BUCKETS = 1024
#: Sights of one element of the state.
PACK = 1000


# Workers get the processor itself, whether or not they can import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def first_seen(links: DataFrame, retention: str = "30 days") -> DataFrame:
    """Links (ts, url, ...) not seen within the retention, counted from first sight.

    The watermark expires the state, so it holds the keys of one retention
    period and no more.
    """
    return (
        links.withColumn("url_hash", url_hash(F.col("url")))
        .withWatermark("ts", retention)
        .dropDuplicatesWithinWatermark(["url_hash"])
    )


class LastSight(StatefulProcessor):
    """Holds the last sight of every url of a bucket, which every later one within the retention renews.

    Sights wait by slots, stretches of time, until the watermark has passed their
    slot and then count in the order of time. A url without sights is forgotten
    within about two retentions. A call to the state costs far more than a sight
    does, so an element holds many, and a bucket's elements are written again only
    when a slot of it has ended.
    """

    def __init__(self, retention_us: int, lateness_us: int):
        self.retention_us = retention_us
        # What waits on is written again whenever a slot ends: a few times while the lateness lasts.
        self.slot_ms = max(retention_us // 8_000, lateness_us // 2_000, 1)
        # At the end of a slot as well, and one retention apart at least.
        self.sweep_ms = max(-(-retention_us // (self.slot_ms * 1000)), 1) * self.slot_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getListState("last", LAST)
        self.waiting = handle.getListState("waiting", WAITING)
        self.settled = set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        slots = set()
        for frame in rows:
            kept = frame["timed"] & ((mark <= 0) | (frame["ts_us"] // 1000 >= mark))
            sights = frame[kept]
            for slot, part in sights.groupby(sights["ts_us"] // 1000 // self.slot_ms):
                columns = [part[c].tolist() for c in ("url_hash", "url", "ts_us")]
                self.waiting.appendList([(int(slot), *(c[i : i + PACK] for c in columns)) for i in range(0, len(part), PACK)])
                slots.add(int(slot))
            late = frame[~kept]
            if len(late):
                yield late[["url_hash", "url"]].assign(kind="late", ts_us=late["ts_us"].astype(object).where(late["timed"], None))[COLUMNS]
        for slot in slots:
            self.handle.registerTimer((slot + 1) * self.slot_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # The first timer of a batch does the work of all.
        if key in self.settled:
            return
        self.settled.add(key)
        # Of the slot that the watermark lies in nothing is settled, so it may hold older sights.
        mark = timerValues.getCurrentWatermarkInMs() // self.slot_ms * self.slot_ms
        sights, rest = {}, []
        for pack in self.waiting.get():
            slot, *columns = pack
            if (slot + 1) * self.slot_ms > mark:
                rest.append(pack)
                continue
            for url_hash, url, ts_us in zip(*columns):
                sights.setdefault(url_hash, []).append((ts_us, url is not None, url))
        if sights:
            self._put(self.waiting, rest)
        last = {url_hash: ts_us for pack in self.last.get() for url_hash, ts_us in zip(*pack)}
        first = []
        for url_hash, rows in sights.items():
            before = last.get(url_hash)
            for ts_us, _, url in sorted(rows):
                if before is None or ts_us - before > self.retention_us:
                    first.append(("first", url_hash, url, ts_us))
                before = ts_us
            last[url_hash] = before
        held = [(url_hash, ts_us) for url_hash, ts_us in last.items() if ts_us + self.retention_us >= mark * 1000]
        self._put(self.last, [tuple(map(list, zip(*held[i : i + PACK]))) for i in range(0, len(held), PACK)])
        if held:
            # Without further sights the next look at the bucket is when its oldest one may be forgotten.
            end = (min(ts_us for _, ts_us in held) + self.retention_us) // 1000
            self.handle.registerTimer((end // self.sweep_ms + 1) * self.sweep_ms)
        if first:
            yield pd.DataFrame(first, columns=COLUMNS)

    def _put(self, state, packs: list[tuple]) -> None:
        if packs:
            state.put(packs)
        else:
            state.clear()

    def close(self) -> None:
        pass


def stream_first_seen(
    links: DataFrame,
    out: str,
    checkpoint: str,
    retention_days: float = 30.0,
    lateness_seconds: float = 3600.0,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Write the sights of links (ts_us, url) that are their url's first within the retention to ``out``.

    Every sight renews the retention, so a url comes again only after it hasn't been seen for longer
    than that. Sights count in the order of time, wherever the borders of
    batches are; one before the watermark is late and written as such.
    ``release_sights`` settles what still waits when a stream has ended for good.
    A task holds the waiting sights of one of the ``buckets`` of urls at a time;
    a checkpoint keeps the numbers that it was begun with.
    """
    use_rocksdb(links.sparkSession)
    retention, lateness = int(round(retention_days * DAY_US)), int(round(lateness_seconds * SECOND))
    timed = links.select(
        url_hash(F.col("url")).alias("url_hash"),
        "url",
        F.col("ts_us").cast("long").alias("ts_us"),
        F.timestamp_micros(F.col("ts_us").cast("long")).alias("ts"),
    ).withWatermark("ts", f"{lateness} microseconds")
    # Without the column of the watermark late rows aren't dropped but reach the processor.
    found = (
        # A frame's column of whole numbers keeps its type only without NULLs.
        timed.select(
            F.pmod(F.xxhash64("url_hash"), F.lit(buckets)).alias("bucket"),
            "url_hash",
            "url",
            F.coalesce("ts_us", F.lit(0).cast("long")).alias("ts_us"),
            F.col("ts_us").isNotNull().alias("timed"),
        )
        .groupBy("bucket")
        .transformWithStateInPandas(LastSight(retention, lateness), FOUND, "append", "eventTime")
    )
    return (
        found.writeStream.outputMode("append")
        .partitionBy("kind")
        .format("parquet")
        .option("path", f"{out}/found")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)


def release_sights(spark: SparkSession, out: str, checkpoint: str, retention_days: float = 30.0) -> None:
    """Settle the sights that still wait in the state, once their stream has ended for good."""
    sight = F.explode(F.arrays_zip("list_element.hashes", "list_element.ts_us", "list_element.urls")).alias("sight")
    waiting = _state(spark, checkpoint, "waiting").select(sight).select(
        F.col("sight.hashes").alias("url_hash"), "sight.ts_us", F.col("sight.urls").alias("url"), F.lit(1).alias("is_new")
    )
    last = sights_held(spark, checkpoint).select(
        "url_hash", F.col("last_us").alias("ts_us"), F.lit(None).cast("string").alias("url"), F.lit(0).alias("is_new")
    )
    settled = previous_value(waiting.unionByName(last), "url_hash", ["ts_us", "is_new", "url"], "ts_us")
    apart = F.col("previous").isNull() | (F.col("ts_us") - F.col("previous") > int(round(retention_days * DAY_US)))
    settled.where((F.col("is_new") == 1) & apart).select("url_hash", "url", "ts_us").write.mode("overwrite").parquet(f"{out}/released")


def first_sights(spark: SparkSession, out: str) -> DataFrame:
    """All first sights so far: url_hash, url, ts_us."""
    found = spark.read.schema(FOUND).parquet(f"{out}/found").where("kind = 'first'").drop("kind")
    return found.unionByName(spark.read.schema("url_hash string, url string, ts_us long").parquet(f"{out}/released*"))


def late_sights(spark: SparkSession, out: str) -> DataFrame:
    """Sights that came too late to count: url_hash, url, ts_us."""
    return spark.read.schema(FOUND).parquet(f"{out}/found").where("kind = 'late'").drop("kind")


def sights_held(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The urls that the state holds: url_hash, last_us."""
    held = _state(spark, checkpoint, "last").select(F.explode(F.arrays_zip("list_element.hashes", "list_element.last_us")).alias("held"))
    return held.select(F.col("held.hashes").alias("url_hash"), "held.last_us")
