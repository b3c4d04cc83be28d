"""Gap audit on a stream of requests, with keyed state.

Requests wait in the state of their bucket of domains and stretch of time, a
slot, until the watermark has passed the slot's end. The timer of that moment
compares them in the order of time and clears the state, so a slot lives as
long as the lateness and leaves nothing behind. A request shortly before the
end of a slot also waits in the next one, where it is only compared with: a
slot then needs no other, and a busy domain is spread over as many keys as it
has slots. A call to the state costs far more than a request does, so a key
has many domains and an element of the state many requests.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from crawlspark.operators.pacing import SECOND, request_gaps
from crawlspark.session import use_rocksdb

FOUND = "kind string, url string, domain string, ts_us long, gap_us long"
COLUMNS = ["kind", "url", "domain", "ts_us", "gap_us"]
WAITING = "own boolean, domains array<string>, ts_us array<long>, urls array<string>"

#: Buckets that domains are dealt to; with the slot they set how many requests a key has.
BUCKETS = 256
#: Requests of one element of the state.
PACK = 1000


def _us(seconds: float) -> int:
    return int(round(seconds * SECOND))


# Workers get the processor itself, whether or not they can import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class SlotAudit(StatefulProcessor):
    """Compares the requests of a (bucket, slot), by domain, once the watermark has passed its end."""

    def __init__(self, gap_us: int, slot_us: int):
        self.gap_us, self.slot_us = gap_us, slot_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        waits = False
        for frame in rows:
            kept = frame["timed"] & ((mark <= 0) | (frame["ts_us"] // 1000 >= mark))
            for own in (True, False):
                columns = [frame.loc[kept & (frame["own"] == own), c].tolist() for c in ("domain", "ts_us", "url")]
                packs = [(own, *(c[i : i + PACK] for c in columns)) for i in range(0, len(columns[0]), PACK)]
                if packs:
                    self.waiting.appendList(packs)
                    waits = True
            late = frame[~kept & frame["own"]]
            if len(late):
                late = late[["url", "domain"]].assign(kind="late", ts_us=late["ts_us"].astype(object).where(late["timed"], None), gap_us=None)
                yield late[COLUMNS]
        if waits:
            self.handle.registerTimer((key[1] + 1) * self.slot_us // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        requests = {}
        for own, *columns in self.waiting.get():
            for domain, ts_us, url in zip(*columns):
                requests.setdefault(domain, []).append((ts_us, url is not None, url, own))
        self.waiting.clear()
        found = []
        for domain, rows in requests.items():
            rows.sort(key=lambda r: r[:3])
            for (before, *_), (ts_us, _, url, own) in zip(rows, rows[1:]):
                if own and ts_us - before < self.gap_us:
                    found.append(("violation", url, domain, ts_us, ts_us - before))
        if found:
            yield pd.DataFrame(found, columns=COLUMNS)

    def close(self) -> None:
        pass


def stream_gap_violations(
    requests: DataFrame,
    out: str,
    checkpoint: str,
    gap_seconds: float = 1.0,
    lateness_seconds: float = 3600.0,
    slot_seconds: float = 60.0,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Write requests (url, domain, ts_us) that came too soon after the one before, and late ones, to ``out``.

    The watermark is the latest time seen in earlier batches, less the lateness.
    A request before it, or without a time, is late: it is written as such and
    compared with nothing. All others are compared in the order of time (equal
    times in that of urls), wherever the borders of batches are.
    ``release_pending`` compares what still waits when a stream has ended for
    good. ``slot_seconds`` is the gap at least and sets how finely a domain is
    spread, ``buckets`` how finely all domains are; a task holds the requests of
    one slot and bucket at a time. The result depends on neither. A checkpoint
    keeps the numbers that it was begun with.
    """
    gap, slot = _us(gap_seconds), max(_us(slot_seconds), _us(gap_seconds), 1)
    use_rocksdb(requests.sparkSession)
    rows = requests.withColumn("ts_us", F.col("ts_us").cast("long"))
    timed = rows.withColumn("ts", F.timestamp_micros("ts_us")).withWatermark("ts", f"{_us(lateness_seconds)} microseconds")
    number, inside = F.expr(f"(ts_us - pmod(ts_us, {slot}L)) div {slot}L"), F.expr(f"pmod(ts_us, {slot}L)")
    own = F.array(F.struct(number.alias("slot"), F.lit(True).alias("own")))
    following = F.array(F.struct((number + 1).alias("slot"), F.lit(False).alias("own")))
    places = F.when(inside >= slot - gap, F.concat(own, following)).otherwise(own)
    # Without the column of the watermark late rows aren't dropped but reach the processor.
    placed = timed.select("url", "domain", "ts_us", F.explode(places).alias("place"))
    # A frame's column of whole numbers keeps its type only without NULLs.
    keyed = placed.select(
        F.pmod(F.xxhash64("domain"), F.lit(buckets)).alias("bucket"),
        F.coalesce("place.slot", F.lit(0).cast("long")).alias("slot"),
        "place.own",
        "url",
        "domain",
        F.coalesce("ts_us", F.lit(0).cast("long")).alias("ts_us"),
        F.col("ts_us").isNotNull().alias("timed"),
    )
    found = keyed.groupBy("bucket", "slot").transformWithStateInPandas(SlotAudit(gap, slot), FOUND, "append", "eventTime")
    return (
        found.writeStream.outputMode("append")
        .partitionBy("kind")
        .format("parquet")
        .option("path", f"{out}/found")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def release_pending(spark: SparkSession, out: str, checkpoint: str, gap_seconds: float = 1.0) -> None:
    """Compare the requests that still wait in the state, once their stream has ended for good."""
    packed = spark.read.format("statestore").option("stateVarName", "waiting").load(checkpoint).select("key.slot", "list_element.*")
    request = F.explode(F.arrays_zip("domains", "ts_us", "urls")).alias("request")
    waiting = packed.select("slot", "own", request).select(
        F.col("request.domains").alias("asked"),
        F.to_json(F.struct(F.col("request.domains").alias("domain"), "slot")).alias("domain"),
        F.struct(F.col("request.urls").isNotNull().alias("named"), F.col("request.urls").alias("url")).alias("place"),
        "request.ts_us",
        "own",
        F.col("request.urls").alias("url"),
    )
    gaps = request_gaps(waiting, order="place").where(F.col("own") & (F.col("gap_us") < _us(gap_seconds)))
    gaps.select("url", F.col("asked").alias("domain"), "ts_us", "gap_us").write.mode("overwrite").parquet(f"{out}/released")


def _found(spark: SparkSession, out: str, kind: str) -> DataFrame:
    return spark.read.schema(FOUND).parquet(f"{out}/found").where(F.col("kind") == kind).drop("kind")


def violations(spark: SparkSession, out: str) -> DataFrame:
    """All violations found so far: url, domain, ts_us, gap_us."""
    released = spark.read.schema("url string, domain string, ts_us long, gap_us long").option("ignoreMissingFiles", True)
    found = _found(spark, out, "violation")
    return found.unionByName(released.parquet(f"{out}/released*"))


def late_requests(spark: SparkSession, out: str) -> DataFrame:
    """Requests that came too late to be compared: url, domain, ts_us."""
    return _found(spark, out, "late").drop("gap_us")
