"""Cache upserts on a stream.

A micro-batch writes only what it changes, as a delta under its batch number;
writing it again gives the same delta. All columns of the caches merge (first
discovery, last sight, latest count, sum of crawls), so the state is a
compacted version in buckets plus the later deltas, and no batch rewrites it.
Compaction reads and writes the buckets that its deltas touch. A delta counts
once its success mark is there, and goes when no version that is kept needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlspark import schemas
from crawlspark.operators.incremental import url_hash
from crawlspark.sources import buckets
from crawlspark.sources.state import completed, remove, versions


def document_delta(seen: DataFrame) -> DataFrame:
    """Rows for the document cache from sightings (ts, url, source_page)."""
    return merge_documents(
        seen.select(
            url_hash(F.col("url")).alias("url_hash"),
            "url",
            F.col("ts").alias("discovered_time"),
            "source_page",
            F.col("ts").alias("last_seen"),
        )
    )


def page_delta(crawled: DataFrame) -> DataFrame:
    """Rows for the page cache from crawls (ts, url, pdf_count)."""
    return merge_pages(
        crawled.select(
            url_hash(F.col("url")).alias("url_hash"),
            "url",
            F.col("ts").alias("last_crawled"),
            F.col("pdf_count").cast("long").alias("pdf_count"),
            F.lit(1).cast("long").alias("crawl_count"),
        )
    )


def merge_documents(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct("discovered_time", "source_page"))
    return rows.groupBy("url_hash").agg(
        F.min("url").alias("url"), first.alias("first"), F.max("last_seen").alias("last_seen")
    ).select(
        "url_hash",
        "url",
        F.col("first.discovered_time").alias("discovered_time"),
        F.col("first.source_page").alias("source_page"),
        "last_seen",
    )


def merge_pages(rows: DataFrame) -> DataFrame:
    latest = F.max(F.struct("last_crawled", "pdf_count"))
    return rows.groupBy("url_hash").agg(
        F.min("url").alias("url"), latest.alias("latest"), F.sum("crawl_count").alias("crawl_count")
    ).select(
        "url_hash",
        "url",
        F.col("latest.last_crawled").alias("last_crawled"),
        F.col("latest.pdf_count").alias("pdf_count"),
        "crawl_count",
    )


_KINDS = {
    "documents": (schemas.DOC_CACHE, document_delta, merge_documents),
    "pages": (schemas.PAGE_CACHE, page_delta, merge_pages),
}


def stream_upserts(changes: DataFrame, kind: str, path: str, checkpoint: str) -> StreamingQuery:
    """Start writing deltas of ``kind`` (``documents`` or ``pages``) under ``path``."""
    _, delta, _ = _KINDS[kind]

    def write(batch: DataFrame, batch_id: int) -> None:
        delta(batch).write.mode("overwrite").parquet(f"{path}/delta/batch_id={batch_id}")

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _deltas(spark: SparkSession, kind: str, path: str, first: int, last: int | None = None) -> DataFrame:
    """Rows of the complete deltas from batch ``first`` on, to ``last`` if given."""
    numbers = [n for n in completed(spark, f"{path}/delta", "batch_id") if n >= first and (last is None or n <= last)]
    schema = _KINDS[kind][0]
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/delta/batch_id={n}" for n in numbers])


def _folded(spark: SparkSession, path: str) -> int:
    """Number of the first batch that the compacted state doesn't hold; also the number of its version."""
    return max(versions(spark, f"{path}/compacted/manifest"), default=0)


def streamed_state(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """The state as of the last complete batch."""
    schema, _, merge = _KINDS[kind]
    base = buckets.load_buckets(spark, f"{path}/compacted", schema)
    return merge(base.unionByName(_deltas(spark, kind, path, _folded(spark, path))))


def compact(spark: SparkSession, kind: str, path: str, through_batch: int, keep: int = 2) -> None:
    """Fold the deltas up to ``through_batch`` into the buckets they touch, and remove what the last ``keep`` versions don't need."""
    schema, _, merge = _KINDS[kind]
    folded = _folded(spark, path)
    if through_batch < folded:
        return
    deltas = _deltas(spark, kind, path, folded, through_batch)
    place = f"{path}/compacted"
    buckets.merge_buckets(
        spark, place, schema, deltas, lambda base, new: merge(base.unionByName(new)), version=through_batch + 1
    )
    prune(spark, path, keep)


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove buckets and deltas that none of the last ``keep`` compacted versions needs."""
    place = f"{path}/compacted"
    buckets.prune_buckets(spark, place, keep)
    # The oldest version that is left needs the deltas from its own number on; alone, it has had a reader before it.
    kept = versions(spark, f"{place}/manifest")
    needed = kept[0] if len(kept) >= keep else 0
    for number in completed(spark, f"{path}/delta", "batch_id"):
        if number < needed:
            remove(spark, f"{path}/delta/batch_id={number}")
