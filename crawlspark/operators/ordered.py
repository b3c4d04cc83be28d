"""Running values over long ordered groups.

A window per key would put a busy key into one task. Here rows are range
partitioned on (key, order), so a busy key spreads over many partitions, its
chunks. Windows run inside a chunk; what one chunk passes to the next comes
from a table with one row per (key, chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage


def ordered_chunks(df: DataFrame, key: str, order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` with a column ``chunk`` that numbers contiguous ranges of (key, order).

    The result is written out: every later branch has to see the same chunk
    borders, also when a lost task is run again.
    """
    count = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(count, key, *order).withColumn("chunk", F.spark_partition_id())
    return cut_lineage(spread, "ordered-chunks")


def with_carry(df: DataFrame, per_chunk: DataFrame, key: str, value: Column) -> DataFrame:
    """``df`` with ``carry``: ``value`` over the key's earlier chunks, NULL where there are none.

    At most one key of a chunk began in an earlier chunk, so the table of
    carries has fewer rows than there are chunks and may be broadcast.
    """
    carries = per_chunk.select(
        F.col(key).alias("carry_key"), F.col("chunk").alias("carry_chunk"), value.alias("carry")
    ).where(F.col("carry").isNotNull())
    same = F.col(key).eqNullSafe(F.col("carry_key")) & (F.col("chunk") == F.col("carry_chunk"))
    return df.join(F.broadcast(carries), same, "left").drop("carry_key", "carry_chunk")


def previous_value(df: DataFrame, key: str, order: list[str], value: str, chunks: int | None = None) -> DataFrame:
    """``df`` with ``previous``: ``value`` of the row before within ``key``, NULL for the first."""
    split = ordered_chunks(df, key, order, chunks)
    inside = Window.partitionBy(key, "chunk").orderBy(*order)
    last_of_chunk = split.groupBy(key, "chunk").agg(
        F.max(F.struct(*order, F.col(value).alias("last_value")))["last_value"].alias("last_value")
    )
    local = split.withColumn("previous", F.lag(value).over(inside)).withColumn(
        "first_in_chunk", F.row_number().over(inside) == 1
    )
    last_before = F.lag("last_value").over(Window.partitionBy(key).orderBy("chunk"))
    return (
        with_carry(local, last_of_chunk, key, last_before)
        .withColumn("previous", F.when(F.col("first_in_chunk"), F.col("carry")).otherwise(F.col("previous")))
        .drop("carry", "first_in_chunk", "chunk")
    )


def row_numbers(df: DataFrame, key: str, order: list[str], name: str, chunks: int | None = None) -> DataFrame:
    """``df`` with the row number (from 1) within ``key`` in a column ``name``."""
    split = ordered_chunks(df, key, order, chunks)
    inside = Window.partitionBy(key, "chunk").orderBy(*order)
    sizes = split.groupBy(key, "chunk").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    local = split.withColumn(name, F.row_number().over(inside).cast("long"))
    return (
        with_carry(local, sizes, key, F.sum("size").over(earlier))
        .withColumn(name, F.col(name) + F.coalesce("carry", F.lit(0)))
        .drop("carry", "chunk")
    )


def last_known(df: DataFrame, key: str, order: list[str], value: str, chunks: int | None = None) -> DataFrame:
    """``df`` with ``value`` filled down: where it is NULL, the last one before within ``key`` that is not."""
    split = ordered_chunks(df, key, order, chunks)
    inside = Window.partitionBy(key, "chunk").orderBy(*order)
    passed_on = split.groupBy(key, "chunk").agg(
        F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("held")))).alias("last")
    )
    earlier = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    local = split.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    filled = with_carry(local, passed_on, key, F.last("last.held", ignorenulls=True).over(earlier))
    return filled.withColumn(value, F.coalesce(value, "carry")).drop("carry", "chunk")


def largest_before(df: DataFrame, key: str, order: list[str], value: str, name: str, chunks: int | None = None) -> DataFrame:
    """``df`` with ``name``: the largest ``value`` of all rows before within ``key``, NULL for the first."""
    split = ordered_chunks(df, key, order, chunks)
    before = Window.partitionBy(key, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    largest = split.groupBy(key, "chunk").agg(F.max(value).alias("largest"))
    earlier = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    local = split.withColumn(name, F.max(value).over(before))
    carried = with_carry(local, largest, key, F.max("largest").over(earlier))
    return carried.withColumn(name, F.greatest(name, "carry")).drop("carry", "chunk")
