"""Where documents are stored, and which of them get in each other's way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.names import file_name, local_path, object_key, portable_name
from crawlspark.operators.lookup import join_lookup


def with_layout(
    documents: DataFrame,
    base: str = "./downloads",
    prefix: str | None = None,
    by_department: bool = True,
    title: Column | None = None,
) -> DataFrame:
    """Documents (url, department, ...) with file_name, local_path and s3_key."""
    named = documents.withColumn("file_name", file_name(F.col("url"), title))
    return named.withColumn(
        "local_path", local_path(base, F.col("department"), F.col("file_name"), by_department)
    ).withColumn("s3_key", object_key(prefix, F.col("department"), F.col("file_name"), by_department))


def path_collisions(layout: DataFrame, path: str = "local_path") -> DataFrame:
    """Paths that several urls map to: path, urls, first_url."""
    pairs = layout.groupBy(path, "url").agg(F.lit(1).alias("one"))
    return (
        pairs.groupBy(path)
        .agg(F.count("*").alias("urls"), F.min("url").alias("first_url"))
        .where(F.col("urls") > 1)
    )


def changed_names(names: DataFrame) -> DataFrame:
    """Stored names (name) that are not portable, with the portable form and how many names share it."""
    distinct = names.select("name").distinct().withColumn("portable", portable_name(F.col("name")))
    shared = distinct.groupBy("portable").agg(F.count("*").alias("sharing"))
    changed = distinct.where(F.col("name") != F.col("portable"))
    return join_lookup(changed, shared, "portable", "inner").select("name", "portable", "sharing")


def content_duplicates(files: DataFrame) -> DataFrame:
    """Stored hashes that occur more than once: file_hash, copies, first_url, wasted_bytes.

    ``files`` is the registry or any table with url, file_hash, file_size.
    """
    return (
        files.groupBy("file_hash")
        .agg(
            F.count("*").alias("copies"),
            F.min("url").alias("first_url"),
            (F.sum("file_size") - F.max("file_size")).alias("wasted_bytes"),
        )
        .where(F.col("copies") > 1)
    )


def batch_summary(results: DataFrame) -> DataFrame:
    """One row: successful, failed, bytes of the successes."""
    return results.agg(
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("file_size"))), F.lit(0)).cast("long").alias("total_size"),
    )
