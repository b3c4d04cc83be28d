"""Reading input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark import schemas


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: page_id, url, html."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.PAGES).parquet(path)


def read_fetch_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """HEAD and GET observations. Text formats give ts in seconds of the epoch; a broken row fails the read."""
    if fmt == "parquet":
        return spark.read.schema(schemas.FETCH_LOG).parquet(path)
    raw = schemas.T.StructType(
        [
            schemas.T.StructField(f.name, schemas.T.DoubleType() if f.name == "ts" else f.dataType)
            for f in schemas.FETCH_LOG
        ]
    )
    rows = spark.read.schema(raw).option("mode", "FAILFAST").format(fmt).load(path)
    return rows.withColumn("ts", F.timestamp_micros((F.col("ts") * 1_000_000).cast("long")))


def read_robots_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ROBOTS_RULES).parquet(path)


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SITEMAPS).parquet(path)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BODIES).parquet(path)
