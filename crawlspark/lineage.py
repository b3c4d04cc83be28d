"""Cut the lineage of a DataFrame through a written table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from crawlspark.session import checkpoint_root


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and read it back.

    A table rather than a cached RDD: it survives lost executors, a later plan
    prunes its columns, and its known size lets the planner pick a broadcast
    before anything is shuffled.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage_dealt(df: DataFrame, label: str, key: str) -> DataFrame:
    """``cut_lineage`` into as many buckets of ``key`` as shuffles have partitions.

    Later plans know where the rows of a key lie, and group or join them by it
    without a shuffle. ``df`` should lie by ``key`` already, or each task writes
    a file for every bucket. The table's name goes at once, as only the returned
    plan reads it; its files stay until ``remove_run_tables``.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}-{uuid.uuid4().hex}"
    table = f"spark_catalog.default.{name.replace('-', '_')}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", f"{run_folder(spark)}/{name}").saveAsTable(table)
    dealt = spark.table(table)
    # The table is external, so this leaves its files.
    spark.sql(f"DROP TABLE {table}")
    return dealt


def run_folder(spark: SparkSession, root: str | None = None) -> str:
    """Folder of this application's tables under the shared folder."""
    return f"{root or checkpoint_root(spark)}/crawlspark/{spark.sparkContext.applicationId}"


def remove_run_tables(spark: SparkSession, root: str | None = None) -> bool:
    """Delete the tables that this application has cut its lineage with, once no plan reads them any more.

    ``root`` names another shared folder than the session's.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark, root))
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
