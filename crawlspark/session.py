"""Session settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # First-seen keys of a whole retention period do not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app: str = "crawlspark", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; keyword arguments use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs this store; a session from elsewhere may have another."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage, as the cluster names it in spark.checkpoint.dir.

    Where that is unset, the warehouse, which all executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")

