"""State in buckets: a run reads and rewrites only the buckets that it changes.

Rows are dealt to buckets by the first hexadecimal digits of ``url_hash``. A
version of the state is a manifest, one row per bucket, that names the version
whose write holds the bucket's rows. A run writes the buckets it changes and a
manifest that points to them, and carries all other buckets over by name. It
counts once the manifest has its success mark, so a reader sees one version
or the next, and a run that failed leaves only files that nothing names.

A manifest has 16 ** digits rows at most; it is all that the driver holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.lineage import cut_lineage
from crawlspark.operators.incremental import url_hash
from crawlspark.sources.state import children, remove, save_state, versions

#: Hexadecimal digits of a bucket's name; 256 buckets.
DIGITS = 2

MANIFEST = "bucket string, version long"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket_of(key: Column, digits: int = DIGITS) -> Column:
    return F.coalesce(F.substring(key, 1, digits), F.lit("none"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, int]:
    """Which version's write holds each bucket, as of ``version`` (the last complete one if not given)."""
    known = versions(spark, f"{path}/manifest")
    if version is None:
        version = max(known, default=-1)
    if version not in known:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={version}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def load_buckets(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None, only: set[str] | None = None
) -> DataFrame:
    """The rows of a version, of the buckets ``only`` if given; the plan names no other folder."""
    held = manifest(spark, path, version)
    folders = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(held.items()) if only is None or b in only]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def merge_buckets(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    changes: DataFrame,
    merge: Merge,
    digits: int = DIGITS,
    version: int | None = None,
) -> int:
    """Write the next version, ``merge(rows, changes)`` in the buckets of ``changes``, and return its number.

    ``changes`` has url or url_hash. ``digits`` is fixed by the first version.
    Writing a given version again starts from the same one before.
    """
    known = versions(spark, f"{path}/manifest")
    before = max((v for v in known if version is None or v < version), default=-1)
    number = before + 1 if version is None else version
    held = manifest(spark, path, before)
    width = max((len(b) for b in held if b != "none"), default=digits)
    key = F.col("url_hash") if "url_hash" in changes.columns else url_hash(F.col("url"))
    rows = cut_lineage(changes.withColumn("bucket", bucket_of(key, width)), "bucket-changes")
    # At most as many rows as a manifest has.
    touched = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
    merged = merge(load_buckets(spark, path, schema, before, touched), rows.drop("bucket"))
    written = f"{path}/data/version={number}"
    dealt = merged.select(*schema.fieldNames()).withColumn("bucket", bucket_of(F.col("url_hash"), width))
    # Few files for a small bucket, several for a large one.
    dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(written)
    filled = {name.removeprefix("bucket=") for name in children(spark, written) if name.startswith("bucket=")}
    new = {b: v for b, v in held.items() if b not in touched} | {b: number for b in filled}
    rows_of_manifest = spark.createDataFrame(sorted(new.items()), MANIFEST)
    return save_state(rows_of_manifest.coalesce(1), f"{path}/manifest", number)


def live_folders(spark: SparkSession, path: str, keep: int = 1) -> set[tuple[int, str]]:
    """(version, bucket) of the folders that the last ``keep`` manifests name."""
    kept = versions(spark, f"{path}/manifest")[-keep:]
    return {(v, b) for number in kept for b, v in manifest(spark, path, number).items()}


def prune_buckets(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the folders that none of the last ``keep`` manifests names, and older manifests; how many folders went.

    ``keep`` is one more than the number of versions that readers may still be
    behind. A folder of a run that hasn't written its manifest is newer than all
    of them and stays.
    """
    if keep < 1:
        raise ValueError("the last version has to stay")
    known = versions(spark, f"{path}/manifest")
    live = live_folders(spark, path, keep)
    # Manifests go first: none is left that names a folder which is gone.
    for number in known[:-keep]:
        remove(spark, f"{path}/manifest/version={number}")
    gone = 0
    for name in children(spark, f"{path}/data"):
        match = re.fullmatch(r"version=(\d+)", name)
        if not match or int(match.group(1)) > max(known, default=-1):
            continue
        version = int(match.group(1))
        buckets = [b.removeprefix("bucket=") for b in children(spark, f"{path}/data/{name}") if b.startswith("bucket=")]
        dead = [b for b in buckets if (version, b) not in live]
        for bucket in dead:
            remove(spark, f"{path}/data/{name}/bucket={bucket}")
        if len(dead) == len(buckets):
            remove(spark, f"{path}/data/{name}")
        gone += len(dead)
    return gone
