"""State tables in versions: a run reads the last complete one and writes the next."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _place(spark: SparkSession, path: str):
    """The path and the file system it lies in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def completed(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders ``name=<number>`` under ``path`` whose write left its success mark."""
    pattern, system = _place(spark, f"{path.rstrip('/')}/{name}=*/_SUCCESS")
    found = system.globStatus(pattern) or []
    numbers = [re.search(rf"/{name}=(\d+)/_SUCCESS$", status.getPath().toString()) for status in found]
    return sorted(int(match.group(1)) for match in numbers if match)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions under ``path``: those whose write left its success mark."""
    return completed(spark, path, "version")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    place, system = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.delete(place, True)


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all versions older than the last ``keep`` complete ones, half-written ones among them; the numbers removed.

    ``keep`` is one more than the number of versions that readers may still be behind.
    """
    if keep < 1:
        raise ValueError("the last version has to stay")
    kept = versions(spark, path)[-keep:]
    numbers = [int(n.removeprefix("version=")) for n in children(spark, path) if re.fullmatch(r"version=\d+", n)]
    old = sorted(n for n in numbers if kept and n < kept[0])
    for number in old:
        remove(spark, f"{path.rstrip('/')}/version={number}")
    return old


def load_state(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Last complete version (below ``before`` if given); an empty table if there is none."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/version={known[-1]}")


def save_state(state: DataFrame, path: str, version: int | None = None) -> int:
    """Write a new version and return its number.

    The version being read stays untouched, and a half-written one has no
    success mark and is ignored. Writing a given number again replaces it, so
    a repeated streaming batch leaves the same state.
    """
    spark = state.sparkSession
    number = version if version is not None else max(versions(spark, path), default=-1) + 1
    state.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={number}")
    return number
