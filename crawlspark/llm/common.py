"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; this helps
    where the workers see the driver's folder but not its module path.
    """
    here = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = f"{here}{os.pathsep}{known}".rstrip(os.pathsep)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """Fold of a row: crc32 of its id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def in_fold(id_col: str, folds: int, number: int) -> Column:
    """True for the rows of one fold; a row without an id is in none."""
    return F.coalesce(fold(id_col, folds) == number, F.lit(False))


def uniform(*cols: str, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) for each value of ``cols``."""
    return (F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))


def chunks_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs (start, stop) of items whose sizes add up to ``most`` at the most, one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
