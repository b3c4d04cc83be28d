"""Joins in which one key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``rows`` to a ``lookup`` that is unique by the text column ``key``.

    Adaptive execution splits a hot key's partition only where both inputs
    come straight out of a shuffle. A lookup built by an aggregation on the
    same key would be joined where it lies and leave the hot key whole; as an
    expression of the key it is shuffled once more (it is the small side) and
    the split applies. A lookup below the broadcast limit is still broadcast.
    """
    return rows.join(lookup.withColumn(key, F.concat(F.col(key), F.lit(""))), key, how)


def on_listed(rows: DataFrame, listed: DataFrame, key: Column) -> DataFrame:
    """``rows`` whose ``key`` is in the one column of ``listed`` (unique, a written table).

    The planner knows the bytes of a written table, so it broadcasts a short list
    and shuffles for a long one.
    """
    return rows.join(listed.toDF("listed_key"), key == F.col("listed_key"), "left_semi")
