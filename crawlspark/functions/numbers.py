"""Rounding and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIZE_NAMES = ["B", "KB", "MB", "GB", "TB"]


def round_half_even(value: Column, digits: int) -> Column:
    """Round the binary value of a double exactly, ties to even.

    ``round`` and ``bround`` look at the shortest decimal text of the double,
    so 2.675 (in truth a little less) would go up. Here the product with the
    power of ten is kept as a sum of two doubles, whose tail decides ties.
    """
    x = value.cast("double")
    power = float(10**digits)
    split = x * F.lit(134217729.0)
    high = split - (split - x)
    low = x - high
    product = x * F.lit(power)
    tail = (high * F.lit(power) - product) + low * F.lit(power)
    floor = F.floor(product).cast("double")
    fraction = product - floor
    odd = floor % F.lit(2.0) != 0
    up = (
        (fraction > 0.5)
        | ((fraction == 0.5) & (tail > 0))
        | ((fraction == 0.5) & (tail == 0) & odd)
    )
    return (floor + up.cast("double")) / F.lit(power)


def megabytes(size: Column, digits: int = 2) -> Column:
    return round_half_even(size.cast("double") / F.lit(1048576.0), digits)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, and 0 for an empty whole."""
    return F.when(whole > 0, part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100.0).otherwise(
        F.lit(0.0)
    )


def fixed_point(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded as ``round_half_even``."""
    return F.format_string(f"%.{digits}f", round_half_even(value, digits))


def size_label(size: Column) -> Column:
    """Such as ``1.5 MB``; the unit is the largest that is not above the size."""
    out = F.concat(size.cast("double").cast("string"), F.lit(" B"))
    for step in range(1, len(_SIZE_NAMES)):
        unit = 1024**step
        scaled = round_half_even(size.cast("double") / F.lit(float(unit)), 2)
        out = F.when(size >= unit, F.concat(scaled.cast("string"), F.lit(f" {_SIZE_NAMES[step]}"))).otherwise(out)
    return F.when(size == 0, F.lit("0 B")).otherwise(out)


def duration_label(seconds: Column) -> Column:
    """Such as ``45.0s``, ``2m 5s``, ``2h 15m 30s`` or ``1d 2h 3m``."""
    whole = F.floor(seconds).cast("long")
    return (
        F.when(seconds < 60, F.concat(fixed_point(seconds, 1), F.lit("s")))
        .when(seconds < 3600, F.format_string("%dm %ds", F.floor(whole / 60), whole % 60))
        .when(
            seconds < 86400,
            F.format_string("%dh %dm %ds", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60),
        )
        .otherwise(
            F.format_string("%dd %dh %dm", F.floor(whole / 86400), F.floor(whole / 3600) % 24, F.floor(whole / 60) % 60)
        )
    )
