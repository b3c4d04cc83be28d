"""Retries: which errors are worth one, and how a series of attempts ended."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.fixed import ERROR_ATTEMPTS, MAX_ATTEMPTS, RETRYABLE_ERRORS
from crawlspark.functions.text import fill
from crawlspark.functions.url import contains_any


def is_retryable(error: Column, parts: list[str] | None = None) -> Column:
    """True if the error text names a passing trouble; no text means no retry."""
    return contains_any(F.lower(F.coalesce(error, F.lit(""))), RETRYABLE_ERRORS if parts is None else parts)


def error_class(error: Column, parts: list[str] | None = None) -> Column:
    """First matching part of the error text, or ``other``."""
    text = F.lower(F.coalesce(error, F.lit("")))
    hits = [F.when(text.contains(part), F.lit(part)) for part in (RETRYABLE_ERRORS if parts is None else parts)]
    return F.coalesce(*hits, F.lit("other"))


def error_classes(log: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """Failures (rows with an error) by class: error_class, retryable, failures."""
    return (
        log.where(F.col("error").isNotNull())
        .groupBy(
            error_class(F.col("error"), parts).alias("error_class"),
            is_retryable(F.col("error"), parts).alias("retryable"),
        )
        .agg(F.count("*").alias("failures"))
    )


def fetch_trouble(log: DataFrame) -> DataFrame:
    """Log rows with ``retry``: connection trouble, timeouts and server errors deserve one."""
    text = F.lower(F.coalesce(F.col("error"), F.lit("")))
    trouble = text.contains("timeout") | text.contains("connection")
    return log.withColumn("retry", trouble | F.coalesce(F.col("status") >= 500, F.lit(False)))


def attempt_outcome(attempts: DataFrame, key: str = "url", limit: int = MAX_ATTEMPTS) -> DataFrame:
    """How each url ended: success, error, attempts, planned_wait_s.

    ``attempts``: key, attempt (from 1), success, error. A series stops at the
    first success or the first error not worth a retry, at the latest after
    ``limit`` attempts; the waits in between double from one second.

    Only ``limit`` attempts can matter, so each is picked by a conditional
    aggregate and no window has to sort a long series.
    """
    numbers = range(1, limit + 1)
    picked = (
        attempts.where(F.col("attempt").between(1, limit))
        .groupBy(key)
        .agg(
            *[
                F.max(F.when(F.col("attempt") == n, F.struct("success", "error"))).alias(f"a{n}")
                for n in numbers
            ]
        )
    )

    def seen(n: int) -> Column:
        return F.col(f"a{n}").isNotNull()

    def stops(n: int) -> Column:
        return seen(n) & (F.col(f"a{n}.success") | ~is_retryable(F.col(f"a{n}.error")))

    stopped = F.coalesce(*[F.when(stops(n), F.lit(n)) for n in numbers])
    last = reduce(lambda out, n: F.when(seen(n), F.lit(n)).otherwise(out), numbers, F.lit(0))

    def at(field: str) -> Column:
        return F.coalesce(*[F.when(F.col("used") == n, F.col(f"a{n}.{field}")) for n in numbers])

    final = picked.withColumn("stopped", stopped).withColumn("used", F.coalesce("stopped", last))
    exhausted = F.col("stopped").isNull() & (F.col("used") == limit)
    return final.select(
        key,
        F.coalesce(at("success"), F.lit(False)).alias("success"),
        F.when(exhausted, fill(ERROR_ATTEMPTS, attempts=F.lit(limit), error=at("error")))
        .otherwise(at("error"))
        .alias("error"),
        F.col("used").cast("long").alias("attempts"),
        (F.pow(F.lit(2.0), F.col("used") - 1) - 1).cast("long").alias("planned_wait_s"),
    )
