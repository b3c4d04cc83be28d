"""Validation of document URLs and contents, and the outcome of a download."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.fixed import (
    ERROR_BAD_CONTENT,
    ERROR_BAD_URL,
    ERROR_NETWORK,
    ERROR_NOT_SAVED,
    ERROR_STATUS,
    ERROR_TOO_LARGE,
    MAX_DOCUMENT_MB,
    MIN_DOCUMENT_BYTES,
    TRAILER_WINDOW,
)
from crawlspark.functions.numbers import fixed_point
from crawlspark.functions.text import fill
from crawlspark.operators.lookup import join_lookup

PDF_SIGNATURE = bytearray(b"%PDF")
PDF_HEADER = bytearray(b"%PDF-")
PDF_TRAILER = bytearray(b"%%EOF")


def _text(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def _is_signed(url: Column) -> Column:
    signed = url.contains("X-Amz-Signature") | url.contains("X-Amz-Algorithm")
    return signed & (F.lower(url).endswith(".pdf") | F.lower(url).contains(".pdf?"))


def url_verdicts(candidates: DataFrame, heads: DataFrame) -> DataFrame:
    """Candidates (url, ...) with ``valid`` and ``verdict`` from the latest HEAD per url.

    Signed addresses pass unseen. Else the status must be 200 and one of
    content type, URL ending or content disposition must speak of a document.
    """
    answers = heads.select("url", "status", "content_type", "content_disposition")
    verdict = (
        F.when(_is_signed(F.col("url")), F.lit("signed"))
        .when(F.col("status").isNull(), F.lit("no answer"))
        .when(F.col("status") != 200, F.lit("bad status"))
        .when(_text("content_type").contains("application/pdf"), F.lit("content type"))
        .when(F.lower("url").endswith(".pdf"), F.lit("url ending"))
        .when(_text("content_disposition").contains(".pdf"), F.lit("disposition"))
        .otherwise(F.lit("not a document"))
    )
    return (
        candidates.join(answers, "url", "left")
        .select(*candidates.columns, verdict.alias("verdict"))
        .withColumn("valid", F.col("verdict").isin("signed", "content type", "url ending", "disposition"))
    )


def sniffed_verdicts(candidates: DataFrame, heads: DataFrame, bodies: DataFrame) -> DataFrame:
    """Variant without the URL rules: a vague content type is settled by the first bytes.

    Only the first bytes of a body leave its scan.
    """
    answers = heads.select("url", "status", "content_type", "content_disposition")
    starts = bodies.select("url", F.col("body").startswith(F.lit(PDF_SIGNATURE)).alias("has_signature"))
    vague = _text("content_type").isin("", "application/octet-stream")
    verdict = (
        F.when(F.col("status").isNull(), F.lit("no answer"))
        .when(F.col("status") != 200, F.lit("bad status"))
        .when(_text("content_type").contains("application/pdf"), F.lit("content type"))
        .when(_text("content_disposition").contains(".pdf"), F.lit("disposition"))
        .when(vague & F.coalesce("has_signature", F.lit(False)), F.lit("signature"))
        .otherwise(F.lit("not a document"))
    )
    return (
        candidates.join(answers, "url", "left")
        .join(starts, "url", "left")
        .select(*candidates.columns, verdict.alias("verdict"))
        .withColumn("valid", F.col("verdict").isin("content type", "disposition", "signature"))
    )


def content_reason(
    body: Column, header: bytes = PDF_HEADER, min_bytes: int = MIN_DOCUMENT_BYTES
) -> Column:
    """Why a body is no valid document, or ``ok``."""
    return (
        F.when(F.coalesce(F.octet_length(body), F.lit(0)) == 0, F.lit("empty"))
        .when(~body.startswith(F.lit(bytearray(header))), F.lit("wrong header"))
        .when(F.octet_length(body) < min_bytes, F.lit("too short"))
        .otherwise(F.lit("ok"))
    )


def has_trailer(body: Column, trailer: bytes = PDF_TRAILER, window: int = TRAILER_WINDOW) -> Column:
    """True if the last bytes hold the trailer; a missing one only warns."""
    end = F.substr(body, F.greatest(F.octet_length(body) - window + 1, F.lit(1)))
    return F.contains(end, F.lit(bytearray(trailer)))


def content_checks(
    bodies: DataFrame,
    header: bytes = PDF_HEADER,
    trailer: bytes = PDF_TRAILER,
    min_bytes: int = MIN_DOCUMENT_BYTES,
) -> DataFrame:
    """Per body: bytes, file_hash, reason, valid, has_trailer; the body itself is dropped.

    All of it comes out of the one scan that reads the bodies, so none is shuffled.
    """
    body = F.col("body")
    return bodies.select(
        *[c for c in bodies.columns if c != "body"],
        F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("bytes"),
        F.sha2(body, 256).alias("file_hash"),
        content_reason(body, header, min_bytes).alias("reason"),
        F.coalesce(has_trailer(body, trailer), F.lit(False)).alias("has_trailer"),
    ).withColumn("valid", F.col("reason") == "ok")


def content_summary(checks: DataFrame) -> DataFrame:
    """Checks grouped by reason: bodies, bytes, without_trailer."""
    return checks.groupBy("reason").agg(
        F.count("*").alias("bodies"),
        F.sum("bytes").alias("bytes"),
        F.count_if(~F.col("has_trailer")).alias("without_trailer"),
    )


def oversized(heads: DataFrame, max_mb: float = MAX_DOCUMENT_MB) -> DataFrame:
    """Observations above the size limit, with the error text."""
    size_mb = F.col("content_length").cast("double") / F.lit(1048576.0)
    return heads.where(size_mb > max_mb).select(
        "url",
        "content_length",
        fill(ERROR_TOO_LARGE, megabytes=fixed_point(size_mb, 1)).alias("error"),
    )


def download_outcome(
    candidates: DataFrame,
    decisions: DataFrame,
    verdicts: DataFrame,
    gets: DataFrame,
    checks: DataFrame,
    stored: DataFrame,
    unsaved: DataFrame | None = None,
    max_mb: float | None = None,
) -> DataFrame:
    """One result row per candidate (department, url, local_path; each pair once).

    In order: unchanged file (success with the stored size), invalid URL,
    network error, too large, invalid content, not saved, downloaded.
    ``decisions`` has (url, local_path, download), as two departments may hold
    different files of a url; ``verdicts`` (url, valid), ``gets`` the
    latest GET per url, ``checks`` (url, bytes, valid), ``stored`` (local_path,
    file_size), ``unsaved`` urls that could not be written.
    """
    sizes = stored.groupBy("local_path").agg(F.max("file_size").alias("stored_size"))
    bad = (
        unsaved.select("url").distinct().withColumn("is_unsaved", F.lit(True))
        if unsaved is not None
        else None
    )
    asked = gets.select(
        "url",
        F.col("status").alias("get_status"),
        F.col("error").alias("get_error"),
        F.col("content_length").alias("get_length"),
    )
    joined = (
        join_lookup(candidates, sizes, "local_path")
        .join(decisions.groupBy("url", "local_path").agg(F.bool_or("download").alias("download")), ["url", "local_path"], "left")
        .join(verdicts.groupBy("url").agg(F.bool_or("valid").alias("url_valid")), "url", "left")
        .join(asked, "url", "left")
        .join(checks.select("url", F.col("bytes"), F.col("valid").alias("content_valid")), "url", "left")
    )
    joined = joined.join(bad, "url", "left") if bad is not None else joined.withColumn("is_unsaved", F.lit(False))
    size_mb = F.col("get_length").cast("double") / F.lit(1048576.0)
    network = F.coalesce(
        F.col("get_error"), F.when(F.col("get_status") != 200, fill(ERROR_STATUS, status=F.col("get_status")))
    )
    unchanged = ~F.coalesce("download", F.lit(True))
    error = (
        F.when(unchanged, F.lit(None).cast("string"))
        .when(~F.coalesce("url_valid", F.lit(False)), F.lit(ERROR_BAD_URL))
        .when(network.isNotNull(), fill(ERROR_NETWORK, error=network))
    )
    if max_mb is not None:
        error = error.when(
            size_mb > max_mb, fill(ERROR_TOO_LARGE, megabytes=fixed_point(size_mb, 1))
        )
    error = error.when(~F.coalesce("content_valid", F.lit(False)), F.lit(ERROR_BAD_CONTENT)).when(
        F.coalesce("is_unsaved", F.lit(False)), F.lit(ERROR_NOT_SAVED)
    )
    out = joined.withColumn("error", error).withColumn("success", F.col("error").isNull())
    return out.select(
        "department",
        "url",
        "success",
        F.when(F.col("success"), F.col("local_path")).alias("file_path"),
        "error",
        F.when(~F.col("success"), F.lit(0))
        .when(unchanged, F.coalesce("stored_size", F.lit(0)))
        .otherwise(F.coalesce("bytes", F.lit(0)))
        .cast("long")
        .alias("file_size"),
        (F.col("success") & unchanged).alias("skipped"),
    )


def config_violations(departments: DataFrame, seeds: DataFrame) -> DataFrame:
    """Broken configuration as rows: dept_key, violation. No departments at all is one row too."""
    unnamed = departments.where(F.coalesce(F.trim("name"), F.lit("")) == "").select(
        "dept_key", F.lit("department has no name").alias("violation")
    )
    seedless = departments.join(
        seeds.where(F.col("url").isNotNull()).select("dept_key"), "dept_key", "left_anti"
    ).select("dept_key", F.lit("department has no seed url").alias("violation"))
    none = (
        departments.agg(F.count("*").alias("n"))
        .where(F.col("n") == 0)
        .select(F.lit(None).cast("string").alias("dept_key"), F.lit("no departments").alias("violation"))
    )
    return unnamed.unionByName(seedless).unionByName(none)
