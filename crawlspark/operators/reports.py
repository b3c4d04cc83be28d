"""Department and overall results, report rows and lines, dry-run analysis, counters.

Error texts stay rows: a department may have millions of them. Reports show
the first few and the count; the full list is a listing of its own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.functions.fixed import (
    ADVICE_BROWSER,
    ADVICE_INACCESSIBLE,
    ADVICE_LONG,
    ADVICE_MANY,
    ADVICE_RATE_LIMIT,
    CSV_COLUMNS,
    ERROR_DOWNLOAD,
    ISSUE_CONNECTION,
    ISSUE_OTHER,
    ISSUE_RATE_LIMIT,
    ISSUE_STATUS,
    ISSUE_TIMEOUT,
    LONG_RUN_SECONDS,
    MANY_DOCUMENTS,
    REPORT_DEPARTMENT,
    REPORT_ERROR,
    REPORT_ERRORS,
    REPORT_FOOT,
    REPORT_HEAD,
    REPORT_MORE,
    REPORT_RATE,
    SCRIPT_LIMIT,
    SECONDS_PER_DOCUMENT,
)
from crawlspark.functions.numbers import fixed_point, megabytes, percent, round_half_even
from crawlspark.functions.text import fill


def department_results(
    results: DataFrame, crawled: DataFrame | None = None, durations: DataFrame | None = None
) -> DataFrame:
    """Per department: urls_crawled, pdfs_found, downloaded, failed, skipped, total_size, duration, error_count.

    ``results``: download outcomes (department, success, error, file_size,
    optionally skipped). ``crawled``: (department, urls_crawled).
    ``durations``: (department, duration in seconds). A department that was
    crawled without finding anything is kept.
    """
    skipped = F.count_if("skipped") if "skipped" in results.columns else F.lit(0).cast("long")
    out = results.groupBy("department").agg(
        F.count("*").alias("pdfs_found"),
        F.count_if("success").alias("pdfs_downloaded"),
        F.count_if(~F.col("success")).alias("pdfs_failed"),
        skipped.alias("pdfs_skipped"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("file_size"))), F.lit(0)).cast("long").alias("total_size"),
        F.count_if(~F.col("success") & F.col("error").isNotNull()).alias("error_count"),
    )
    counters = ["pdfs_found", "pdfs_downloaded", "pdfs_failed", "pdfs_skipped", "total_size", "error_count"]
    if crawled is not None:
        out = out.join(crawled.select("department", "urls_crawled"), "department", "full_outer")
    else:
        out = out.withColumn("urls_crawled", F.lit(0).cast("long"))
    if durations is not None:
        out = out.join(durations.select("department", "duration"), "department", "left")
    else:
        out = out.withColumn("duration", F.lit(0.0))
    filled = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ["urls_crawled", *counters]]
    return out.select("department", *filled, F.coalesce("duration", F.lit(0.0)).alias("duration"))


def department_errors(results: DataFrame) -> DataFrame:
    """Error texts of failed downloads: department, url, error."""
    return results.where(~F.col("success") & F.col("error").isNotNull()).select(
        "department", "url", fill(ERROR_DOWNLOAD, url=F.col("url"), error=F.col("error")).alias("error")
    )


def first_errors(errors: DataFrame, count: int = 3) -> DataFrame:
    """The first errors of each department in url order: department, errors (array of at most ``count``)."""
    order = Window.partitionBy("department").orderBy("url", "error")
    few = errors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
    return few.groupBy("department").agg(
        F.array_sort(F.collect_list(F.struct("place", "error"))).alias("listed")
    ).select("department", F.col("listed.error").alias("errors"))


def overall_results(departments: DataFrame) -> DataFrame:
    """One row of totals with the success rate (0 when nothing was found)."""
    totals = departments.agg(
        F.count("*").alias("departments"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"total_{c}")
            for c in ["pdfs_found", "pdfs_downloaded", "pdfs_failed", "pdfs_skipped"]
        ],
        F.coalesce(F.sum("total_size"), F.lit(0)).cast("long").alias("total_size_bytes"),
        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration"),
    )
    return totals.withColumn("success_rate", percent(F.col("total_pdfs_downloaded"), F.col("total_pdfs_found")))


def results_with_total(results: DataFrame) -> DataFrame:
    """Department rows and the grand total (department NULL) in one pass."""
    out = results.rollup("department").agg(
        F.grouping("department").cast("int").alias("is_total"),
        F.count("*").alias("pdfs_found"),
        F.count_if("success").alias("pdfs_downloaded"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("file_size"))), F.lit(0)).cast("long").alias("total_size"),
    )
    return out.withColumn("success_rate", percent(F.col("pdfs_downloaded"), F.col("pdfs_found")))


def report_rows(departments: DataFrame) -> DataFrame:
    """Columns of the CSV report: MB to 2 places, minutes to 2, rate to 1."""
    rate = percent(F.col("pdfs_downloaded"), F.col("pdfs_found"))
    values = [
        F.col("department"),
        F.col("urls_crawled"),
        F.col("pdfs_found"),
        F.col("pdfs_downloaded"),
        F.col("pdfs_failed"),
        F.col("pdfs_skipped"),
        megabytes(F.col("total_size")),
        round_half_even(F.col("duration") / 60.0, 2),
        round_half_even(rate, 1),
        F.col("error_count"),
    ]
    return departments.select(*[value.alias(name) for value, name in zip(values, CSV_COLUMNS, strict=True)])


def _lines(block: int, department: Column, lines: Column) -> list[Column]:
    return [
        F.lit(block).alias("block"),
        department.alias("department"),
        F.posexplode(lines).alias("line_no", "line"),
    ]


def _shown_megabytes(size: str) -> Column:
    return fixed_point(F.col(size).cast("double") / F.lit(1048576.0), 2)


def report_lines(
    departments: DataFrame,
    errors: DataFrame,
    finished: datetime,
    title: str = "CRAWL - FINAL REPORT",
    shown_errors: int = 3,
) -> DataFrame:
    """The text report as lines: block, department, line_no, line.

    Sorting by (block, department, line_no) gives the report; no line has to
    know its number in the whole report.
    """
    totals = {
        "title": F.lit(title),
        "finished": F.lit(f"{finished:%Y-%m-%d %H:%M:%S}"),
        "minutes": fixed_point(F.col("total_duration") / 60.0, 2),
        "found": F.col("total_pdfs_found"),
        "downloaded": F.col("total_pdfs_downloaded"),
        "failed": F.col("total_pdfs_failed"),
        "skipped": F.col("total_pdfs_skipped"),
        "rate": fixed_point(F.col("success_rate"), 1),
        "megabytes": _shown_megabytes("total_size_bytes"),
    }
    overall = overall_results(departments)
    nobody = F.lit("")
    head = overall.select(*_lines(0, nobody, F.array(*[fill(line, **totals) for line in REPORT_HEAD])))
    foot = overall.select(*_lines(2, nobody, F.array(*[F.lit(line) for line in REPORT_FOOT])))

    values = {
        "department": F.col("department"),
        "crawled": F.col("urls_crawled"),
        "found": F.col("pdfs_found"),
        "downloaded": F.col("pdfs_downloaded"),
        "failed": F.col("pdfs_failed"),
        "skipped": F.col("pdfs_skipped"),
        "megabytes": _shown_megabytes("total_size"),
        "minutes": fixed_point(F.col("duration") / 60.0, 2),
    }
    rate = percent(F.col("pdfs_downloaded"), F.col("pdfs_found"))
    more = F.col("error_count") - shown_errors
    none = F.array().cast("array<string>")

    def line_if(condition: Column, line: Column) -> Column:
        return F.when(condition, F.array(line)).otherwise(none)

    blocks = F.concat(
        F.array(*[fill(line, **values) for line in REPORT_DEPARTMENT]),
        line_if(F.col("pdfs_found") > 0, fill(REPORT_RATE, rate=fixed_point(rate, 1))),
        line_if(F.col("error_count") > 0, fill(REPORT_ERRORS, count=F.col("error_count"))),
        F.transform(F.coalesce("errors", none), lambda error: fill(REPORT_ERROR, error=error)),
        line_if(more > 0, fill(REPORT_MORE, more=more)),
    )
    body = departments.join(first_errors(errors, shown_errors), "department", "left").select(
        *_lines(1, F.col("department"), blocks)
    )
    return head.unionByName(body).unionByName(foot)


def average_speed(departments: DataFrame) -> DataFrame:
    """One row: downloads per minute, NULL for a run without duration."""
    return overall_results(departments).select(
        (F.col("total_pdfs_downloaded") / F.nullif(F.col("total_duration") / 60.0, F.lit(0.0))).alias("pdfs_per_minute")
    )


def seed_findings(seeds: DataFrame, gets: DataFrame, weights: DataFrame, script_limit: int = SCRIPT_LIMIT) -> DataFrame:
    """Per seed (dept_key, seed_ord, url): what a dry run sees.

    ``gets``: latest GET per url. ``weights``: url, script_signs, document_count.
    """
    joined = seeds.join(gets.select("url", "status", F.col("error").alias("get_error")), "url", "left").join(
        weights.select("url", "script_signs", "document_count"), "url", "left"
    )
    text = F.lower(F.coalesce("get_error", F.lit("")))
    documents = F.coalesce("document_count", F.lit(0))
    issue = (
        F.when(F.col("status") == 200, F.lit(None).cast("string"))
        .when(F.col("status") == 429, fill(ISSUE_RATE_LIMIT, url=F.col("url")))
        .when(F.col("status").isNotNull(), fill(ISSUE_STATUS, status=F.col("status"), url=F.col("url")))
        .when(text.contains("timeout"), fill(ISSUE_TIMEOUT, url=F.col("url")))
        .when((text == "") | text.contains("connection"), fill(ISSUE_CONNECTION, url=F.col("url")))
        .otherwise(fill(ISSUE_OTHER, url=F.col("url"), error=F.col("get_error")))
    )
    accessible = F.coalesce(F.col("status") == 200, F.lit(False))
    return joined.select(
        "dept_key",
        "seed_ord",
        "url",
        accessible.alias("accessible"),
        F.when(accessible, documents).otherwise(0).cast("long").alias("documents"),
        (accessible & (F.coalesce("script_signs", F.lit(0)) > script_limit) & (documents == 0)).alias("requires_browser"),
        F.coalesce(F.col("status") == 429, F.lit(False)).alias("rate_limited"),
        issue.alias("issue"),
    )


def dry_run_by_department(findings: DataFrame) -> DataFrame:
    """Per department: seeds, accessible seeds, estimated documents, flags, number of issues."""
    return findings.groupBy("dept_key").agg(
        F.count_if("accessible").alias("seed_urls_accessible"),
        F.count("*").alias("seed_urls_total"),
        F.sum("documents").cast("long").alias("estimated_pdfs"),
        F.bool_or("requires_browser").alias("requires_browser"),
        F.bool_or("rate_limited").alias("rate_limit_detected"),
        F.count("issue").alias("issue_count"),
    )


def dry_run_issues(findings: DataFrame) -> DataFrame:
    """Distinct issues: dept_key, issue."""
    return findings.where(F.col("issue").isNotNull()).select("dept_key", "issue").distinct()


def dry_run_totals(analyses: DataFrame, seconds_per_pdf: float = SECONDS_PER_DOCUMENT) -> DataFrame:
    """One row: estimated documents and duration, number of issues."""
    totals = analyses.agg(
        F.count("*").alias("departments"),
        F.coalesce(F.sum("estimated_pdfs"), F.lit(0)).cast("long").alias("total_estimated_pdfs"),
        F.coalesce(F.sum("issue_count"), F.lit(0)).cast("long").alias("issues"),
    )
    return totals.withColumn("estimated_duration", F.col("total_estimated_pdfs") * F.lit(float(seconds_per_pdf)))


def dry_run_recommendations(
    analyses: DataFrame,
    seconds_per_pdf: float = SECONDS_PER_DOCUMENT,
    many_pdfs: int = MANY_DOCUMENTS,
    long_run_seconds: float = LONG_RUN_SECONDS,
) -> DataFrame:
    """Distinct recommendations, one per row."""
    totals = dry_run_totals(analyses, seconds_per_pdf)
    per_department = analyses.select(
        F.explode(
            F.array(
                F.when(F.col("requires_browser"), fill(ADVICE_BROWSER, department=F.col("dept_key"))),
                F.when(F.col("rate_limit_detected"), fill(ADVICE_RATE_LIMIT, department=F.col("dept_key"))),
                F.when(
                    F.col("seed_urls_accessible") < F.col("seed_urls_total"),
                    fill(ADVICE_INACCESSIBLE, department=F.col("dept_key")),
                ),
            )
        ).alias("recommendation")
    )
    general = totals.select(
        F.explode(
            F.array(
                F.when(F.col("total_estimated_pdfs") > many_pdfs, F.lit(ADVICE_MANY)),
                F.when(F.col("estimated_duration") > long_run_seconds, F.lit(ADVICE_LONG)),
            )
        ).alias("recommendation")
    )
    return per_department.unionByName(general).where(F.col("recommendation").isNotNull()).distinct()


def action_counters(events: DataFrame) -> DataFrame:
    """Counts by (department, action) and by action alone, in one pass.

    department is NULL and is_total 1 in the rows over all departments.
    """
    return events.groupingSets(
        [["department", "action"], ["action"]], "department", "action"
    ).agg(
        F.grouping("department").cast("int").alias("is_total"),
        F.count("*").alias("n"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("total_size"),
    )


def preview(documents: DataFrame, count: int = 10) -> DataFrame:
    """First documents (by url) of each department: department, place, url, and how many more there are.

    The rank filter keeps a task from sorting more than its own first rows.
    """
    order = Window.partitionBy("department").orderBy("url")
    few = documents.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
    totals = documents.groupBy("department").agg(F.count("*").alias("total"))
    return few.join(totals, "department").select(
        "department", F.col("place").cast("long").alias("place"), "url", F.greatest(F.col("total") - count, F.lit(0)).alias("more")
    )
