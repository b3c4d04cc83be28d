"""Reports, listings and stored documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.fixed import ERROR_UNKNOWN
from crawlspark.functions.names import dashed
from crawlspark.functions.numbers import fixed_point
from crawlspark.operators.lookup import join_lookup
from crawlspark.operators.reports import overall_results, report_rows


def overall_document(departments: DataFrame, finished: datetime) -> DataFrame:
    """The report's overall part as one JSON text."""
    return overall_results(departments).select(
        F.to_json(
            F.struct(
                F.lit(finished.isoformat()).alias("timestamp"),
                "total_duration",
                F.struct(
                    "total_pdfs_found",
                    "total_pdfs_downloaded",
                    "total_pdfs_failed",
                    "total_pdfs_skipped",
                    "success_rate",
                    "total_size_bytes",
                ).alias("overall_stats"),
            )
        ).alias("json")
    )


#: Columns that put the lines of a JSON report in order.
LINE_ORDER = ["part", "department", "step", "url", "error", "copy"]


def json_lines(departments: DataFrame, errors: DataFrame, finished: datetime) -> DataFrame:
    """The whole report as lines of text that together, in order, are one JSON document.

    Columns: ``LINE_ORDER`` and ``line``. A head, then per department a line that
    opens it, one line per error, and one that closes it; then a foot. However
    many departments and errors there are, they stay rows.
    """
    none = F.lit(None).cast("string")
    no_error = [none.alias("url"), none.alias("error"), F.lit(0).alias("copy")]

    def cut(json: str) -> Column:
        return F.regexp_replace(json, r"\}$", "")

    head = overall_document(departments, finished).select(
        F.lit(0).alias("part"), none.alias("department"), F.lit(0).alias("step"), *no_error,
        F.concat(cut("json"), F.lit(',"departments":[')).alias("line"),
    )
    foot = head.select("part", "department", "step", "url", "error", "copy").select(
        F.lit(2).alias("part"), "department", "step", "url", "error", "copy", F.lit("]}").alias("line")
    )
    # One row: the name that no comma stands before.
    first = departments.agg(F.min("department").alias("first_department"))
    numbers = F.to_json(
        F.struct(
            F.col("department").alias("name"),
            "urls_crawled",
            "pdfs_found",
            "pdfs_downloaded",
            "pdfs_failed",
            "pdfs_skipped",
            F.col("total_size").alias("total_size_bytes"),
            F.col("duration").alias("duration_seconds"),
            "error_count",
        )
    )
    comma = F.when(F.col("department") == F.col("first_department"), "").otherwise(",")
    opened = departments.withColumn("json", numbers).join(F.broadcast(first), F.lit(True)).select(
        F.lit(1).alias("part"), "department", F.lit(0).alias("step"), *no_error,
        F.concat(comma, cut("json"), F.lit(',"errors":[')).alias("line"),
    )
    closed = departments.select(
        F.lit(1).alias("part"), "department", F.lit(2).alias("step"), *no_error, F.lit("]}").alias("line")
    )
    counted = errors.groupBy("department", "url", "error").agg(F.count("*").alias("copies"))
    least = errors.groupBy("department").agg(F.min(F.struct("url", "error")).alias("least"))
    placed = join_lookup(counted, least, "department", "inner").select(
        "*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    )
    leads = (F.col("copy") == 1) & F.struct("url", "error").eqNullSafe(F.col("least"))
    # A text in JSON is a list of it without the brackets.
    quoted = F.regexp_replace(F.to_json(F.array("error")), r"^\[|\]$", "")
    listed = placed.join(departments.select("department"), "department", "left_semi").select(
        F.lit(1).alias("part"), "department", F.lit(1).alias("step"), "url", "error", "copy",
        F.concat(F.when(leads, "").otherwise(","), quoted).alias("line"),
    )
    return head.unionByName(opened).unionByName(listed).unionByName(closed).unionByName(foot)


def save_report(
    departments: DataFrame, errors: DataFrame, path: str, finished: datetime, fmt: str = "json"
) -> None:
    """Write the report as ``json`` or ``csv``.

    JSON is one document; its lines are spread over files whose names, in
    order, put it together. Every error is listed besides.
    """
    kind = fmt.lower()
    if kind == "json":
        lines = json_lines(departments, errors, finished)
        lines.repartitionByRange(*LINE_ORDER).sortWithinPartitions(*LINE_ORDER).select("line").write.text(f"{path}/report")
        errors.write.json(f"{path}/errors")
    elif kind == "csv":
        report_rows(departments).write.option("header", True).csv(f"{path}/report")
    else:
        raise ValueError(f"Unsupported format: {fmt}. Use 'json' or 'csv'")


def listings(results: DataFrame) -> DataFrame:
    """Success and failure listings: department, success, url, detail (file and size, or the reason)."""
    size_mb = F.coalesce("file_size", F.lit(0)).cast("double") / F.lit(1048576.0)
    return results.select(
        "department",
        "success",
        "url",
        F.when(
            F.col("success"),
            F.concat(F.lit("File: "), F.coalesce("file_path", F.lit("None")), F.lit(" Size: "), fixed_point(size_mb, 2), F.lit(" MB")),
        )
        .otherwise(
            F.concat(
                F.lit("Reason: "),
                F.when(F.coalesce("error", F.lit("")) == "", F.lit(ERROR_UNKNOWN)).otherwise(F.col("error")),
            )
        )
        .alias("detail"),
    )


def save_listings(results: DataFrame, path: str) -> None:
    """One folder per department and outcome; an outcome without rows writes none.

    Rows are range partitioned by (department, success, url): files come out in
    url order, and a large department spreads over several of them.
    """
    rows = listings(results).withColumn("dept_dir", dashed(F.col("department")))
    rows.repartitionByRange("dept_dir", "success", "url").sortWithinPartitions("dept_dir", "success", "url").write.partitionBy(
        "dept_dir", "success"
    ).parquet(path)


def save_documents(bodies: DataFrame, layout: DataFrame, path: str) -> None:
    """Store bodies by department directory (any Spark path, also an object store).

    ``layout``: url, department, file_name, s3_key. Only the layout's few
    columns meet the bodies. Rebalancing gathers a department's rows for its
    directory and splits a large one over several files.
    """
    placed = bodies.join(layout.select("url", "department", "file_name", "s3_key"), "url")
    placed.withColumn("dept_dir", dashed(F.col("department"))).hint("rebalance", "dept_dir").write.partitionBy(
        "dept_dir"
    ).parquet(path)


