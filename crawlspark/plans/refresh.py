"""Incremental refresh of known documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.operators.incremental import change_decision, latest_by_url, upsert_registry_files
from crawlspark.operators.layout import with_layout
from crawlspark.operators.lookup import on_listed
from crawlspark.operators.validate import content_checks, download_outcome, url_verdicts


def refresh(
    documents: DataFrame,
    fetch_log: DataFrame,
    bodies: DataFrame,
    registry: DataFrame,
    stored: DataFrame,
    now: datetime,
    force: bool = False,
    base: str = "./downloads",
) -> tuple[DataFrame, DataFrame]:
    """Results and the new registry for ``documents`` (department, url)."""
    candidates = with_layout(documents.select("department", "url").distinct(), base)
    heads = cut_lineage(latest_by_url(fetch_log, "HEAD"), "refresh-heads")
    asked = candidates.select("url", "local_path")
    decisions = cut_lineage(change_decision(asked, stored, registry, heads, force), "refresh-decisions")
    verdicts = cut_lineage(url_verdicts(candidates, heads), "refresh-verdicts")
    # Only bodies that are to be downloaded are looked at.
    valid = verdicts.where("valid").select("url")
    listed = decisions.where("download").join(valid, "url", "left_semi").select("url").distinct()
    checks = cut_lineage(content_checks(on_listed(bodies, cut_lineage(listed, "refresh-urls"), F.col("url"))), "refresh-checks")
    results = cut_lineage(
        download_outcome(
            candidates.select("department", "url", "local_path"),
            decisions,
            verdicts,
            latest_by_url(fetch_log, "GET"),
            checks,
            stored,
        ),
        "refresh-results",
    )
    saved = results.where(F.col("success") & ~F.col("skipped")).select("url", F.col("file_path").alias("local_path"))
    files = saved.join(checks.select("url", F.col("bytes").alias("file_size"), "file_hash"), "url")
    return results, upsert_registry_files(registry, files, heads, now)
