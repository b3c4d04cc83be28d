"""Dry run: what a crawl of the seeds would meet. Writes no state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.operators.incremental import latest_by_url, latest_versions
from crawlspark.operators.lookup import on_listed
from crawlspark.operators.profile import script_weight
from crawlspark.operators.reports import (
    dry_run_by_department,
    dry_run_issues,
    dry_run_recommendations,
    dry_run_totals,
    seed_findings,
)
from crawlspark.operators.rules import LinkRule


@dataclass
class DryRunOutput:
    analyses: DataFrame
    totals: DataFrame
    issues: DataFrame
    recommendations: DataFrame


def dry_run(seeds: DataFrame, pages: DataFrame, fetch_log: DataFrame, rules: list[LinkRule] | None = None) -> DryRunOutput:
    """Analyse ``seeds`` (dept_key, seed_ord, url) against stored pages and the latest GET of each."""
    listed = cut_lineage(seeds.select("url").distinct(), "dry-run-seeds")
    weighed = script_weight(on_listed(pages, listed, F.col("url")), rules, keep=("page_id", "url"))
    weights = latest_versions(weighed).drop("page_id")
    # Written once: four tables come out of it, and HTML is parsed for none of them again.
    findings = cut_lineage(seed_findings(seeds, latest_by_url(fetch_log, "GET"), weights), "dry-run-findings")
    analyses = dry_run_by_department(findings)
    return DryRunOutput(
        analyses=analyses,
        totals=dry_run_totals(analyses),
        issues=dry_run_issues(findings),
        recommendations=dry_run_recommendations(analyses),
    )
