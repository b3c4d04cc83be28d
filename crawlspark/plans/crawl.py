"""Crawl run over stored pages: discover, find documents, validate, report, new state."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.fixed import DEFAULT_MAX_DEPTH, DEFAULT_MAX_PAGES
from crawlspark.functions.url import authority
from crawlspark.lineage import cut_lineage
from crawlspark.operators.departments import documents_found
from crawlspark.operators.incremental import (
    change_decision,
    latest_by_url,
    latest_versions,
    new_documents_only,
    stale_pages_only,
    stored_decision,
    upsert_documents,
    upsert_pages,
    upsert_registry_files,
)
from crawlspark.operators.forms import request_address, search_requests
from crawlspark.operators.layout import with_layout
from crawlspark.operators.links import hidden_links, page_facts, search_result_links
from crawlspark.operators.lookup import on_listed
from crawlspark.operators.pacing import busy_time
from crawlspark.operators.reports import department_errors, department_results, overall_results
from crawlspark.operators.rules import LinkRule
from crawlspark.operators.validate import content_checks, download_outcome, url_verdicts
from crawlspark.operators.walk import bounded_walk, page_cap, robots_allowed, union_discoveries
from crawlspark.sources.sinks import save_listings, save_report
from crawlspark.sources.sitemaps import sitemap_urls


@dataclass
class CrawlInputs:
    """Tables of a run; see ``schemas``. ``stored``: local_path, file_size of existing files.

    ``search_pages`` (url, html): answers to search requests under the addresses
    that ``request_address`` gives the planned ones. ``search_documents``
    (dept_key, target_url): documents that a search has found elsewhere.
    """

    departments: DataFrame
    seeds: DataFrame
    pages: DataFrame
    fetch_log: DataFrame
    bodies: DataFrame
    robots_rules: DataFrame
    sitemaps: DataFrame
    doc_cache: DataFrame
    page_cache: DataFrame
    registry: DataFrame
    stored: DataFrame
    search_documents: DataFrame | None = None
    search_pages: DataFrame | None = None


@dataclass
class CrawlOutput:
    discovered: DataFrame
    documents: DataFrame
    results: DataFrame
    departments: DataFrame
    overall: DataFrame
    errors: DataFrame
    doc_cache: DataFrame
    page_cache: DataFrame
    registry: DataFrame


def _search_documents(inputs: CrawlInputs, seeds: DataFrame, rules: list[LinkRule] | None) -> DataFrame:
    """Documents on the answers to the search forms of the seeds' own pages: dept_key, target_url."""
    starts = cut_lineage(seeds.select("url").distinct(), "search-seeds")
    planned = search_requests(on_listed(inputs.pages, starts, F.col("url")))
    asked = planned.select(F.col("page_url").alias("url"), request_address(F.col("form_url"), F.col("params")).alias("page_url")).distinct()
    found = search_result_links(inputs.search_pages, rules)
    return seeds.select("dept_key", "url").join(asked, "url").join(found, "page_url").select("dept_key", "target_url").distinct()


def department_durations(fetch_log: DataFrame, asked: DataFrame) -> DataFrame:
    """Seconds in which something was being fetched for each department: department, duration.

    ``asked`` has department and url. Fetches at the same time count once.
    """
    start = F.unix_micros("ts")
    timed = fetch_log.select("url", start.alias("start_us"), (start + F.col("duration_us")).alias("end_us"))
    busy = busy_time(timed.join(asked.distinct(), "url").select("department", "start_us", "end_us"))
    return busy.select("department", (F.col("busy_us") / F.lit(1e6)).alias("duration"))


def save_run(run: CrawlOutput, path: str, finished: datetime, formats: tuple[str, ...] = ("json", "csv")) -> None:
    """Write the reports and listings of a run below ``path``."""
    for fmt in formats:
        save_report(run.departments, run.errors, f"{path}/{fmt}", finished, fmt)
    save_listings(run.results, f"{path}/listings")


def crawl(
    inputs: CrawlInputs,
    now: datetime,
    rules: list[LinkRule] | None = None,
    comprehensive: bool = True,
    incremental: bool = True,
    max_age_hours: float = 24,
    max_depth: int = DEFAULT_MAX_DEPTH,
    max_pages: int = DEFAULT_MAX_PAGES,
    cache_when: str = "stored",
    respect_robots: bool = True,
    force: bool = False,
    max_mb: float | None = 50,
    base: str = "./downloads",
) -> CrawlOutput:
    """One run. HTML is read once, into a table of facts per page; bodies are
    reduced to checks before they meet another table.

    A department's own limits decide; ``max_depth`` and ``max_pages`` hold where
    it has none. ``cache_when`` says when a new document enters the cache:
    ``stored`` (one that failed is tried again next time) or ``found``. Known
    documents that are found again are refreshed there in either case. Without
    ``incremental`` every page is read, and stored files are skipped by their
    existence alone.
    """
    if cache_when not in ("stored", "found"):
        raise ValueError("cache_when must be 'stored' or 'found'")
    limits = inputs.departments.select("dept_key", "max_depth", F.col("max_pages").alias("dept_pages"))
    seeds = inputs.seeds.join(limits, "dept_key").drop("dept_pages")
    if incremental:
        seeds = stale_pages_only(seeds, inputs.page_cache, now, max_age_hours)

    sites = cut_lineage(seeds.select(authority(F.col("url")).alias("site")).distinct(), "crawl-sites")
    on_sites = on_listed(inputs.pages, sites, authority(F.col("url")))
    facts = cut_lineage(latest_versions(page_facts(on_sites, rules)), "page-facts")

    edges = robots_allowed(facts, inputs.robots_rules, respect_robots=respect_robots).where("allowed")
    walked = bounded_walk(seeds, edges.select("page_id", "url", "targets"), max_depth)
    strategies = [walked]
    if comprehensive:
        marked = seeds.select("dept_key", "seed_ord", "url", authority(F.col("url")).alias("host"))
        # A department takes a host's sitemap once, for the first of its seeds there.
        hosts = marked.groupBy("dept_key", "host").agg(F.min("seed_ord").alias("seed_ord"))
        listed = sitemap_urls(inputs.sitemaps)
        no_trail = F.array().cast("array<int>").alias("trail")
        strategies.append(
            listed.join(hosts, "host").select("dept_key", "seed_ord", "url", F.lit(0).alias("depth"), no_trail)
        )
        archives = facts.select("url", F.posexplode("archives").alias("pos", "target"))
        strategies.append(
            marked.join(archives, "url").select(
                "dept_key",
                "seed_ord",
                F.col("target").alias("url"),
                F.lit(0).alias("depth"),
                F.array("pos").alias("trail"),
            )
        )
    discovered = cut_lineage(union_discoveries(*strategies), "discovered")

    capped = page_cap(discovered.join(limits.select("dept_key", F.col("dept_pages").alias("max_pages")), "dept_key"), max_pages)
    visited = stale_pages_only(capped, inputs.page_cache, now, max_age_hours) if incremental else capped
    on_pages = facts.select(F.col("url").alias("page_url"), F.explode("documents").alias("target_url"))
    if comprehensive:
        # Only a page on which no plain link is a document is looked through once more.
        bare = cut_lineage(facts.where(F.size("documents") == 0).select("page_id"), "bare-pages")
        concealed = hidden_links(on_listed(on_sites, bare, F.col("page_id"))).select("page_url", "target_url").distinct()
        on_pages = on_pages.unionByName(concealed)
    more = [inputs.search_documents] if inputs.search_documents is not None else []
    if comprehensive and inputs.search_pages is not None:
        more.append(_search_documents(inputs, seeds, rules))
    documents = documents_found(visited, on_pages, *more)

    names = inputs.departments.select("dept_key", F.col("name").alias("department"))
    candidates = with_layout(
        documents.join(names, "dept_key").select("dept_key", "department", F.col("target_url").alias("url")), base
    )
    everything = cut_lineage(candidates, "found-documents")
    candidates = cut_lineage(new_documents_only(everything, inputs.doc_cache), "candidates") if incremental else everything

    heads = cut_lineage(latest_by_url(inputs.fetch_log, "HEAD"), "heads")
    gets = latest_by_url(inputs.fetch_log, "GET")
    checked = cut_lineage(url_verdicts(candidates, heads), "verdicts")
    valid = checked.where("valid")
    asked = valid.select("url", "local_path")
    if incremental or force:
        decisions = change_decision(asked, inputs.stored, inputs.registry, heads, force)
    else:
        decisions = stored_decision(asked, inputs.stored)
    wanted = cut_lineage(valid.select("url").distinct(), "valid-urls")
    checks = cut_lineage(content_checks(on_listed(inputs.bodies, wanted, F.col("url"))), "content-checks")
    results = cut_lineage(
        download_outcome(
            valid.select("department", "url", "local_path"),
            decisions,
            checked,
            gets,
            checks,
            inputs.stored,
            max_mb=max_mb,
        ),
        "results",
    )

    crawled = (
        discovered.groupBy("dept_key")
        .agg(F.count("*").alias("urls_crawled"))
        .join(names, "dept_key", "right")
        .select("department", F.coalesce("urls_crawled", F.lit(0)).alias("urls_crawled"))
    )
    fetched = discovered.join(names, "dept_key").select("department", "url").unionByName(candidates.select("department", "url"))
    departments = department_results(results, crawled, department_durations(inputs.fetch_log, fetched))
    stored = results.where("success").select("url", "department")
    known = everything.join(inputs.doc_cache.select("url"), "url", "left_semi").select("url", "department")
    entered = stored if cache_when == "stored" else everything.select("url", "department")
    seen = known.unionByName(entered).withColumnRenamed("department", "source_page")
    saved = results.where(F.col("success") & ~F.col("skipped")).select("url", F.col("file_path").alias("local_path"))
    files = saved.join(checks.select("url", F.col("bytes").alias("file_size"), "file_hash"), "url")
    looked_at = visited.select("url").distinct().join(
        facts.select("url", F.size("documents").alias("pdf_count")), "url"
    )
    return CrawlOutput(
        discovered=discovered,
        documents=candidates,
        results=results,
        departments=departments,
        overall=overall_results(departments),
        errors=department_errors(results),
        doc_cache=upsert_documents(inputs.doc_cache, seen, now),
        page_cache=upsert_pages(inputs.page_cache, looked_at, now),
        registry=upsert_registry_files(inputs.registry, files, heads, now),
    )
