import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators.incremental import url_hash
from crawlspark.plans.crawl import CrawlInputs, crawl, save_run
from crawlspark.plans.dry_run import dry_run
from crawlspark.plans.refresh import refresh

NOW = datetime(2025, 3, 1, tzinfo=timezone.utc)
PDF = bytearray(b"%PDF-1.4" + b"x" * 100 + b"%%EOF")

SITE = {
    "http://a.b/": '<a href="one.pdf">1</a><a href="/sub/">s</a><a href="http://off.site/x.pdf">off</a><a href="/archive">Archive</a>',
    "http://a.b/sub/": '<a href="two.pdf">2</a><a href="deep/">d</a><a href="../one.pdf">1</a>',
    "http://a.b/sub/deep/": '<a href="three.pdf">3</a><a href="far">f</a>',
    "http://a.b/sub/deep/far": '<a href="four.pdf">4</a>',
    "http://a.b/archive": '<a href="/old.pdf">o</a>',
    "http://a.b/listed": '<a href="/listed.pdf">l</a>',
    "http://a.b/private": '<a href="/secret.pdf">s</a>',
    "http://c.d/": '<a href="http://a.b/one.pdf">1</a><a href="mine.pdf">m</a>',
}


@pytest.fixture
def inputs(spark):
    documents = [f"http://a.b/{p}" for p in ["one.pdf", "sub/two.pdf", "sub/deep/three.pdf", "sub/deep/four.pdf", "old.pdf", "listed.pdf"]]
    documents += ["http://off.site/x.pdf", "http://c.d/mine.pdf"]
    names = [f.name for f in schemas.FETCH_LOG]

    def fetch(url, method, **more):
        row = {"url": url, "method": method, "ts": NOW, "attempt": 1, "status": 200, "content_type": "application/pdf", "content_length": 200, **more}
        return tuple(row.get(n) for n in names)

    log = [fetch(u, m) for u in documents for m in ("HEAD", "GET") if (u, m) not in {("http://off.site/x.pdf", "HEAD"), ("http://a.b/old.pdf", "GET")}]
    log += [fetch("http://off.site/x.pdf", "HEAD", status=404), fetch("http://a.b/old.pdf", "GET", status=None, error="timeout")]
    bodies = [(u, PDF) for u in documents if "two" not in u] + [("http://a.b/sub/two.pdf", bytearray(b"<html>"))]
    make = spark.createDataFrame
    return CrawlInputs(
        departments=make([("a", "Dept A", 3, 100), ("c", "Dept C", 3, 100), ("e", "Dept E", 3, 100)], schemas.DEPARTMENTS),
        seeds=make([("a", 0, "http://a.b/"), ("c", 0, "http://c.d/"), ("e", 0, "http://e.f/")], schemas.SEEDS),
        pages=make([(i, u, h) for i, (u, h) in enumerate(SITE.items())], schemas.PAGES),
        fetch_log=make(log, schemas.FETCH_LOG),
        bodies=make(bodies, schemas.BODIES),
        robots_rules=make([("a.b", 1, "*", False, "/private")], schemas.ROBOTS_RULES),
        sitemaps=make([("a.b", "https://a.b/sitemap.xml", "<urlset><url><loc>http://a.b/listed</loc></url></urlset>")], schemas.SITEMAPS),
        doc_cache=make([], schemas.DOC_CACHE),
        page_cache=make([], schemas.PAGE_CACHE),
        registry=make([], schemas.FILE_REGISTRY),
        stored=make([], "local_path string, file_size long"),
    )


def outcome(run):
    return {(r.department, r.url): (r.success, r.error) for r in run.results.collect()}


GOOD = (True, None)


def test_first_run(inputs):
    run = crawl(inputs, NOW)
    assert outcome(run) == {
        ("Dept A", "http://a.b/one.pdf"): GOOD,
        ("Dept A", "http://a.b/sub/two.pdf"): (False, "Downloaded content is not a valid PDF file"),
        ("Dept A", "http://a.b/sub/deep/three.pdf"): GOOD,
        ("Dept A", "http://a.b/sub/deep/four.pdf"): GOOD,
        ("Dept A", "http://a.b/old.pdf"): (False, "Network error: timeout"),
        ("Dept A", "http://a.b/listed.pdf"): GOOD,
        ("Dept C", "http://a.b/one.pdf"): GOOD,
        ("Dept C", "http://c.d/mine.pdf"): GOOD,
    }
    found = {r.department: r for r in run.departments.collect()}
    a = found["Dept A"]
    assert (a.pdfs_found, a.pdfs_downloaded, a.pdfs_failed, a.total_size, a.error_count) == (6, 4, 2, 4 * len(PDF), 2)
    # 6 pages on the way (three folders, far, archive, listed) and 4 documents, none of them a page.
    assert a.urls_crawled == 10
    assert (found["Dept C"].pdfs_found, found["Dept C"].urls_crawled) == (2, 2)
    assert (found["Dept E"].pdfs_found, found["Dept E"].urls_crawled) == (0, 1)
    total = run.overall.first()
    assert (total.departments, total.total_pdfs_found, total.total_pdfs_downloaded, total.success_rate) == (3, 8, 6, 75.0)
    good = {u for (_, u), found in outcome(run).items() if found == GOOD}
    assert {r.url for r in run.doc_cache.collect()} == good
    assert {r.url: r.file_size for r in run.registry.collect()} == {u: len(PDF) for u in good}
    counts = {r.url: (r.pdf_count, r.crawl_count) for r in run.page_cache.collect()}
    assert counts["http://a.b/sub/"] == (2, 1) and counts["http://c.d/"] == (2, 1)


def test_second_run_sees_only_what_is_new(inputs):
    first = crawl(inputs, NOW)
    inputs.doc_cache, inputs.page_cache = first.doc_cache, first.page_cache
    soon = crawl(inputs, NOW + timedelta(hours=1))
    assert outcome(soon) == {}
    later = crawl(inputs, NOW + timedelta(hours=30))
    # What failed is tried again; what is known is only seen again.
    assert {u for _, u in outcome(later)} == {"http://a.b/sub/two.pdf", "http://a.b/old.pdf"}
    times = {r.url: (r.discovered_time, r.last_seen) for r in later.doc_cache.collect()}
    assert len(set(times.values())) == 1
    (discovered, seen), = set(times.values())
    assert seen - discovered == timedelta(hours=30)
    counts = {r.url: r.crawl_count for r in later.page_cache.collect()}
    assert counts["http://a.b/"] == 2
    full = crawl(inputs, NOW + timedelta(hours=1), incremental=False)
    assert len(outcome(full)) == 8


def test_walk_only_and_limits(inputs):
    limited = inputs.departments
    inputs.departments = limited.withColumn("max_depth", F.lit(1))
    run = crawl(inputs, NOW, comprehensive=False)
    assert {u for d, u in outcome(run) if d == "Dept A"} == {
        "http://a.b/one.pdf", "http://a.b/sub/two.pdf", "http://a.b/old.pdf",
    }
    inputs.departments = limited.withColumn("max_depth", F.lit(None).cast("int")).withColumn("max_pages", F.lit(1))
    capped = crawl(inputs, NOW, comprehensive=False)
    assert {u for d, u in outcome(capped) if d == "Dept A"} == {"http://a.b/one.pdf"}


def test_blocked_pages_lead_nowhere(inputs, spark):
    inputs.seeds = spark.createDataFrame([("a", 0, "http://a.b/private")], schemas.SEEDS)
    blocked = crawl(inputs, NOW, comprehensive=False)
    assert {r.url for r in blocked.discovered.collect()} == {"http://a.b/private"}
    free = crawl(inputs, NOW, comprehensive=False, respect_robots=False)
    assert {r.url for r in free.discovered.collect()} == {"http://a.b/private", "http://a.b/secret.pdf"}


def test_dry_run(inputs, spark):
    log = inputs.fetch_log.unionByName(
        inputs.fetch_log.limit(1).select(
            F.lit("http://a.b/").alias("url"), F.lit("GET").alias("method"), *[c for c in inputs.fetch_log.columns if c not in ("url", "method")]
        )
    )
    out = dry_run(inputs.seeds, inputs.pages, log)
    found = {r.dept_key: (r.seed_urls_accessible, r.seed_urls_total, r.estimated_pdfs) for r in out.analyses.collect()}
    assert found == {"a": (1, 1, 2), "c": (0, 1, 0), "e": (0, 1, 0)}
    assert {r.issue for r in out.issues.collect()} == {"Connection error for http://c.d/", "Connection error for http://e.f/"}
    assert out.totals.first().estimated_duration == 4.0
    assert out.recommendations.count() == 2


def test_refresh(inputs, spark):
    documents = spark.createDataFrame([("Dept A", u) for u in ["http://a.b/one.pdf", "http://a.b/old.pdf", "http://a.b/listed.pdf"]], "department string, url string")
    stored = spark.createDataFrame([("downloads/Dept-A/one.pdf", 9)], "local_path string, file_size long")
    registry = spark.createDataFrame(
        [("http://a.b/one.pdf", "downloads/Dept-A/one.pdf", NOW, 9, "h", None, None, 9)],
        "url string, local_path string, download_time timestamp, file_size long, file_hash string, last_modified string, etag string, content_length long",
    ).withColumn("url_hash", url_hash(F.col("url")))
    results, state = refresh(documents, inputs.fetch_log, inputs.bodies, registry, stored, NOW)
    assert {r.url: (r.success, r.skipped, r.file_size) for r in results.collect()} == {
        "http://a.b/one.pdf": (True, True, 9),
        "http://a.b/old.pdf": (False, False, 0),
        "http://a.b/listed.pdf": (True, False, len(PDF)),
    }
    assert {r.url: r.file_size for r in state.collect()} == {"http://a.b/one.pdf": 9, "http://a.b/listed.pdf": len(PDF)}
    forced, _ = refresh(documents, inputs.fetch_log, inputs.bodies, registry, stored, NOW, force=True)
    assert {r.url: r.skipped for r in forced.collect()}["http://a.b/one.pdf"] is False


def test_a_document_that_failed_may_enter_the_cache_too(inputs):
    run = crawl(inputs, NOW, cache_when="found")
    assert {r.url for r in run.doc_cache.collect()} >= {u for _, u in outcome(run)}
    with pytest.raises(ValueError, match="cache_when"):
        crawl(inputs, NOW, cache_when="never")


def test_stored_files_are_skipped_without_a_registry(inputs, spark):
    stored = [("downloads/Dept-A/one.pdf", 9), ("downloads/Dept-A/listed.pdf", 0)]
    inputs.stored = spark.createDataFrame(stored, "local_path string, file_size long")
    run = crawl(inputs, NOW, incremental=False, base="downloads")
    skipped = {(r.department, r.url): r.file_size for r in run.results.where("skipped").collect()}
    assert skipped == {("Dept A", "http://a.b/one.pdf"): 9}


def test_decisions_are_per_department(inputs, spark):
    inputs.stored = spark.createDataFrame([("downloads/Dept-A/one.pdf", 9)], "local_path string, file_size long")
    inputs.registry = spark.createDataFrame(
        [("http://a.b/one.pdf", "downloads/Dept-A/one.pdf", NOW, 9, "h", None, None, 200)],
        "url string, local_path string, download_time timestamp, file_size long, file_hash string, last_modified string, etag string, content_length long",
    ).withColumn("url_hash", url_hash(F.col("url")))
    run = crawl(inputs, NOW, base="downloads")
    found = {r.department: (r.skipped, r.file_size) for r in run.results.where("url = 'http://a.b/one.pdf'").collect()}
    assert found == {"Dept A": (True, 9), "Dept C": (False, len(PDF))}


def test_only_the_latest_version_of_a_page_counts(inputs, spark):
    newer = spark.createDataFrame([(100, "http://c.d/", '<a href="new.pdf">n</a>')], schemas.PAGES)
    inputs.pages = inputs.pages.unionByName(newer)
    run = crawl(inputs, NOW)
    assert {r.url for r in run.documents.where("department = 'Dept C'").collect()} == {"http://c.d/new.pdf"}
    found = dry_run(inputs.seeds, inputs.pages, inputs.fetch_log)
    assert {r.dept_key: (r.seed_urls_total, r.estimated_pdfs) for r in found.analyses.collect()}['c'] == (1, 0)
    assert found.analyses.agg(F.sum('seed_urls_total')).first()[0] == 3


def test_durations_count_overlaps_once(inputs):
    log = inputs.fetch_log.withColumn("duration_us", F.when(F.col("method") == "GET", F.lit(3_000_000)))
    inputs.fetch_log = log.withColumn("ts", F.when(F.col("url").contains("two"), F.col("ts") + F.expr("INTERVAL 2 SECONDS")).otherwise(F.col("ts")))
    run = crawl(inputs, NOW)
    found = {r.department: r.duration for r in run.departments.collect()}
    # All fetches start at once, but one that starts two seconds later.
    assert found == {"Dept A": 5.0, "Dept C": 3.0, "Dept E": 0.0}
    assert run.overall.first().total_duration == 8.0


def test_search_forms_and_hidden_links(spark, inputs):
    form = '<form action="/find"><input type="hidden" name="l" value="a b"><input type="search" name="q"></form>'
    shown = '<div data-href="/concealed.pdf">x</div>'
    make = spark.createDataFrame
    more = make([(50, "http://e.f/", form + shown), (51, "http://a.b/sub/deep/far", shown + '<a href="four.pdf">4</a>')], schemas.PAGES)
    inputs.pages = inputs.pages.unionByName(more)
    inputs.search_pages = make(
        [("http://e.f/find?l=a+b&q=PDF", '<a href="/result.pdf">r</a>'), ("http://e.f/find?q=PDF", '<a href="/not-asked.pdf">r</a>')],
        "url string, html string",
    )
    found = {r.url for r in crawl(inputs, NOW).documents.where("dept_key = 'e'").collect()}
    assert found == {"http://e.f/result.pdf", "http://e.f/concealed.pdf"}
    assert "http://a.b/concealed.pdf" not in {r.url for r in crawl(inputs, NOW).documents.collect()}, "only where no plain link is a document"
    assert crawl(inputs, NOW, comprehensive=False).documents.where("dept_key = 'e'").count() == 0


def test_reports_of_a_run(spark, inputs, folder):
    run = crawl(inputs, NOW)
    save_run(run, f"{folder}/run", NOW)
    rows = spark.read.option("header", True).csv(f"{folder}/run/csv/report").collect()
    assert len(rows) == 3
    lines = [r.value for name in sorted(Path(f"{folder}/run/json/report").glob("part-*")) for r in spark.read.text(str(name)).collect()]
    assert len(json.loads("".join(lines))["departments"]) == 3
    listed = spark.read.parquet(f"{folder}/run/listings")
    assert {(r.department, r.url): str(r.success).lower() == "true" for r in listed.collect()} == {k: v[0] for k, v in outcome(run).items()}
