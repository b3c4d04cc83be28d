import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlspark.operators import reports
from crawlspark.sources import sinks

FINISHED = datetime(2025, 9, 30, 23, 20, 46)
MIB = 1048576


@pytest.fixture
def sample(spark):
    """Three departments as a crawl leaves them."""
    rows = [
        ("Parks Office", 41, 16, 9, 4, 3, 7 * MIB, 4, 93.0),
        ("Tide Bureau", 7, 3, 3, 0, 0, 3 * MIB // 2, 0, 36.6),
        ("Road Survey", 52, 20, 14, 6, 2, 30 * MIB, 6, 402.0),
    ]
    return spark.createDataFrame(
        rows,
        "department string, urls_crawled long, pdfs_found long, pdfs_downloaded long, pdfs_failed long, "
        "pdfs_skipped long, total_size long, error_count long, duration double",
    )


ERRORS = [
    ("Road Survey", "r/9", "bridge out"),
    ("Parks Office", "p/2", 'the gate said "no"\n'),
    ("Parks Office", "p/1", "gate closed"),
    ("Parks Office", "p/2", 'the gate said "no"\n'),
    ("Parks Office", None, None),
    ("Nowhere", "n/1", "unknown department"),
]


@pytest.fixture
def errors(spark):
    return spark.createDataFrame(ERRORS, "department string, url string, error string")


def written(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def test_csv_rows(sample, spark, folder):
    sinks.save_report(sample.coalesce(1), None, f"{folder}/csv", FINISHED, "CSV")
    assert written(f"{folder}/csv/report").splitlines()[1:] == [
        "Parks Office,41,16,9,4,3,7.0,1.55,56.2,4",
        "Tide Bureau,7,3,3,0,0,1.5,0.61,100.0,0",
        "Road Survey,52,20,14,6,2,30.0,6.7,70.0,6",
    ]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_json_report_is_one_document_with_all_errors(sample, errors, spark, folder, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        sinks.save_report(sample, errors, f"{folder}/json", FINISHED)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    report = json.loads(written(f"{folder}/json/report"))
    assert report["timestamp"] == "2025-09-30T23:20:46" and report["total_duration"] == pytest.approx(531.6)
    assert report["overall_stats"] == {
        "total_pdfs_found": 39, "total_pdfs_downloaded": 26, "total_pdfs_failed": 10, "total_pdfs_skipped": 5,
        "success_rate": pytest.approx(200 / 3), "total_size_bytes": 77 * MIB // 2,
    }
    assert [d["name"] for d in report["departments"]] == ["Parks Office", "Road Survey", "Tide Bureau"]
    parks, road, tide = report["departments"]
    assert parks == {
        "name": "Parks Office", "urls_crawled": 41, "pdfs_found": 16, "pdfs_downloaded": 9, "pdfs_failed": 4, "pdfs_skipped": 3,
        "total_size_bytes": 7 * MIB, "duration_seconds": 93.0, "error_count": 4,
        "errors": [None, "gate closed", 'the gate said "no"\n', 'the gate said "no"\n'],
    }
    assert road["errors"] == ["bridge out"] and tide["errors"] == []
    assert len(written(f"{folder}/json/errors").splitlines()) == len(ERRORS)


def test_json_report_of_many_errors_and_of_nothing(sample, spark, folder):
    many = spark.range(3000).select(
        F.lit("Road Survey").alias("department"), F.format_string("r/%05d", "id").alias("url"), F.concat(F.lit("e"), "id").alias("error")
    )
    sinks.save_report(sample, many, f"{folder}/many", FINISHED)
    report = json.loads(written(f"{folder}/many/report"))
    assert report["departments"][1]["errors"] == [f"e{i}" for i in range(3000)]
    sinks.save_report(sample.limit(0), many, f"{folder}/none", FINISHED)
    assert json.loads(written(f"{folder}/none/report"))["departments"] == []


def test_text_report(sample, spark):
    errors = spark.createDataFrame([("Road Survey", f"r/{i}", f"stone {i}") for i in range(6)], "department string, url string, error string")
    departments = sample.withColumn("error_count", F.when(F.col("department") == "Road Survey", 6).otherwise(0))
    lines = [r.line for r in reports.report_lines(departments, errors, FINISHED, "Week 7").orderBy("block", "department", "line_no").collect()]
    assert lines[:17] == [
        "=" * 60, "Week 7", "=" * 60, "Crawl completed at: 2025-09-30 23:20:46", "Total duration: 8.86 minutes", "", "OVERALL STATISTICS", "-" * 30,
        "Total PDFs found: 39", "Total PDFs downloaded: 26", "Total PDFs failed: 10", "Total PDFs skipped: 5", "Success rate: 66.7%",
        "Total size downloaded: 38.50 MB", "", "DEPARTMENT BREAKDOWN", "-" * 30,
    ]
    road = lines[lines.index("Road Survey:"):]
    assert road[:14] == [
        "Road Survey:", "  URLs crawled: 52", "  PDFs found: 20", "  PDFs downloaded: 14", "  PDFs failed: 6", "  PDFs skipped: 2",
        "  Total size: 30.00 MB", "  Duration: 6.70 minutes", "  Success rate: 70.0%", "  Errors encountered: 6",
        "    - stone 0", "    - stone 1", "    - stone 2", "    ... and 3 more",
    ]
    assert lines[-2:] == ["", "=" * 60]


def test_department_results(spark):
    rows = spark.createDataFrame(
        [("A", "1", True, None, 5, False), ("A", "2", False, "x", 0, False), ("A", "3", True, None, 7, True), ("A", "4", False, None, 9, False), ("B", "5", True, None, 1, False)],
        "department string, url string, success boolean, error string, file_size long, skipped boolean",
    )
    crawled = spark.createDataFrame([("A", 10), ("C", 3)], "department string, urls_crawled long")
    durations = spark.createDataFrame([("A", 2.5)], "department string, duration double")
    found = {r.department: tuple(r)[1:] for r in reports.department_results(rows, crawled, durations).collect()}
    assert found == {"A": (10, 4, 2, 2, 1, 12, 1, 2.5), "B": (0, 1, 1, 0, 0, 1, 0, 0.0), "C": (3, 0, 0, 0, 0, 0, 0, 0.0)}
    total = reports.overall_results(reports.department_results(rows, crawled, durations)).first()
    assert (total.total_pdfs_found, total.total_pdfs_downloaded, total.total_size_bytes, total.success_rate) == (5, 3, 13, 60.0)
    grand = reports.results_with_total(rows).where("is_total = 1").first()
    assert (grand.pdfs_found, grand.pdfs_downloaded, grand.total_size) == (5, 3, 13)
    assert [r.error for r in reports.department_errors(rows).collect()] == ["Download failed for 2: x"]


def test_nothing_found(spark):
    empty = spark.createDataFrame([], "department string, url string, success boolean, error string, file_size long")
    total = reports.overall_results(reports.department_results(empty)).first()
    assert (total.departments, total.success_rate, total.total_duration) == (0, 0.0, 0.0)
    assert reports.average_speed(reports.department_results(empty)).first().pdfs_per_minute is None


def test_preview(spark):
    docs = spark.createDataFrame([("A", f"u{i:02d}") for i in range(13)] + [("B", "x")], "department string, url string")
    shown = reports.preview(docs)
    rows = shown.collect()
    assert len([r for r in rows if r.department == "A"]) == 10 and {r.more for r in rows if r.department == "A"} == {3}
    assert [(r.url, r.more) for r in rows if r.department == "B"] == [("x", 0)]
    assert "WindowGroupLimit" in shown._jdf.queryExecution().executedPlan().toString()


def test_action_counters(spark):
    events = spark.createDataFrame([("A", "found", None), ("A", "ok", 5), ("B", "ok", 2), ("A", "ok", 1)], "department string, action string, file_size long")
    found = {(r.department, r.action, r.is_total): (r.n, r.total_size) for r in reports.action_counters(events).collect()}
    assert found == {
        ("A", "found", 0): (1, 0), ("A", "ok", 0): (2, 6), ("B", "ok", 0): (1, 2), (None, "found", 1): (1, 0), (None, "ok", 1): (3, 8),
    }


def test_listings(spark, folder):
    rows = spark.createDataFrame(
        [("A (x)", "2", False, None, None, 0), ("A (x)", "1", False, None, "gone", 0), ("A (x)", "3", True, "p", None, MIB), ("B", "4", True, "q", None, 0)],
        "department string, url string, success boolean, file_path string, error string, file_size long",
    )
    found = {r.url: r.detail for r in sinks.listings(rows).collect()}
    assert found == {"1": "Reason: gone", "2": "Reason: Unknown error", "3": "File: p Size: 1.00 MB", "4": "File: q Size: 0.00 MB"}
    sinks.save_listings(rows, f"{folder}/lists")
    assert sorted(p.name for p in Path(f"{folder}/lists").glob("dept_dir=*/success=*")) == ["success=false", "success=true", "success=true"]
    assert not Path(f"{folder}/lists/dept_dir=B/success=false").exists()


def test_documents_are_stored_by_department(spark, folder):
    bodies = spark.createDataFrame([("u", bytearray(b"1")), ("v", bytearray(b"2"))], "url string, body binary")
    layout = spark.createDataFrame([("u", "A b", "u.pdf", "A-b/u.pdf"), ("v", "C", "v.pdf", "C/v.pdf")], "url string, department string, file_name string, s3_key string")
    sinks.save_documents(bodies, layout, f"{folder}/docs")
    back = spark.read.parquet(f"{folder}/docs")
    assert {(r.dept_dir, r.file_name, bytes(r.body)) for r in back.collect()} == {("A-b", "u.pdf", b"1"), ("C", "v.pdf", b"2")}


def findings(spark):
    seeds = spark.createDataFrame([("a", i, f"u{i}") for i in range(6)] + [("b", 0, "v"), ("b", 1, "w")], "dept_key string, seed_ord int, url string")
    gets = spark.createDataFrame(
        [("u0", 200, None), ("u1", 429, None), ("u2", 403, None), ("u3", None, "Read Timeout"), ("u4", None, "Connection refused"), ("v", 200, None), ("w", None, "odd")],
        "url string, status int, error string",
    )
    weights = spark.createDataFrame([("u0", 11, 0), ("v", 50, 1200), ("u1", 99, 0)], "url string, script_signs long, document_count long")
    return reports.seed_findings(seeds, gets, weights)


def test_dry_run(spark):
    found = findings(spark)
    analyses = reports.dry_run_by_department(found)
    assert {tuple(r) for r in analyses.collect()} == {("a", 1, 6, 0, True, True, 5), ("b", 1, 2, 1200, False, False, 1)}
    assert {r.issue for r in reports.dry_run_issues(found).collect()} == {
        "Rate limiting detected on u1", "HTTP 403 error for u2", "Timeout accessing u3", "Connection error for u4", "Connection error for u5",
        "Error accessing w: odd",
    }
    totals = reports.dry_run_totals(analyses).first()
    assert (totals.total_estimated_pdfs, totals.estimated_duration, totals.issues) == (1200, 2400.0, 6)
    assert {r.recommendation for r in reports.dry_run_recommendations(analyses).collect()} == {
        "Enable browser automation for a", "Increase delays for a to avoid rate limiting", "Check inaccessible URLs for a",
        "Check inaccessible URLs for b", "Consider running crawl in smaller batches due to large number of PDFs",
    }
