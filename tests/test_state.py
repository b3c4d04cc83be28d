from datetime import datetime, timedelta, timezone
import hashlib

import pytest
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators import incremental, layout, validate
from crawlspark.sources.state import load_state, save_state, versions

NOW = datetime(2025, 3, 1, 12, tzinfo=timezone.utc)
HOUR = timedelta(hours=1)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def page_cache(spark, *ages):
    rows = [(md5(u), u, NOW - age, 1, 1) for u, age in ages]
    return spark.createDataFrame(rows, schemas.PAGE_CACHE)


def doc_cache(spark, *ages):
    rows = [(md5(u), u, NOW - age, "s", NOW - age) for u, age in ages]
    return spark.createDataFrame(rows, schemas.DOC_CACHE)


def micros(df, *names):
    return df.select(*[F.unix_micros(c).alias(c) if c in names else F.col(c) for c in df.columns])


def us(moment):
    return int(moment.timestamp()) * 1_000_000


def urls(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def test_fresh_pages_are_skipped_strictly_below_the_limit(spark):
    cache = page_cache(spark, ("under", 24 * HOUR - timedelta(seconds=1)), ("at", 24 * HOUR), ("over", 25 * HOUR))
    left = incremental.stale_pages_only(urls(spark, "under", "at", "over", "unknown"), cache, NOW)
    assert sorted(r.url for r in left.collect()) == ["at", "over", "unknown"]


def test_new_documents(spark):
    found = incremental.new_documents_only(urls(spark, "a", "b"), doc_cache(spark, ("a", HOUR)))
    assert [r.url for r in found.collect()] == ["b"]


def test_document_upsert(spark):
    seen = spark.createDataFrame([("a", "x"), ("c", "y"), ("c", "y")], "url string, source_page string")
    state = incremental.upsert_documents(doc_cache(spark, ("a", 50 * HOUR), ("b", 60 * HOUR)), seen, NOW)
    found = {r.url: (r.discovered_time, r.source_page, r.last_seen) for r in micros(state, "discovered_time", "last_seen").collect()}
    assert found == {
        "a": (us(NOW - 50 * HOUR), "s", us(NOW)),
        "b": (us(NOW - 60 * HOUR), "s", us(NOW - 60 * HOUR)),
        "c": (us(NOW), "y", us(NOW)),
    }
    again = incremental.upsert_documents(state, seen, NOW)
    assert again.exceptAll(state).count() == 0 and state.exceptAll(again).count() == 0


def test_page_upsert_twice_changes_only_the_count(spark):
    crawled = spark.createDataFrame([("a", 7), ("n", 0)], "url string, pdf_count int")
    once = incremental.upsert_pages(page_cache(spark, ("a", 5 * HOUR), ("b", 6 * HOUR)), crawled, NOW)
    twice = incremental.upsert_pages(once, crawled, NOW)
    first = {r.url: tuple(r)[2:] for r in micros(once, "last_crawled").collect()}
    second = {r.url: tuple(r)[2:] for r in micros(twice, "last_crawled").collect()}
    assert first == {"a": (us(NOW), 7, 2), "b": (us(NOW - 6 * HOUR), 1, 1), "n": (us(NOW), 0, 1)}
    assert {u: r[:2] for u, r in first.items()} == {u: r[:2] for u, r in second.items()}
    assert {u: r[2] for u, r in second.items()} == {"a": 3, "b": 1, "n": 2}


def test_cache_stats(spark):
    stats = incremental.cache_stats(doc_cache(spark, ("a", HOUR), ("b", 30 * HOUR)), page_cache(spark, ("p", 24 * HOUR)), NOW).first()
    assert stats.asDict() == {
        "total_cached_documents": 2, "recent_documents": 1, "cache_age_hours": 30.0, "total_cached_pages": 1, "recent_pages": 0,
    }
    empty = incremental.cache_stats(doc_cache(spark).limit(0), page_cache(spark).limit(0), NOW).first()
    assert empty.cache_age_hours == 0.0 and empty.total_cached_pages == 0


def test_retention_is_strict(spark):
    day = 24 * HOUR
    docs = doc_cache(spark, ("under", 29 * day), ("at", 30 * day), ("over", 30 * day + timedelta(seconds=1)))
    assert sorted(r.url for r in incremental.drop_expired(docs, "last_seen", NOW).collect()) == ["at", "under"]
    counts = incremental.expired_counts(docs, page_cache(spark, ("p", 31 * day)), NOW).first()
    assert (counts.removed_documents, counts.removed_pages) == (1, 1)


def log(spark, *rows):
    names = [f.name for f in schemas.FETCH_LOG]
    blank = dict.fromkeys(names)
    data = [tuple({**blank, "method": "HEAD", "ts": NOW, "attempt": 1, "status": 200, **r}[n] for n in names) for r in rows]
    return spark.createDataFrame(data, schemas.FETCH_LOG)


def test_change_decision(spark):
    candidates = spark.createDataFrame([(u, f"p/{u}") for u in ["new", "lost", "same", "etag", "nulls", "dead"]], "url string, local_path string")
    stored = spark.createDataFrame([(f"p/{u}", 1) for u in ["lost", "same", "etag", "nulls", "dead"]], "local_path string, file_size long")
    registry = spark.createDataFrame(
        [(md5(u), u, f"p/{u}", NOW, 1, "h", m, e, 1) for u, m, e in [("new", "m", "e"), ("same", "m", "e"), ("etag", "m", "e"), ("nulls", None, "e"), ("dead", "m", "e")]],
        schemas.FILE_REGISTRY,
    )
    heads = log(
        spark,
        {"url": "same", "last_modified": "m", "etag": "e"},
        {"url": "etag", "last_modified": "m", "etag": "f"},
        {"url": "nulls", "etag": "e"},
        {"url": "dead", "status": 500, "etag": "z"},
    )
    found = {r.url: (r.reason, r.download) for r in incremental.change_decision(candidates, stored, registry, heads).collect()}
    assert found == {
        "new": ("not stored", True), "lost": ("not registered", True), "same": ("unchanged", False),
        "etag": ("changed", True), "nulls": ("unchanged", False), "dead": ("unchanged", False),
    }
    forced = incremental.change_decision(candidates, stored, registry, heads, force=True)
    assert {r.reason for r in forced.collect()} == {"forced"}


def test_latest_observation(spark):
    rows = log(spark, {"url": "u", "status": 404, "ts": NOW - HOUR}, {"url": "u"}, {"url": "u", "method": "GET", "status": 500, "ts": NOW + HOUR})
    assert [(r.url, r.status) for r in incremental.latest_by_url(rows, "HEAD").collect()] == [("u", 200)]


def test_registry_upsert_and_stats(spark):
    registry = spark.createDataFrame([(md5("a"), "a", "p/a", NOW - HOUR, 5, "h", "m", "e", 5), (md5("k"), "k", "p/k", NOW, 1, "h", None, None, None)], schemas.FILE_REGISTRY)
    downloads = spark.createDataFrame([("a", "q/a", bytearray(b"abc")), ("b", "q/b", bytearray(b""))], "url string, local_path string, body binary")
    state = incremental.upsert_registry(registry, downloads, log(spark, {"url": "b", "etag": "x", "content_length": 9}), NOW)
    found = {r.url: r for r in state.collect()}
    assert (found["a"].local_path, found["a"].file_size, found["a"].etag) == ("q/a", 3, None)
    assert found["a"].file_hash == hashlib.sha256(b"abc").hexdigest()
    assert (found["b"].file_size, found["b"].etag, found["b"].content_length) == (0, "x", 9)
    assert found["k"].local_path == "p/k"
    assert tuple(incremental.registry_stats(state).first()) == (3, 4, 4 / 1048576)
    assert tuple(incremental.registry_stats(state.limit(0)).first()) == (0, 0, 0.0)


def test_stored_files(spark):
    candidates = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "q"), ("d", "r")], "url string, local_path string")
    stored = spark.createDataFrame([("p", 3), ("q", 0)], "local_path string, file_size long")
    assert {(r.url, r.file_size) for r in incremental.stored_already(candidates, stored).collect()} == {("a", 3), ("b", 3)}
    assert {r.url for r in incremental.not_stored(candidates, stored).collect()} == {"c", "d"}


def test_url_verdicts(spark):
    heads = log(
        spark,
        {"url": "type", "content_type": "Application/PDF; charset=x"},
        {"url": "end.PDF", "content_type": "text/html"},
        {"url": "named", "content_disposition": 'attachment; filename="X.PDF"'},
        {"url": "plain", "content_type": "text/html"},
        {"url": "gone.pdf", "status": 404, "content_type": "application/pdf"},
    )
    signed = ["s.pdf?X-Amz-Signature=1", "s?X-Amz-Algorithm=1"]
    candidates = urls(spark, "type", "end.PDF", "named", "plain", "gone.pdf", "silent.pdf", *signed)
    found = {r.url: (r.verdict, r.valid) for r in validate.url_verdicts(candidates, heads).collect()}
    assert found == {
        "type": ("content type", True), "end.PDF": ("url ending", True), "named": ("disposition", True),
        "plain": ("not a document", False), "gone.pdf": ("bad status", False), "silent.pdf": ("no answer", False),
        signed[0]: ("signed", True), signed[1]: ("no answer", False),
    }


def test_sniffed_verdicts(spark):
    heads = log(
        spark,
        {"url": "octet", "content_type": "application/octet-stream"}, {"url": "none"}, {"url": "html.pdf", "content_type": "text/html"},
        {"url": "other", "content_type": "application/octet-stream; x"}, {"url": "noise"},
    )
    bodies = spark.createDataFrame([(u, bytearray(b)) for u, b in [("octet", b"%PDF1"), ("none", b"%PDF"), ("html.pdf", b"%PDF"), ("other", b"%PDF"), ("noise", b"<html")]], schemas.BODIES)
    found = {r.url: r.verdict for r in validate.sniffed_verdicts(urls(spark, "octet", "none", "html.pdf", "other", "noise"), heads, bodies).collect()}
    assert found == {"octet": "signature", "none": "signature", "html.pdf": "not a document", "other": "not a document", "noise": "not a document"}


def test_content_checks(spark):
    full = b"%PDF-1.4" + b"x" * 200 + b"%%EOF"
    cases = {
        "full": full, "late": b"%PDF-" + b"%%EOF" + b"x" * 1024, "edge": b"%PDF-" + b"%%EOF" + b"x" * 1019,
        "short": b"%PDF-" + b"x" * 94, "least": b"%PDF-" + b"x" * 95, "html": b"<html>" + b"x" * 200, "empty": b"",
    }
    bodies = spark.createDataFrame([(u, bytearray(b)) for u, b in cases.items()] + [("null", None)], schemas.BODIES)
    checks = validate.content_checks(bodies)
    found = {r.url: (r.bytes, r.reason, r.has_trailer, r.valid) for r in checks.collect()}
    assert found == {
        "full": (213, "ok", True, True), "late": (1034, "ok", False, True), "edge": (1029, "ok", True, True),
        "short": (99, "too short", False, False), "least": (100, "ok", False, True),
        "html": (206, "wrong header", False, False), "empty": (0, "empty", False, False), "null": (0, "empty", False, False),
    }
    assert {r.reason: r.bodies for r in validate.content_summary(checks).collect()} == {"ok": 4, "too short": 1, "wrong header": 1, "empty": 2}


def test_size_limit(spark):
    mb = 1048576
    heads = log(spark, {"url": "at", "content_length": 50 * mb}, {"url": "over", "content_length": 50 * mb + mb // 4}, {"url": "unknown"})
    assert [(r.url, r.error) for r in validate.oversized(heads).collect()] == [("over", "File too large (50.2MB), skipping")]


def test_download_outcome_order(spark):
    names = ["kept", "bad", "net", "big", "noise", "full", "good"]
    candidates = spark.createDataFrame([("D", u, f"p/{u}") for u in names], "department string, url string, local_path string")
    decisions = spark.createDataFrame([(u, f"p/{u}", u != "kept") for u in names], "url string, local_path string, download boolean")
    verdicts = spark.createDataFrame([(u, u != "bad") for u in names], "url string, valid boolean")
    gets = log(spark, *[{"url": u} for u in names if u not in ("net", "big")], {"url": "net", "status": None, "error": "timeout"}, {"url": "big", "content_length": 99 * 1048576})
    checks = spark.createDataFrame([(u, 100, u != "noise") for u in names], "url string, bytes long, valid boolean")
    stored = spark.createDataFrame([("p/kept", 7)], "local_path string, file_size long")
    out = validate.download_outcome(candidates, decisions, verdicts, gets, checks, stored, urls(spark, "full"), 50)
    found = {r.url: (r.success, r.error, r.file_size, r.skipped) for r in out.collect()}
    assert found == {
        "kept": (True, None, 7, True),
        "bad": (False, "URL does not point to a valid PDF file", 0, False),
        "net": (False, "Network error: timeout", 0, False),
        "big": (False, "File too large (99.0MB), skipping", 0, False),
        "noise": (False, "Downloaded content is not a valid PDF file", 0, False),
        "full": (False, "Failed to save file locally", 0, False),
        "good": (True, None, 100, False),
    }


def test_config_violations(spark):
    departments = spark.createDataFrame([("a", "A", 3, 1), ("b", None, 3, 1), ("c", " ", 3, 1)], schemas.DEPARTMENTS)
    seeds = spark.createDataFrame([("a", 0, "u"), ("b", 0, None)], schemas.SEEDS)
    found = {tuple(r) for r in validate.config_violations(departments, seeds).collect()}
    assert found == {
        ("b", "department has no name"), ("c", "department has no name"),
        ("b", "department has no seed url"), ("c", "department has no seed url"),
    }
    assert [r.violation for r in validate.config_violations(departments.limit(0), seeds).collect()] == ["no departments"]


def test_collisions_and_duplicates(spark):
    docs = spark.createDataFrame([("http://a/1/x.pdf", "D"), ("http://a/2/x.html", "D"), ("http://a/2/x.html", "D"), ("http://a/y", "D")], "url string, department string")
    placed = layout.with_layout(docs, "/base")
    assert [tuple(r) for r in layout.path_collisions(placed).collect()] == [("/base/D/x.pdf", 2, "http://a/1/x.pdf")]
    files = spark.createDataFrame([("b", "h", 5), ("a", "h", 5), ("c", "i", 9)], "url string, file_hash string, file_size long")
    assert [tuple(r) for r in layout.content_duplicates(files).collect()] == [("h", 2, "a", 5)]


def test_changed_names(spark):
    names = spark.createDataFrame([("a b.pdf",), ("a_b.pdf",), ("a  b.pdf",), ("ok.pdf",)], "name string")
    assert {tuple(r) for r in layout.changed_names(names).collect()} == {("a b.pdf", "a_b.pdf", 3), ("a  b.pdf", "a_b.pdf", 3)}


def test_batch_summary(spark):
    rows = spark.createDataFrame([(True, 5), (False, 7), (True, 2)], "success boolean, file_size long")
    assert tuple(layout.batch_summary(rows).first()) == (2, 1, 7)


def test_state_versions(spark, folder):
    path = f"{folder}/state"
    assert load_state(spark, path, schemas.DOC_CACHE).count() == 0
    assert save_state(doc_cache(spark, ("a", HOUR)), path) == 0
    state = load_state(spark, path, schemas.DOC_CACHE)
    assert save_state(incremental.upsert_documents(state, spark.createDataFrame([("b", "s")], "url string, source_page string"), NOW), path) == 1
    assert versions(spark, path) == [0, 1]
    assert load_state(spark, path, schemas.DOC_CACHE).count() == 2
    assert load_state(spark, path, schemas.DOC_CACHE, before=1).count() == 1


def test_a_write_without_its_mark_is_ignored(spark, folder):
    path = f"{folder}/state"
    save_state(doc_cache(spark, ("a", HOUR)), path)
    doc_cache(spark, ("b", HOUR), ("c", HOUR)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/version=1")
    assert versions(spark, path) == [0]
    assert load_state(spark, path, schemas.DOC_CACHE).count() == 1


def test_unsupported_report_format(spark, folder):
    from crawlspark.sources.sinks import save_report

    with pytest.raises(ValueError, match="Unsupported format"):
        save_report(None, None, folder, NOW, "xml")
