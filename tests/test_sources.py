from datetime import datetime, timezone
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlspark import lineage, schemas
from crawlspark.operators.validate import config_violations
from crawlspark.sources import seeds, sitemaps, tables

MARKDOWN = """# List
https://ignored.example/before
## 1. Labour Department (LD):
1. **Guides**: https://www.labour.example/a.htm.
2. **More** (https://www.labour.example/b), https://www.labour.example/a.htm;

## 2. Fire & Rescue:
   * https://fire.example/x?y=1,
## 3. Empty Department (ED):
nothing here
### 4. no header (X):
## 5. Buildings : extra
https://still.empty.example/
## 6. Twice:
https://first.example/
## 7. Twice (T):
https://second.example/
"""


def test_markdown_seeds(spark, folder):
    Path(f"{folder}/list.md").write_text(MARKDOWN, encoding="utf-8")
    found = seeds.seeds_from_lines(seeds.read_markdown_lines(spark, f"{folder}/list.md"))
    rows = {(r.dept_key, r.name, r.seed_ord, r.url) for r in found.collect()}
    assert rows == {
        ("labour_department", "Labour Department", 0, "https://www.labour.example/a.htm"),
        ("labour_department", "Labour Department", 1, "https://www.labour.example/b"),
        ("fire__rescue", "Fire & Rescue", 0, "https://fire.example/x?y=1"),
        ("empty_department", "Empty Department", 0, "https://still.empty.example/"),
        ("twice", "Twice", 0, "https://second.example/"),
    }
    departments = seeds.departments_of_seeds(found).collect()
    assert {(r.dept_key, r.max_depth, r.max_pages) for r in departments} == {
        (k, 3, 500) for k in ["labour_department", "fire__rescue", "empty_department", "twice"]
    }


def test_a_large_markdown_file_is_read_in_splits(spark, folder):
    lines = []
    for number in range(400):
        lines += [f"## {number}. Part {number % 150} (P):", f"see http://p/{number}/a and", "", f"- http://p/{number % 7}/b."]
    Path(f"{folder}/large.md").write_text("\n".join(lines), encoding="utf-8")
    Path(f"{folder}/small.md").write_text("## 1. Part 1 (P):\nhttp://small/", encoding="utf-8")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    read = seeds.read_markdown_lines(session, f"{folder}/large.md")
    assert session.read.text(f"{folder}/large.md").rdd.getNumPartitions() > 5
    assert [r.line for r in read.orderBy("line_no").collect()] == lines and read.agg({"line_no": "max"}).first()[0] == len(lines) - 1
    found = seeds.seeds_from_lines(seeds.read_markdown_lines(session, folder)).collect()
    expected = {}
    for number in range(400):
        # A key that comes again in a file starts over.
        expected[f"part_{number % 150}"] = [f"http://p/{number}/a", f"http://p/{number % 7}/b"]
    expected["part_1"].append("http://small/")
    rows = {}
    for r in sorted(found, key=lambda r: r.seed_ord):
        rows.setdefault(r.dept_key, []).append(r.url)
    assert rows == expected


CONFIG = """
departments:
  a: {name: A dept, seed_urls: [http://a/1, http://a/2], max_depth: 2, max_pages: 7}
  b: {seed_urls: [http://b/]}
  c: {name: C dept}
"""


def test_yaml_departments(spark, folder):
    Path(f"{folder}/c.yaml").write_text(CONFIG)
    departments, found = seeds.departments_from_mapping(spark, seeds.load_yaml(f"{folder}/c.yaml"))
    assert {tuple(r) for r in departments.collect()} == {("a", "A dept", 2, 7), ("b", None, 3, 1000), ("c", "C dept", 3, 1000)}
    assert {tuple(r) for r in found.collect()} == {("a", 0, "http://a/1"), ("a", 1, "http://a/2"), ("b", 0, "http://b/")}
    assert {tuple(r) for r in config_violations(departments, found).collect()} == {
        ("b", "department has no name"), ("c", "department has no seed url"),
    }


def test_broken_configuration(spark, folder):
    Path(f"{folder}/empty.yaml").write_text("")
    with pytest.raises(ValueError, match="empty"):
        seeds.load_yaml(f"{folder}/empty.yaml")
    with pytest.raises(ValueError, match="'departments' section"):
        seeds.departments_from_mapping(spark, {"settings": {}})
    with pytest.raises(ValueError, match="must be a dictionary"):
        seeds.departments_from_mapping(spark, {"departments": {"a": "x"}})


NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def urlset(*locs):
    return f'<?xml version="1.0"?><urlset {NS}>' + "".join(f"<url><loc>{x}</loc><priority>1</priority></url>" for x in locs) + "</urlset>"


def index(*locs):
    return f"<sitemapindex {NS}>" + "".join(f"<sitemap><loc> {x} </loc></sitemap>" for x in locs) + "</sitemapindex>"


def listed(spark, *rows):
    table = spark.createDataFrame(list(rows), schemas.SITEMAPS)
    return {(r.host, r.url) for r in sitemaps.sitemap_urls(table).collect()}


def test_sitemaps(spark):
    found = listed(
        spark,
        ("a.b", "https://a.b/sitemap_index.xml", urlset("https://a.b/lost")),
        ("a.b", "https://a.b/sitemap.xml", index("https://a.b/n1.xml", "https://a.b/n2.xml", "https://a.b/none.xml")),
        ("a.b", "https://a.b/n1.xml", urlset("https://a.b/1?x=1&amp;y=2", "https://www.a.b/other", "https://a.b:80/port")),
        ("a.b", "https://a.b/n2.xml", index("https://a.b/n3.xml", "https://a.b/n2.xml")),
        ("a.b", "https://a.b/n3.xml", urlset("https://a.b/deep")),
        ("c.d", "https://c.d/sitemap.xml", "<urlset><url><loc>https://c.d/broken</loc></url>"),
        ("e.f", "http://e.f/sitemap.xml", urlset("http://e.f/x", "http://e.f/x")),
        ("g.h", "https://g.h/elsewhere.xml", urlset("https://g.h/never")),
        ("i.j", "https://i.j/sitemaps.xml", f'<s:urlset xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9"><s:url><s:loc>https://i.j/p</s:loc></s:url></s:urlset>'),
    )
    assert found == {
        ("a.b", "https://a.b/1?x=1&y=2"), ("a.b", "https://a.b/deep"), ("e.f", "http://e.f/x"), ("i.j", "https://i.j/p"),
    }


def test_sitemaps_nest_as_deep_as_they_like(spark):
    rows = [("a", "https://a/sitemap.xml", index("https://a/0"))]
    rows += [("a", f"https://a/{i}", index(f"https://a/{i + 1}", "https://a/sitemap.xml")) for i in range(12)]
    assert listed(spark, *rows, ("a", "https://a/12", urlset("https://a/found"))) == {("a", "https://a/found")}


def test_fetch_log_from_text(spark, folder):
    names = [f.name for f in schemas.FETCH_LOG]
    Path(f"{folder}/log.json").write_text('{"url": "u", "method": "GET", "ts": 1700000000.25, "attempt": 1, "status": 200}\n')
    row = tables.read_fetch_log(spark, f"{folder}/log.json", "json").select(*names, F.unix_micros("ts").alias("us")).first()
    assert (row.url, row.status, row.us) == ("u", 200, 1700000000250000)
    Path(f"{folder}/bad.json").write_text('{"url": "u", "ts": \n')
    with pytest.raises(Exception):
        tables.read_fetch_log(spark, f"{folder}/bad.json", "json").collect()


def test_pages_and_log_from_parquet(spark, folder):
    spark.createDataFrame([(1, "u", "h")], schemas.PAGES).write.parquet(f"{folder}/pages")
    assert tables.read_pages(spark, f"{folder}/pages").first().html == "h"
    assert tables.stream_pages(spark, f"{folder}/pages").isStreaming
    moment = datetime(2025, 1, 1, tzinfo=timezone.utc)
    spark.createDataFrame([("u", "GET", moment, 1, 200, None, None, None, None, None, None, 5)], schemas.FETCH_LOG).write.parquet(f"{folder}/log")
    assert tables.read_fetch_log(spark, f"{folder}/log").first().status == 200


def test_tables_of_a_run_can_be_removed(spark):
    kept = lineage.cut_lineage(spark.range(3), "kept")
    assert kept.count() == 3 and lineage.run_folder(spark) in kept.inputFiles()[0]
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.range(3).write.parquet(f"{lineage.run_folder(spark, folder)}/gone")
    assert list(Path(folder).rglob("*.parquet"))
    assert lineage.remove_run_tables(spark, folder) and not list(Path(folder).rglob("*.parquet"))
    assert kept.count() == 3
