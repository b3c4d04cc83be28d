import random
from collections import deque

from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators import walk
from crawlspark.operators.departments import documents_found, select_departments


def fifo(seed, edges, max_depth):
    """The walk as a queue, one url at a time."""
    found, queue = [], deque([(seed, 0)])
    while queue:
        url, depth = queue.popleft()
        if url in found:
            continue
        found.append(url)
        if depth < max_depth:
            queue.extend((t, depth + 1) for t in edges.get(url, []) if t not in found)
    return found


def walked(spark, seeds, edges, max_depth):
    seed_rows = spark.createDataFrame([("d", i, s) for i, s in enumerate(seeds)], schemas.SEEDS)
    edge_rows = spark.createDataFrame(
        [(i, u, t) for i, (u, t) in enumerate(edges.items())], "page_id long, url string, targets array<string>"
    )
    return walk.bounded_walk(seed_rows, edge_rows, max_depth)


def chain(spark, length):
    return spark.createDataFrame(
        [(i, f"http://h/{i:05d}", [f"http://h/{i + 1:05d}"]) for i in range(length)], "page_id long, url string, targets array<string>"
    )


def test_a_department_may_go_deeper_than_the_default_and_null_means_the_default(spark):
    shape = "dept_key string, seed_ord int, url string, max_depth int"
    seeds = spark.createDataFrame([("deep", 0, "http://h/00000", 7), ("none", 0, "http://h/00000", None)], shape)
    rows = walk.bounded_walk(seeds, chain(spark, 20)).groupBy("dept_key").count().collect()
    assert {r.dept_key: r["count"] for r in rows} == {"deep": 8, "none": 4}


def test_page_caps_of_departments(spark):
    shape = "dept_key string, seed_ord int, url string, depth int, trail array<int>, max_pages int"
    rows = [(d, 0, f"u{i:05d}", 1, [i], cap) for d, cap in (("a", 1500), ("b", 2), ("c", None)) for i in range(1600)]
    capped = walk.page_cap(spark.createDataFrame(rows, shape))
    found = {r.dept_key: (r.n, r.last) for r in capped.groupBy("dept_key").agg(F.count("*").alias("n"), F.max("url").alias("last")).collect()}
    assert found == {"a": (1500, "u01499"), "b": (2, "u00001"), "c": (1000, "u00999")}


def test_walk_meets_urls_in_queue_order(spark):
    random.seed(5)
    names = [f"http://h/{i}" for i in range(40)]
    for max_depth in (0, 1, 3):
        edges = {n: random.sample(names, random.randint(0, 5)) for n in names if random.random() < 0.8}
        seeds = names[:3]
        rows = walked(spark, seeds, edges, max_depth).orderBy("seed_ord", *walk.walk_order()).collect()
        for i, seed in enumerate(seeds):
            assert [r.url for r in rows if r.seed_ord == i] == fifo(seed, edges, max_depth)


def test_a_department_may_stop_earlier(spark):
    seeds = spark.createDataFrame([("a", 0, "http://h/0", 1), ("b", 0, "http://h/0", 3)], "dept_key string, seed_ord int, url string, max_depth int")
    edges = spark.createDataFrame(
        [(i, f"http://h/{i}", [f"http://h/{i + 1}"]) for i in range(5)], "page_id long, url string, targets array<string>"
    )
    rows = walk.bounded_walk(seeds, edges, 3).groupBy("dept_key").count().collect()
    assert {r.dept_key: r["count"] for r in rows} == {"a": 2, "b": 4}


def test_latest_version_of_a_page_counts(spark):
    seeds = spark.createDataFrame([("a", 0, "http://h/0")], schemas.SEEDS)
    edges = spark.createDataFrame(
        [(1, "http://h/0", ["http://h/old"]), (2, "http://h/0", ["http://h/new"])], "page_id long, url string, targets array<string>"
    )
    assert {r.url for r in walk.bounded_walk(seeds, edges, 2).collect()} == {"http://h/0", "http://h/new"}


def test_page_cap_keeps_the_first(spark):
    edges = {"http://h/s": [f"http://h/{c}" for c in "zyxw"]}
    capped = walk.page_cap(walked(spark, ["http://h/s"], edges, 1), 3)
    assert {r.url for r in capped.collect()} == {"http://h/s", "http://h/z", "http://h/y"}


def test_union_keeps_the_first_strategy(spark):
    shape = "dept_key string, seed_ord int, url string, depth int, trail array<int>"
    first = spark.createDataFrame([("a", 0, "u", 2, [1, 2]), ("a", 0, "v", 1, [0])], shape)
    second = spark.createDataFrame([("a", 0, "u", 0, []), ("a", 0, "w", 0, []), ("b", 0, "u", 0, [])], shape)
    rows = walk.union_discoveries(first, second).collect()
    assert {(r.dept_key, r.url, r.strategy, r.depth) for r in rows} == {
        ("a", "u", 0, 2), ("a", "v", 0, 1), ("a", "w", 1, 0), ("b", "u", 1, 0),
    }


RULES = [
    ("h", 1, "*", False, "/private"),
    ("h", 2, "*", True, "/private/open"),
    ("h", 3, "*", False, "/a%20b"),
    ("h", 9, "*", False, "/private"),
    ("i", 1, "*", False, "/"),
    ("i", 2, "Bot", False, "/x"),
    ("i", 3, "Bot", False, ""),
    ("labour.gov.hk", 1, "*", False, "/"),
]


def allowed(spark, agent, *urls):
    rules = spark.createDataFrame(RULES, schemas.ROBOTS_RULES)
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    found = {r.url: r.allowed for r in walk.robots_allowed(rows, rules, agent).collect()}
    return [found[u] for u in urls]


def test_robots_first_rule_decides(spark):
    assert allowed(spark, "*", "http://h/private/open", "http://h/public", "http://h/a b/c", "http://h") == [False, True, False, True]


def test_robots_unknown_and_always_allowed_hosts(spark):
    assert allowed(spark, "*", "http://none/x", "http://www.labour.gov.hk/x", "http://i/x") == [True, True, False]


def test_robots_section_of_the_agent_wins(spark):
    assert allowed(spark, "my-bot/1.0", "http://i/x1", "http://i/y") == [False, True]


def test_robots_with_very_many_rules_on_a_host(spark):
    n = 100_000
    rules = spark.range(n).select(
        F.lit("big").alias("host"), F.col("id").cast("int").alias("line_no"), F.lit("*").alias("agent"),
        (F.col("id") % 3 == 0).alias("allow"), F.concat(F.lit("/d/"), F.col("id").cast("string")).alias("path_prefix"),
    )
    rows = spark.range(0, n, 500).select(F.concat(F.lit("http://big/d/"), F.col("id").cast("string"), F.lit("/x")).alias("url"))
    found = walk.robots_allowed(rows, rules)
    assert "collect_list" not in found._jdf.queryExecution().toString()

    def first(number):
        # The shortest beginning is also the first line.
        return min(int(str(number)[:k]) for k in range(1, len(str(number)) + 1)) % 3 == 0

    assert {r.url: r.allowed for r in found.collect()} == {f"http://big/d/{i}/x": first(i) for i in range(0, n, 500)}


def test_robots_keeps_repeated_urls_and_columns(spark):
    rules = spark.createDataFrame([("h", 1, "*", False, "*"), ("h", 0, "*", True, "/a"), ("g", 1, "*", False, ""), ("g", 2, "*", False, "/")], schemas.ROBOTS_RULES)
    rows = spark.createDataFrame([("http://h/a", "1"), ("http://h/a", "2"), ("http://h/b", "3"), ("http://g/b", "4"), (None, "5")], "url string, host string")
    found = walk.robots_allowed(rows, rules)
    assert found.columns == ["url", "host", "allowed"]
    assert sorted((r.host, r.allowed) for r in found.collect()) == [("1", True), ("2", True), ("3", False), ("4", True), ("5", True)]


def test_robots_may_be_switched_off(spark):
    rows = spark.createDataFrame([("http://i/x",)], "url string")
    rules = spark.createDataFrame(RULES, schemas.ROBOTS_RULES)
    assert walk.robots_allowed(rows, rules, respect_robots=False).first().allowed


def test_departments_by_key_or_name(spark):
    rows = spark.createDataFrame([("a", "A dept", 3, 10), ("b", "B dept", 3, 10), ("c", "C dept", 3, 10)], schemas.DEPARTMENTS)
    assert {r.dept_key for r in select_departments(rows, ["a", "C dept"]).collect()} == {"a", "c"}
    assert select_departments(rows).count() == 3


def test_documents_found_are_distinct(spark):
    visited = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "p"), ("a", "p")], "dept_key string, url string")
    documents = spark.createDataFrame([("p", "1"), ("q", "1"), ("q", "2"), ("r", "3")], "page_url string, target_url string")
    more = spark.createDataFrame([("b", "9"), ("a", "2")], "dept_key string, target_url string")
    found = documents_found(visited, documents, more).select(F.concat("dept_key", "target_url").alias("o")).collect()
    assert sorted(r.o for r in found) == ["a1", "a2", "b1", "b9"]
