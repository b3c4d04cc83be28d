import random

from pyspark.sql import functions as F

from crawlspark.operators import attempts, ordered, pacing
from crawlspark.operators.lookup import join_lookup, on_listed
from crawlspark.operators.ordered import row_numbers

SECOND = pacing.SECOND


def requests(n=400):
    random.seed(2)
    return [
        (f"d{random.choice([0, 0, 0, 0, 1, 2, 3])}", i, random.choice([0, 0, 1, 2, 5]) * SECOND, random.randint(0, 4 * SECOND))
        for i in range(n)
    ]


def recurrence(rows, gap):
    free, out = {}, {}
    for domain, i, arrival, duration in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        out[i] = max(arrival, free.get(domain, arrival))
        free[domain] = out[i] + max(gap, duration)
    return out


def test_plan_equals_the_recurrence_for_any_number_of_chunks(spark):
    rows = requests()
    df = spark.createDataFrame(rows, "domain string, url int, arrival_us long, duration_us long")
    expected = recurrence(rows, SECOND)
    for chunks in (1, 7, 50):
        found = pacing.gap_plan(df, 1.0, chunks=chunks).collect()
        assert {r.url: r.start_us for r in found} == expected
        assert all(r.wait_us == r.start_us - r.arrival_us >= 0 for r in found)


def test_planned_starts_keep_the_gap(spark):
    df = spark.createDataFrame(requests(), "domain string, url int, arrival_us long, duration_us long")
    planned = pacing.gap_plan(df, 1.0).select("domain", "url", F.col("start_us").alias("ts_us"))
    assert pacing.gap_violations(planned, 1.0).count() == 0


def test_gap_audit(spark):
    rows = [("a", 0, 0), ("a", 1, 400_000), ("a", 2, 400_000), ("a", 3, 5 * SECOND), ("b", 4, 7)]
    df = spark.createDataFrame(rows, "domain string, url int, ts_us long")
    found = {r.domain: tuple(r)[1:] for r in pacing.gap_audit(df, 1.0, chunks=3).collect()}
    assert found == {"a": (4, 2, 0, 5 * SECOND / 3), "b": (1, 0, None, None)}
    assert sorted(r.url for r in pacing.gap_violations(df, 1.0).collect()) == [1, 2]


def test_a_busy_key_spreads_over_chunks_and_keeps_its_numbers(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").alias("o"),
    )
    numbered = row_numbers(df, "k", ["o"], "n", 16)
    hot = numbered.where("k = 'hot'")
    assert hot.where(F.col("n") != F.col("o") + 1).count() == 0
    assert numbered.where("k <> 'hot' and n <> 1").count() == 0


def test_rows_without_a_key_are_one_group(spark):
    df = spark.range(500).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("o"))
    numbered = row_numbers(df, "k", ["o"], "n", 8)
    assert numbered.where(F.col("n") == F.col("o") + 1).count() == 500


def test_hot_keys_are_split_in_lookup_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = F.col("id").cast("string")
        rows = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.md5(text)).alias("k"), F.sha2(text, 256).alias("v")
        )
        lookup = rows.groupBy("k").agg(F.max("v").alias("m"))
        joined = join_lookup(rows, lookup, "k")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_domains(spark):
    df = spark.createDataFrame([("http://a:1/x",), ("http://a:1/y",), ("http://b/",)], "url string")
    assert {tuple(r) for r in pacing.domains_tracked(df).collect()} == {("a:1", 2), ("b", 1)}
    assert pacing.domain_count(df).first().domains_tracked == 2


def test_attempts(spark):
    rows = [
        ("second", 1, False, "Connection reset"), ("second", 2, True, None),
        ("timeouts", 1, False, "Timeout 1"), ("timeouts", 2, False, "Timeout 2"), ("timeouts", 3, False, "Timeout 3"),
        ("timeouts", 4, True, None),
        ("missing", 1, False, "404 Not Found"), ("missing", 2, True, None),
        ("server", 1, False, "HTTP 503"), ("server", 2, True, None),
        ("open", 1, False, "network down"),
        ("silent", 1, False, None), ("silent", 2, True, None),
    ]
    df = spark.createDataFrame(rows, "url string, attempt int, success boolean, error string")
    found = {r.url: tuple(r)[1:] for r in attempts.attempt_outcome(df).collect()}
    assert found == {
        "second": (True, None, 2, 1),
        "timeouts": (False, "Failed after 3 attempts: Timeout 3", 3, 3),
        "missing": (False, "404 Not Found", 1, 0),
        "server": (True, None, 2, 1),
        "open": (False, "network down", 1, 0),
        "silent": (False, None, 1, 0),
    }


def test_error_classes(spark):
    rows = [("Read TIMEOUT",), ("connection refused",), ("HTTP 503",), ("404",), (None,), ("Connection timeout",)]
    df = spark.createDataFrame(rows, "error string")
    found = {(r.error_class, r.retryable): r.failures for r in attempts.error_classes(df).collect()}
    assert found == {("timeout", True): 2, ("connection", True): 1, ("503", True): 1, ("other", False): 1}


def test_fetch_trouble(spark):
    df = spark.createDataFrame([(500, None), (404, None), (None, "Connection aborted"), (None, "bad"), (200, None)], "status int, error string")
    assert [r.retry for r in attempts.fetch_trouble(df).collect()] == [True, False, True, False, False]


def test_on_listed_keeps_the_rows_of_the_list(spark):
    rows = spark.createDataFrame([(u, "wide") for u in "aabbcd"], "url string, html string")
    listed = spark.createDataFrame([("a",), ("c",), ("x",)], "k string")
    found = on_listed(rows, listed, F.col("url"))
    assert sorted(r.url for r in found.collect()) == ["a", "a", "c"] and found.columns == ["url", "html"]


def test_values_carried_over_chunks(spark):
    rows = [("a" if i % 3 else "b", i, None if i % 5 else i) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, place long, value long")
    for chunks in (1, 7):
        filled = {(r.key, r.place): r.value for r in ordered.last_known(df, "key", ["place"], "value", chunks).collect()}
        largest = {(r.key, r.place): r.most for r in ordered.largest_before(df, "key", ["place"], "value", "most", chunks).collect()}
        for key, place, _ in rows:
            until = [v for k, p, v in rows if k == key and p <= place and v is not None]
            before = [v for k, p, v in rows if k == key and p < place and v is not None]
            assert filled[key, place] == (until[-1] if until else None)
            assert largest[key, place] == max(before, default=None)


def test_busy_time_counts_overlaps_once(spark):
    rows = [("a", 0, 10), ("a", 2, 3), ("a", 5, 12), ("a", 20, 21), ("a", 20, 21), ("a", 30, None), ("a", 40, 35), ("b", 7, 9), ("c", None, 5)]
    rows += [("busy", i, i + 3) for i in range(0, 400, 2)]
    df = spark.createDataFrame(rows, "department string, start_us long, end_us long")
    for chunks in (1, 8):
        found = {r.department: (r.busy_us, r.fetches) for r in pacing.busy_time(df, chunks=chunks).collect()}
        assert found == {"a": (13, 7), "b": (2, 1), "busy": (401, 200)}
