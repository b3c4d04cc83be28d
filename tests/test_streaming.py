from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators import incremental, pacing
from crawlspark.sources import state as sources_state
from crawlspark.streaming import counters, first_seen, gaps, upserts

START = datetime(2025, 1, 1, tzinfo=timezone.utc)
MINUTE = timedelta(minutes=1)


def stream(spark, path, schema):
    """One file per micro-batch, in the order written."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def feed(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def run(df, folder, mode="append"):
    finish(
        df.writeStream.outputMode(mode).format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    )


def test_windowed_counters_equal_the_batch(spark, folder):
    rows = [(START + i * MINUTE, f"d{i % 2}", "ok", i) for i in range(180)]
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, rows[:90])
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, rows[90:])
    out = {}

    def keep(batch, _):
        out.update({tuple(r)[:3]: tuple(r)[3:] for r in batch.withColumn("window_start", F.unix_micros("window_start")).collect()})

    source = stream(spark, f"{folder}/in", schemas.PROGRESS_EVENTS)
    finish(
        counters.windowed_counters(source, "1 hour", "10 minutes").writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    )
    batch = counters.windowed_counters(spark.read.parquet(f"{folder}/in"), "1 hour")
    expected = {tuple(r)[:3]: tuple(r)[3:] for r in batch.withColumn("window_start", F.unix_micros("window_start")).collect()}
    assert out == expected and len(out) == 6


def test_late_events_are_not_counted(spark, folder):
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, [(START, "d", "ok", 1)])
    # Lateness is judged by the watermark of the batch before, so two batches have to move it.
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, [(START + 300 * MINUTE, "d", "ok", 1)])
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, [(START + 310 * MINUTE, "d", "ok", 1)])
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, [(START + 1 * MINUTE, "d", "ok", 1), (START + 600 * MINUTE, "d", "ok", 1)])
    feed(spark, f"{folder}/in", schemas.PROGRESS_EVENTS, [(START + 900 * MINUTE, "d", "ok", 1)])
    run(counters.windowed_counters(stream(spark, f"{folder}/in", schemas.PROGRESS_EVENTS), "1 hour", "10 minutes"), folder)
    closed = {int(r.us): r.n for r in spark.read.parquet(f"{folder}/out").select(F.unix_micros("window_start").alias("us"), "n").collect()}
    assert closed[int(START.timestamp()) * 1_000_000] == 1


LINKS = "ts timestamp, url string"


def test_first_seen_across_batches(spark, folder):
    feed(spark, f"{folder}/in", LINKS, [(START, "a"), (START, "b"), (START, "a")])
    feed(spark, f"{folder}/in", LINKS, [(START + MINUTE, "a"), (START + MINUTE, "c")])
    run(first_seen.first_seen(stream(spark, f"{folder}/in", LINKS), "1 day"), folder)
    assert sorted(r.url for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "b", "c"]


def test_first_seen_forgets_after_the_retention(spark, folder):
    hours = timedelta(hours=1)
    feed(spark, f"{folder}/in", LINKS, [(START, "a")])
    feed(spark, f"{folder}/in", LINKS, [(START + 5 * hours, "x")])
    feed(spark, f"{folder}/in", LINKS, [(START + 6 * hours, "y")])
    feed(spark, f"{folder}/in", LINKS, [(START + 10 * hours, "a")])
    run(first_seen.first_seen(stream(spark, f"{folder}/in", LINKS), "1 hour"), folder)
    assert sorted(r.url for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "a", "x", "y"]


SIGHTS = "url string, ts_us long"
HOUR = 3600 * pacing.SECOND


def test_every_sight_renews_the_retention(spark, folder):
    # "kept" is seen every ten hours, "left" comes again after thirty, "gone" never does.
    for batch in ([("kept", 0), ("left", 0), ("gone", 0)], [("kept", 10)], [("kept", 20), ("other", 21)], [("kept", 30), ("left", 30)], [("end", 60)], [("end", 60)]):
        feed(spark, f"{folder}/in", SIGHTS, [(u, h * HOUR) for u, h in batch])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(first_seen.stream_first_seen(stream(spark, f"{folder}/in", SIGHTS), out, state, 0.5, 60))
    held = {r.url_hash for r in first_seen.sights_held(spark, state).collect()}
    first_seen.release_sights(spark, out, state, 0.5)
    found = sorted((r.url, r.ts_us // HOUR) for r in first_seen.first_sights(spark, out).collect())
    assert found == [("end", 60), ("gone", 0), ("kept", 0), ("left", 0), ("left", 30), ("other", 21)]
    assert not held, "all of them ran out before the last batch"


def test_late_sights_and_sights_out_of_order(spark, folder):
    for batch in ([("a", 5), ("b", 5)], [("a", 3), ("c", 40)], [("b", 39), ("a", 1), ("d", None)], [("e", 100)]):
        feed(spark, f"{folder}/in", SIGHTS, [(u, None if h is None else h * HOUR) for u, h in batch])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(first_seen.stream_first_seen(stream(spark, f"{folder}/in", SIGHTS), out, state, 1.0, 4 * 3600))
    first_seen.release_sights(spark, out, state, 1.0)
    found = sorted((r.url, r.ts_us // HOUR) for r in first_seen.first_sights(spark, out).collect())
    # The sight at three o'clock came after that at five, but counts before it.
    assert found == [("a", 3), ("b", 5), ("b", 39), ("c", 40), ("e", 100)]
    assert sorted(r.url for r in first_seen.late_sights(spark, out).collect()) == ["a", "d"]


def test_a_key_of_first_sights_has_many_urls(spark, folder):
    feed(spark, f"{folder}/in", SIGHTS, [(f"u{i}", h * HOUR) for i in range(3000) for h in (1, 2)] + [(None, HOUR)])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(first_seen.stream_first_seen(stream(spark, f"{folder}/in", SIGHTS), out, state, 1.0, 3600))
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(state)
    # One key per url would be 3001.
    assert waiting.select("key").distinct().count() <= first_seen.BUCKETS
    first_seen.release_sights(spark, out, state, 1.0)
    found = first_seen.first_sights(spark, out)
    assert found.count() == found.where(F.col("ts_us") == HOUR).count() == found.select("url").distinct().count() == 3001


def test_sights_between_the_watermark_and_the_end_of_its_slot(spark, folder):
    # When the first sight of "a" is settled, its retention has passed, but not that of the sight which still waits.
    for batch in ([("a", 1), ("a", 25), ("z", 30.5)], [("z", 31)], [("end", 90)], [("end", 90)]):
        feed(spark, f"{folder}/in", SIGHTS, [(u, int(h * HOUR)) for u, h in batch])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(first_seen.stream_first_seen(stream(spark, f"{folder}/in", SIGHTS), out, state, 1.0, 4 * 3600))
    assert first_seen.sights_held(spark, state).count() == 0
    first_seen.release_sights(spark, out, state, 1.0)
    assert sorted((r.url, r.ts_us // HOUR) for r in first_seen.first_sights(spark, out).collect()) == [("a", 1), ("end", 90), ("z", 30)]


CRAWLS = "ts timestamp, url string, pdf_count long"


def test_page_upserts_over_batches_and_compaction(spark, folder):
    feed(spark, f"{folder}/in", CRAWLS, [(START, "a", 1), (START + MINUTE, "a", 2), (START, "b", 5)])
    feed(spark, f"{folder}/in", CRAWLS, [(START + 2 * MINUTE, "a", 9), (START + MINUTE, "c", 0)])
    finish(upserts.stream_upserts(stream(spark, f"{folder}/in", CRAWLS), "pages", f"{folder}/state", f"{folder}/ck"))

    def state():
        rows = upserts.streamed_state(spark, "pages", f"{folder}/state")
        return {r.url: (r.us, r.pdf_count, r.crawl_count) for r in rows.select("*", F.unix_micros("last_crawled").alias("us")).collect()}

    at = lambda minutes: int((START + minutes * MINUTE).timestamp()) * 1_000_000
    expected = {"a": (at(2), 9, 3), "b": (at(0), 5, 1), "c": (at(1), 0, 1)}
    assert state() == expected
    upserts.compact(spark, "pages", f"{folder}/state", 0)
    assert state() == expected
    upserts.compact(spark, "pages", f"{folder}/state", 1)
    assert state() == expected
    # Of two versions the older one still needs the second delta, but not the first.
    assert sources_state.children(spark, f"{folder}/state/delta") == ["batch_id=1"]
    upserts.compact(spark, "pages", f"{folder}/state", 0)
    upserts.prune(spark, f"{folder}/state", 1)
    assert state() == expected and sources_state.children(spark, f"{folder}/state/delta") == []


def test_a_delta_without_success_mark_does_not_count(spark, folder):
    feed(spark, f"{folder}/in", CRAWLS, [(START, "a", 1)])
    feed(spark, f"{folder}/in", CRAWLS, [(START + MINUTE, "a", 2)])
    finish(upserts.stream_upserts(stream(spark, f"{folder}/in", CRAWLS), "pages", f"{folder}/state", f"{folder}/ck"))
    sources_state.remove(spark, f"{folder}/state/delta/batch_id=1/_SUCCESS")
    assert [(r.pdf_count, r.crawl_count) for r in upserts.streamed_state(spark, "pages", f"{folder}/state").collect()] == [(1, 1)]


def test_document_deltas_equal_the_batch_upsert(spark, folder):
    seen = "ts timestamp, url string, source_page string"
    feed(spark, f"{folder}/in", seen, [(START, "a", "p"), (START, "b", "p")])
    feed(spark, f"{folder}/in", seen, [(START + MINUTE, "a", "q"), (START + MINUTE, "c", "q")])
    finish(upserts.stream_upserts(stream(spark, f"{folder}/in", seen), "documents", f"{folder}/state", f"{folder}/ck"))
    streamed = upserts.streamed_state(spark, "documents", f"{folder}/state")
    shape = lambda **c: spark.createDataFrame([(u, s) for u, s in c.items()], "url string, source_page string")
    empty = spark.createDataFrame([], schemas.DOC_CACHE)
    once = incremental.upsert_documents(empty, shape(a="p", b="p"), START)
    twice = incremental.upsert_documents(once, shape(a="q", c="q"), START + MINUTE)
    assert streamed.select(*twice.columns).exceptAll(twice).count() == 0 and twice.count() == streamed.count() == 3


REQUESTS = "url string, domain string, ts_us long"


SPREAD = [(str(i), f"d{i % 4}", (i * 7919) % 150 * pacing.SECOND // 3) for i in range(120)]


@pytest.mark.parametrize("batches, slot", [(1, 60), (2, 1), (5, 7)])
def test_gaps_do_not_depend_on_the_borders_of_batches(spark, folder, batches, slot):
    order = sorted(SPREAD, key=lambda r: r[2] + (40 * pacing.SECOND if int(r[0]) % 4 == 0 else 0))
    size = -(-len(order) // batches)
    for start in range(0, len(order), size):
        feed(spark, f"{folder}/in", REQUESTS, order[start : start + size])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(gaps.stream_gap_violations(stream(spark, f"{folder}/in", REQUESTS), out, state, 1.0, 60, slot_seconds=slot))
    gaps.release_pending(spark, out, state)
    found = {(r.url, r.gap_us) for r in gaps.violations(spark, out).collect()}
    assert found == {(r.url, r.gap_us) for r in pacing.gap_violations(spark.createDataFrame(SPREAD, REQUESTS), 1.0).collect()}
    assert len(found) > 10 and gaps.late_requests(spark, out).count() == 0


def test_late_requests_are_kept_apart(spark, folder):
    second = pacing.SECOND
    feed(spark, f"{folder}/in", REQUESTS, [("1", "a", 0), ("2", "a", 100 * second)])
    feed(spark, f"{folder}/in", REQUESTS, [("3", "a", 50 * second), ("4", "a", 95 * second), ("5", "a", None), ("6", None, 94 * second)])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(gaps.stream_gap_violations(stream(spark, f"{folder}/in", REQUESTS), out, state, 10.0, 20))
    assert {r.url for r in gaps.late_requests(spark, out).collect()} == {"3", "5"}
    gaps.release_pending(spark, out, state, 10.0)
    assert {(r.url, r.gap_us) for r in gaps.violations(spark, out).collect()} == {("2", 5 * second)}


def test_slots_are_cleared_once_the_watermark_has_passed(spark, folder):
    second = pacing.SECOND
    for start in (0, 1000, 2000):
        feed(spark, f"{folder}/in", REQUESTS, [(f"{start}-{i}", "busy", start * second + i * second // 2) for i in range(40)])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(gaps.stream_gap_violations(stream(spark, f"{folder}/in", REQUESTS), out, state, 1.0, 5, slot_seconds=2))
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(state)
    # Of 120 requests those of the last seconds wait, and their domain has several keys.
    assert 0 < waiting.where("list_element.own").count() < 20 and waiting.select("key").distinct().count() > 1
    gaps.release_pending(spark, out, state)
    assert gaps.violations(spark, out).count() == 3 * 39


def test_a_key_of_the_gap_audit_has_many_domains(spark, folder):
    second = pacing.SECOND
    feed(spark, f"{folder}/in", REQUESTS, [(f"{d}/{i}", f"d{d}", i * second // 2) for d in range(700) for i in range(3)] + [("x", None, 0), ("y", None, 1)])
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(gaps.stream_gap_violations(stream(spark, f"{folder}/in", REQUESTS), out, state, 1.0, 60))
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(state)
    # One key per domain would be 701.
    assert waiting.select("key").distinct().count() <= gaps.BUCKETS
    gaps.release_pending(spark, out, state)
    found = gaps.violations(spark, out)
    assert found.count() == 2 * 700 + 1 and [r.url for r in found.where("domain is null").collect()] == ["y"]


def test_a_slot_of_more_requests_than_an_element_holds(spark, folder):
    second = pacing.SECOND
    rows = [(str(i), "busy", i * second // 100) for i in range(2 * gaps.PACK + 500)]
    for batch in (rows, [("end", "other", 1000 * second)], [("end", "other", 1001 * second)]):
        feed(spark, f"{folder}/in", REQUESTS, batch)
    out, state = f"{folder}/out", f"{folder}/ck"
    finish(gaps.stream_gap_violations(stream(spark, f"{folder}/in", REQUESTS), out, state, 1.0, 5))
    gaps.release_pending(spark, out, state)
    assert gaps.violations(spark, out).where("domain = 'busy'").count() == len(rows) - 1
