"""State in buckets: what a run reads, writes and leaves."""

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators import incremental
from crawlspark.operators.incremental import url_hash
from crawlspark.sources import buckets, state

NOW = datetime(2025, 1, 1, tzinfo=timezone.utc)
LATER = datetime(2025, 1, 2, tzinfo=timezone.utc)


def seen(spark, *names):
    return spark.createDataFrame([(n, "p") for n in names], "url string, source_page string")


def merge(spark, path, names, now, **options):
    return buckets.merge_buckets(
        spark, path, schemas.DOC_CACHE, seen(spark, *names), lambda rows, new: incremental.upsert_documents(rows, new, now), **options
    )


def rows(df):
    return sorted((r.url, r.discovered_time, r.last_seen) for r in df.collect())


def test_merges_equal_the_whole_upsert(spark, folder):
    first, second = [f"u{i}" for i in range(200)], ["u3", "u7", "new"]
    assert merge(spark, folder, first, NOW) == 0 and merge(spark, folder, second, LATER) == 1
    whole = incremental.upsert_documents(spark.createDataFrame([], schemas.DOC_CACHE), seen(spark, *first), NOW)
    whole = incremental.upsert_documents(whole, seen(spark, *second), LATER)
    assert rows(buckets.load_buckets(spark, folder, schemas.DOC_CACHE)) == rows(whole)
    assert buckets.load_buckets(spark, folder, schemas.DOC_CACHE, version=0).count() == 200


def test_only_touched_buckets_are_read_and_written(spark, folder):
    merge(spark, folder, [f"u{i}" for i in range(300)], NOW)
    names = ["u3", "u7", "new"]
    touched = {r.b for r in seen(spark, *names).select(F.substring(url_hash(F.col("url")), 1, 2).alias("b")).collect()}
    read = []

    def watched(base, new):
        read.extend(base.inputFiles())
        return incremental.upsert_documents(base, new, LATER)

    buckets.merge_buckets(spark, folder, schemas.DOC_CACHE, seen(spark, *names), watched)
    assert {re.search("bucket=(..)", name).group(1) for name in read} <= touched
    assert {n.removeprefix("bucket=") for n in state.children(spark, f"{folder}/data/version=1") if "=" in n} == touched
    held = buckets.manifest(spark, folder)
    assert {b for b, v in held.items() if v == 1} == touched and len(held) > 100
    files = buckets.load_buckets(spark, folder, schemas.DOC_CACHE, only=touched).inputFiles()
    assert {re.search("bucket=(..)", name).group(1) for name in files} == touched


def test_a_repeated_version_starts_from_the_same_state(spark, folder):
    merge(spark, folder, ["a", "b"], NOW, version=0)
    for _ in range(2):
        merge(spark, folder, ["b", "c"], LATER, version=1)
    found = buckets.load_buckets(spark, folder, schemas.DOC_CACHE)
    assert sorted(r.url for r in found.collect()) == ["a", "b", "c"]


def test_a_run_without_manifest_does_not_count(spark, folder):
    merge(spark, folder, ["a"], NOW)
    merge(spark, folder, ["b"], LATER)
    state.remove(spark, f"{folder}/manifest/version=1/_SUCCESS")
    assert [r.url for r in buckets.load_buckets(spark, folder, schemas.DOC_CACHE).collect()] == ["a"]
    merge(spark, folder, ["c"], LATER)
    assert sorted(r.url for r in buckets.load_buckets(spark, folder, schemas.DOC_CACHE).collect()) == ["a", "c"]


def test_pruning_leaves_what_kept_versions_name(spark, folder):
    names = [f"u{i}" for i in range(60)]
    merge(spark, folder, names, NOW)
    for number in range(3):
        merge(spark, folder, [f"u{number}"], LATER)
    before = [rows(buckets.load_buckets(spark, folder, schemas.DOC_CACHE, version=v)) for v in (2, 3)]
    assert buckets.prune_buckets(spark, folder, keep=2) > 0
    assert state.versions(spark, f"{folder}/manifest") == [2, 3]
    assert [rows(buckets.load_buckets(spark, folder, schemas.DOC_CACHE, version=v)) for v in (2, 3)] == before
    assert buckets.prune_buckets(spark, folder, keep=1) > 0 and buckets.prune_buckets(spark, folder, keep=1) == 0
    live = buckets.live_folders(spark, folder)
    on_disk = {
        (int(v.removeprefix("version=")), b.removeprefix("bucket="))
        for v in state.children(spark, f"{folder}/data") if v.startswith("version=")
        for b in state.children(spark, f"{folder}/data/{v}") if b.startswith("bucket=")
    }
    assert on_disk == live and rows(buckets.load_buckets(spark, folder, schemas.DOC_CACHE)) == before[1]
    with pytest.raises(ValueError):
        buckets.prune_buckets(spark, folder, keep=0)


def test_nothing_to_merge(spark, folder):
    assert merge(spark, folder, [], NOW) == 0
    assert buckets.load_buckets(spark, folder, schemas.DOC_CACHE).count() == 0
    merge(spark, folder, ["a"], NOW)
    merge(spark, folder, [], LATER)
    assert [r.url for r in buckets.load_buckets(spark, folder, schemas.DOC_CACHE).collect()] == ["a"]


def test_old_versions_of_a_whole_state_go(spark, folder):
    for number in range(4):
        state.save_state(spark.range(number).select(F.col("id")), folder)
    state.remove(spark, f"{folder}/version=1/_SUCCESS")
    assert state.prune_versions(spark, folder, 2) == [0, 1]
    assert state.versions(spark, folder) == [2, 3] and state.children(spark, folder) == ["version=2", "version=3"]
