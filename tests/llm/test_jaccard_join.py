import math
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_helpers import prose

from crawlspark.llm import jaccard_join as jj
from crawlspark.llm.components import connected, local_components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows, threshold=0.8):
    """(doc_id, class_id, n_links) by comparing every two rows."""
    sets = [shingles(t) for _, t in rows]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, waiting = {i}, [i]
        while waiting:
            for j in near[waiting.pop()] - seen:
                seen.add(j)
                waiting.append(j)
        out.append((doc_id, min((rows[j][0] for j in seen if rows[j][0] is not None), default=None), len(near[i])))
    return sorted(out, key=str)


def changed(text, seed, times):
    draw = random.Random(seed)
    words = text.split()
    for _ in range(times):
        words[draw.randrange(len(words))] = f"z{draw.randrange(10**6)}"
    return " ".join(words)


def corpus():
    passage = prose(77, 60)
    rows = [(i, prose(i, 40 + i % 50)) for i in range(60)]
    rows += [(100 + i, f"{prose(200 + i, 60)} {passage}") for i in range(60)]  # a passage that many share
    base = prose(900, 120)
    rows += [(300 + i, changed(base, i, 1 + i % 4)) for i in range(60)]  # near copies, some around the threshold
    rows += [(400 + i, rows[5][1]) for i in range(30)]  # copies
    rows += [(500 + i, changed(rows[i][1], i, 1)) for i in range(40)]
    rows += [(600, "a b c d"), (601, "a b c d"), (602, "a b c e"), (603, "A  B\nc d"), (604, None), (605, ""), (606, " \n")]
    return rows


@pytest.mark.parametrize("bucket_rows", [1024, 8])
def test_same_links_as_comparing_everything(documents, bucket_rows):
    rows = corpus()
    got = jj.similar_documents(documents(rows), bucket_rows=bucket_rows, block_tokens=2000 if bucket_rows == 8 else 1 << 20)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)


def test_repeated_ids_long_texts_and_columns_of_the_same_name(documents):
    long_text = prose(5, 30_000)
    rows = [(1, long_text), (1, long_text), (1, "another text of the same id here"), (2, changed(long_text, 1, 20))]
    rows += [(None, "a text without an id here"), (3, "a text without an id here"), (None, "alone without an id at all")]
    docs = documents(rows).selectExpr("*", "1 as digest", "2 as n", "3 as root", "4 as bucket", "5 as copies")
    got = sorted(map(tuple, jj.similar_documents(docs).collect()), key=str)
    assert got == brute_force(rows)
    assert jj.similar_documents(documents([])).count() == 0


def test_rows_without_an_id_have_their_links(documents):
    text = prose(11, 60)
    rows = [(1, text), (None, text), (None, changed(text, 1, 1)), (None, prose(12, 60)), (None, prose(12, 60)), (None, changed(prose(12, 60), 2, 1))]
    expected = brute_force(rows)
    assert {n for _, _, n in expected} == {2}
    assert sorted(map(tuple, jj.similar_documents(documents(rows)).collect()), key=str) == expected


def test_carried_columns_and_class_keys(documents):
    rows = [(1, prose(11, 60)), (None, prose(11, 60)), (2, prose(13, 60)), (3, "")]
    docs = documents(rows).withColumn("mark", F.concat(F.col("doc_id").cast("string"), F.lit("!")))
    found = jj.similar_documents(docs, carried=("mark",)).collect()
    keys = {(r.doc_id, r.mark): r.class_key for r in found}
    assert keys[1, "1!"] == keys[None, None] != keys[2, "2!"] and keys[3, "3!"] is None


@pytest.mark.parametrize("bucket_rows", [1024, 64])
def test_planted_pairs_at_the_threshold_are_found(documents, bucket_rows):
    """End to end: isolated pairs of a similarity of 0.80 to 0.82, a third of them around a shared passage."""
    passage, rows, pairs = prose(1, 12), [], 0
    for i in range(700):
        # One word of n - 4 shingles is replaced: 5 of them differ on either side.
        n = 49 + i % 6
        words = prose(5000 + i, n).split()
        if i % 3 == 0:
            words[:12] = passage.split()
        other = words.copy()
        other[n - 10 - i % 8] = f"z{i}"
        a, b = (shingles(" ".join(w)) for w in (words, other))
        if 0.80 <= len(a & b) / len(a | b) <= 0.83:
            rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
            pairs += 1
    found = {r.doc_id: r.class_id for r in jj.similar_documents(documents(rows), bucket_rows=bucket_rows).collect()}
    assert pairs > 300
    caught = sum(found[a] == found[b] for (a, _), (b, _) in zip(rows[::2], rows[1::2]))
    assert caught >= 0.9999 * pairs - 1


def test_recall_of_the_runs():
    """Chance that two sets at the threshold choose a common token in some run, over many pairs."""
    draw = np.random.default_rng(8)
    runs = jj.runs_for(0.8, 0.9999)
    seeds = jj.constants(runs, 53)
    missed = 0
    for _ in range(2000):
        common, own = draw.integers(0, 2**63, 80, dtype=np.uint64), draw.integers(0, 2**63, 20, dtype=np.uint64)
        small, large = common, np.concatenate([common, own])
        met = False
        for seed in seeds:
            chosen = [set(s[jj.mixed(s ^ seed) <= np.uint64(2**64 / (0.8 * len(s)))].tolist()) for s in (small, large)]
            met = met or bool(chosen[0] & chosen[1])
        missed += not met
    assert missed <= 3


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(5000, i) for i in range(5001, 5400)]
    a, b = np.array(links).T
    roots = local_components(6000, a, b)
    got = dict(map(tuple, connected(spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long")).collect()))
    ends = {x for x, y in links if x != y} | {y for x, y in links if x != y}
    assert got == {x: roots[x] for x in ends}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_hubs_and_chains(spark):
    """Hubs that are larger or smaller than their leaves, a shuffled chain, negative nodes, repeated links."""
    draw = random.Random(2)
    chain = draw.sample(range(-10_000, -9_000), 300)
    links = [(90_000, i) for i in range(20_000, 22_000)] + [(-5, i) for i in range(30_000, 32_000)]
    links += list(zip(chain, chain[1:])) + [(21_500, 31_500)] * 3 + [(40_000, 40_000)]
    found = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long")).collect()))
    hubs = {90_000, -5, *range(20_000, 22_000), *range(30_000, 32_000)}
    assert found == {x: -5 for x in hubs} | {x: min(chain) for x in chain}


@pytest.mark.parametrize("similarity", [0.8, 0.82])
def test_recall_of_the_sketches(similarity):
    """Chance that so similar a pair has too few equal sketch bytes to be proposed."""
    least, n = jj.equal_bytes_of(0.8), jj.SKETCH
    lost = sum(math.comb(n, k) * similarity**k * (1 - similarity) ** (n - k) for k in range(least))
    assert lost <= 1 - 0.9999


def test_large_buckets_are_split_as_often_as_recall_needs(documents, monkeypatch):
    class Stop(Exception):
        pass

    def described(docs, words, threshold, runs, deep_runs, carried):
        raise Stop(runs, deep_runs)

    monkeypatch.setattr(jj, "_described", described)
    with pytest.raises(Stop) as stopped:
        jj.similar_documents(documents([(1, "a")]))
    lost = [math.exp(-n) for n in stopped.value.args]
    assert sum(lost) <= 1 - 0.9999


def test_no_task_needs_two_python_workers_to_propose_links(documents, monkeypatch, capsys):
    plans = []

    def noted(links, *ends):
        links.explain()
        plans.append(capsys.readouterr().out)
        return connected(links, *ends)

    monkeypatch.setattr(jj, "connected", noted)
    text = prose(31, 60)
    rows = jj.similar_documents(documents([(1, text), (2, text + " zz"), (3, prose(32, 60))])).collect()
    assert {r.doc_id: r.class_id for r in rows} == {1: 1, 2: 1, 3: 3}
    # The forests of the links are a Python operator themselves.
    assert len(plans) == 2 and not any("MapInPandas" in p or "MapInArrow" in p or "ArrowEvalPython" in p for p in plans)


def test_shingles_of_many_texts_take_bounded_memory():
    texts = [prose(i, 400) for i in range(900)]
    tracemalloc.start()
    sets = jj.shingle_sets(texts)
    peak = tracemalloc.get_traced_memory()[1] - sum(s.nbytes for s in sets)
    tracemalloc.stop()
    # All of them at once take 50 MB.
    assert sum(map(len, texts)) > 1_500_000 and peak < 25_000_000
    assert all((s == jj.shingle_sets([t])[0]).all() for s, t in zip(sets, texts, strict=True))


def test_sets_of_the_members_are_computed_once(spark, capsys):
    text = prose(41, 30)
    digest = jj._digest(jj.shingle_sets([text])[0])
    kinds = "digest long, bucket long, copies long, blocks long, text string"
    members = spark.createDataFrame([(digest, 1, 1, 1, text), (digest + 1, 1, 1, 1, text)], kinds)
    found = jj._verified(members, 0.8, 5)
    found.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython [") == 1
    # The row whose text doesn't have its digest is left out.
    assert [r.digest for r in found.collect()] == [digest]
