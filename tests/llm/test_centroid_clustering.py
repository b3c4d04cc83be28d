"""Clusters from subvector dictionaries against plain rounds."""

import hashlib
import math

import numpy as np
import pytest

from crawlspark.llm import centroid_clustering

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, ids string"


def plain(rows, k, rounds, dim, scale=64, seed=1):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dim and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector]))

    def drawn(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [v for _, v in sorted(kept, key=drawn)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    last = [(i, *nearest(v)) for i, v in kept]
    sums = {}
    for _, d, n in last:
        sums[n] = sums.get(n, 0) + d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sums[n], sum(sums.values()), shas[n]) for i, d, n in last), key=repr)


def found(spark, rows, **options):
    vectors = spark.createDataFrame([(i, v, 0, 7, "x") for i, v in rows], SCHEMA).repartition(3)
    answer = centroid_clustering.centroid_clusters(vectors, **options).drop("centroid")
    return sorted((tuple(r) for r in answer.collect()), key=repr)


def vectors(n, dim, seed=0):
    draw = np.random.default_rng(seed)
    return [(i, (draw.normal(size=dim) + 3 * (i % 4)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("chunk", [7, 1 << 14])
def test_against_plain_rounds(spark, chunk, monkeypatch):
    monkeypatch.setattr(centroid_clustering, "CHUNK", chunk)
    rows = vectors(120, 6)
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, rows[6][1]), (900, None), (901, [1.0] * 5), (902, [1.0] * 5 + [None])]
    rows += [(903, [float("nan")] + [0.0] * 5), (904, [float("-inf")] + [0.0] * 5), (905, [0.0] * 6), (906, [1e6] * 6), (907, [-1e6] * 6)]
    for k, rounds in ((5, 3), (16, 1), (3, 0)):
        assert found(spark, rows, k=k, rounds=rounds, dim=6) == plain(rows, k, rounds, 6)


def test_few_vectors_and_ties(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0])]
    assert found(spark, rows, k=16, rounds=3, dim=2) == plain(rows, 16, 3, 2)
    assert found(spark, [(1, None)], dim=2) == [] and found(spark, [], dim=2) == []


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="distances would not be exact"):
        found(spark, [(1, [1e30, 0.0])], dim=2)


def test_dictionaries_are_lossless():
    draw = np.random.default_rng(2)
    for spread in (3, 2**60):
        block = draw.integers(-spread, spread, (500, 2))
        book, codes = centroid_clustering._dictionary(block)
        assert (book[codes.ravel()] == block).all() and len(np.unique(book, axis=0)) == len(book)
