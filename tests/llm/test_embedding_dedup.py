import math

import numpy as np
import pytest

from crawlspark.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.93):
    usable = {}
    for k, (vec_id, e, label) in enumerate(rows):
        if vec_id is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e):
            v = np.array(e, dtype=np.float32).astype(float)
            usable[k] = (label, v / np.linalg.norm(v))
    near = {k: set() for k in range(len(rows))}
    for i, (a, x) in usable.items():
        for j, (b, y) in usable.items():
            if i < j and a == b and len(x) == len(y) and x @ y >= threshold:
                near[i].add(j)
                near[j].add(i)
    out = []
    for k, (vec_id, _, _) in enumerate(rows):
        seen, waiting = {k}, [k]
        while waiting:
            for j in near[waiting.pop()] - seen:
                seen.add(j)
                waiting.append(j)
        root = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near[k]), root, vec_id is None or vec_id == root))
    return sorted(out, key=str)


def vectors(n=400, dim=24, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((n // 8, dim))
    rows = []
    for i in range(n):
        x = centres[i % len(centres)] + draw.standard_normal(dim) * draw.choice([0.05, 0.2, 0.3])
        rows.append((i, [float(v) for v in np.float32(x)], int(i % len(centres)) % 3))
    return rows


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_same_links_as_comparing_everything(spark, block_rows):
    rows = vectors()
    got = ed.near_duplicates(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(rows)


def test_odd_rows(spark):
    e = [1.0, 2.0, 3.0]
    rows = [
        (1, e, 0), (1, e, 0), (2, [2.0, 4.0, 6.0], 0), (3, e, 1), (4, e, None), (5, None, 0), (6, [], 0),
        (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 3.0], 0), (9, [1.0, float("nan"), 3.0], 0),
        (10, [1.0, float("inf"), 3.0], 0), (None, e, 0), (11, [1.0, 2.0], 0), (12, [-1.0, -2.0, -3.0], 0),
        (13, [1e-30, 2e-30, 3e-30], 0), (14, [1e30, 2e30, 3e30], 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "2 as part", "3 as node", "4 as kept")
    got = sorted(map(tuple, ed.near_duplicates(docs).collect()), key=str)
    assert got == brute_force(rows)
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_are_those_of_the_windows():
    draw = np.random.default_rng(3)
    a, b = draw.standard_normal((70, 9)), draw.standard_normal((130, 9))
    a[5], b[7] = 0.25, 0.25
    expected = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.5).sum(axis=2)
    assert (ed.collision_counts(a, b, 0.5) == expected).all()


def test_the_count_is_calibrated_to_the_recall():
    chance = ed.within(1.5, 1.0)
    needed = ed.collisions_needed(24, chance, 0.9995)
    draw = np.random.default_rng(5)
    counts = (np.abs(draw.standard_normal((200_000, 24))) <= 1.5).sum(axis=1)
    assert (counts >= needed).mean() >= 0.9993
    assert (counts >= needed + 1).mean() < 0.9995
