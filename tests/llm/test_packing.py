import random
from collections import defaultdict

import pytest

from crawlspark.llm import packing

SIZES = (8, 16, 32)


def cost(size):
    return size * (1 + size / 64) + 2


def brute_force(lengths, least):
    """Best fit by looking at every open bin; of the same rule for the size to open."""
    bins, placed = [], []
    for length in lengths:
        fitting = [i for i, (size, held) in enumerate(bins) if size - sum(held) >= length]
        if fitting:
            i = min(fitting, key=lambda i: (bins[i][0] - sum(bins[i][1]), 0))
        else:
            def per_token(s):
                gap = s - length
                return cost(s) / (length + min(gap, sum(x for x in lengths if x <= min(gap, length)))), s

            bins.append((min((s for s in SIZES if s >= max(length, least)), key=per_token), []))
            i = len(bins) - 1
        bins[i][1].append(length)
        placed.append(i)
    return sorted(tuple(sorted(held)) for _, held in bins)


@pytest.mark.parametrize("seed", range(6))
def test_packs_as_the_plain_algorithm_does(seed):
    draw = random.Random(seed)
    lengths = sorted((draw.randint(1, 32) for _ in range(draw.choice([1, 7, 60, 200]))), reverse=True)
    for least in SIZES:
        bins, offsets, _ = packing._packed(lengths, list(SIZES), cost, least)
        held = defaultdict(list)
        for b, length in zip(bins, lengths, strict=True):
            held[b].append(length)
        assert len(held) == len(brute_force(lengths, least))
        assert sum(map(sum, held.values())) == sum(lengths)
    bins, offsets, sizes = packing.pack(lengths, SIZES, cost)
    costs = [sum(cost(s) for s in packing._packed(lengths, list(SIZES), cost, least)[2]) for least in SIZES]
    assert sum(map(cost, sizes)) == min(costs)
    filled = defaultdict(int)
    for b, offset, length in zip(bins, offsets, lengths, strict=True):
        assert offset == filled[b]
        filled[b] += length
    # No bin is larger than its contents need.
    assert all(size == min(s for s in SIZES if s >= filled[b]) for b, size in enumerate(sizes))


def test_a_small_bin_is_opened_where_nothing_else_could_fill_a_large_one():
    assert packing.pack([5], SIZES, cost)[2] == [8]
    assert packing.pack([], SIZES, cost) == ([], [], [])
    assert packing.pack([32, 32], SIZES, cost)[2] == [32, 32]


def check(rows, lengths, sizes):
    """Every word of every row is in one piece, and no bin holds more than its size or overlaps."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        if r.n_tokens:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.bin_size is None and r.bin_offset is None
    assert pieces.keys() == lengths.keys()
    for doc_id, expected in lengths.items():
        assert sorted(n for n in [sum(p.n_tokens for p in pieces[doc_id])]) == [sum(expected)]
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        size = {r.bin_size for r in held}
        at = 0
        for r in held:
            assert r.bin_offset == at
            at += r.n_tokens
        assert len(size) == 1 and at <= min(size) and min(size) == min(s for s in sizes if s >= at)


def test_documents_over_many_runs(documents):
    draw = random.Random(3)
    counts = {i: draw.choice([0, 1, 3, 9, 31, 32, 33, 64, 100]) for i in range(400)}
    docs = documents([(i, "w " * n) for i, n in counts.items()])
    for run_rows in (7, 20_000):
        rows = packing.packed_documents(docs, SIZES, run_rows).collect()
        check(rows, {i: [n] for i, n in counts.items()}, SIZES)
        starts = sorted((r.piece, r.start, r.n_tokens) for r in rows if r.doc_id == max(i for i, n in counts.items() if n == 100))
        assert starts == [(0, 0, 32), (1, 32, 32), (2, 64, 32), (3, 96, 4)]


def test_odd_rows(documents):
    docs = documents([(1, None), (2, ""), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (2**60 + 1, "y " * 100_000)])
    rows = packing.packed_documents(docs.selectExpr("*", "1 as piece", "2 as bin_id", "3 as total", "4 as deal")).collect()
    check(rows, {1: [0], 2: [0, 0], 3: [2, 2], None: [1], 2**60 + 1: [100_000]}, packing.CAPACITIES)
    assert packing.packed_documents(documents([])).count() == 0
