import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from crawlspark.llm import mixing

WEIGHTS = {"domain": {"d0": 3, "d1": 1}, "lang": {"xx": 2, "none": 0}, "source": {"s1": 5}}
DOMAIN = "concat('d', length(source) % 2)"


def fill(children, budget):
    """Exact shares by raising one level until the budget is spent; (name, weight, capacity)."""
    open_now = {n: (w, c) for n, w, c in children}
    given = {}
    while open_now:
        weight = sum(w for w, _ in open_now.values())
        full = [n for n, (w, c) in open_now.items() if Fraction(budget * w, weight) >= c]
        if not full:
            return given | {n: Fraction(budget * w, weight) for n, (w, _) in open_now.items()}
        for n in full:
            given[n] = open_now.pop(n)[1]
            budget -= given[n]
    return given


def brute_force(supply, permille, epochs):
    """Exact budgets of the leaves, from the top down."""

    def weight(level, name):
        return WEIGHTS[level].get(name, 1)

    total = sum(supply.values()) * permille // 1000
    usable = {
        k: v for k, v in supply.items() if v and all(weight(lv, n) for lv, n in zip(mixing.LEVELS, k, strict=True))
    }
    budgets = {(): total}
    for depth, level in enumerate(mixing.LEVELS):
        children = defaultdict(lambda: defaultdict(int))
        for k, v in usable.items():
            children[k[:depth]][k[depth]] += v * epochs
        budgets = {
            (*parent, name): share
            for parent, nodes in children.items()
            for name, share in fill([(n, weight(level, n), c) for n, c in nodes.items()], budgets[parent]).items()
        }
    return budgets


def sample(n=120, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        source = draw.choice(["s1", "s2", "s33", "s44", "s1", "s1"])
        text = " ".join("w" for _ in range(draw.randint(0, 30)))
        rows.append((i, text, draw.choice(["xx", "yy", "none", None]), source))
    return rows


@pytest.mark.parametrize(("permille", "epochs"), [(1000, 4), (400, 1), (3000, 2), (9000, 3), (0, 2)])
def test_budgets_and_streams(documents, permille, epochs):
    rows = mixing.described(documents(sample()), DOMAIN)
    leaves = mixing.quotas(rows, WEIGHTS, permille, epochs)
    got = {tuple(r[lv] for lv in mixing.LEVELS): r for r in leaves.collect()}
    supply = defaultdict(int)
    for r in rows.collect():
        supply[r.domain, r.lang, r.source] += r.n_tokens
    expected = brute_force(supply, permille, epochs)
    assert got.keys() == expected.keys()
    for key, row in got.items():
        # Whole tokens: a share is rounded at each of three levels.
        assert abs(row.quota - expected[key]) < 3
        assert row.quota <= supply[key] * epochs
    most = sum(v * epochs for k, v in supply.items() if k in expected)
    assert sum(r.quota for r in got.values()) == min(sum(supply.values()) * permille // 1000, most)

    taken = mixing.selected(rows, mixing.cuts(rows, leaves, seed=3), seed=3).collect()
    by_leaf = defaultdict(list)
    for r in taken:
        by_leaf[r.domain, r.lang, r.source].append(r)
    for key, row in got.items():
        docs = {r.doc_id: r.n_tokens for r in rows.collect() if (r.domain, r.lang, r.source) == key and r.n_tokens}
        whole, rest = divmod(row.quota, supply[key])
        order = sorted(docs, key=lambda i: hashlib.md5(f"3:{whole + 1}:{i}".encode()).hexdigest()[:15])
        stream = [(e, i, n) for e in range(1, whole + 1) for i, n in docs.items()]
        for i in order:
            if rest <= 0:
                break
            stream.append((whole + 1, i, min(rest, docs[i])))
            rest -= docs[i]
        assert sorted((r.epoch, r.doc_id, r.take_tokens) for r in by_leaf[key]) == sorted(stream)


def test_shortages_go_to_siblings_before_ancestors(documents):
    # Of domain d0 (sources of even length) one source is tiny: its sibling gets the rest, not d1.
    rows = [(1, "a " * 10, "xx", "s1"), (2, "a " * 1000, "xx", "s2"), (3, "a " * 1000, "xx", "s33")]
    described = mixing.described(documents(rows), DOMAIN)
    leaves = {r.source: r.quota for r in mixing.quotas(described, {"domain": {"d0": 1, "d1": 1}}, 400, 1).collect()}
    assert leaves == {"s1": 10, "s2": 392, "s33": 402}


def test_repeated_ids_share_the_cut(documents):
    rows = mixing.described(documents([(7, "a b c d e f", "xx", "s1")] * 5), DOMAIN)
    leaves = mixing.quotas(rows, {}, 500, 1)
    taken = [r.take_tokens for r in mixing.selected(rows, mixing.cuts(rows, leaves)).collect()]
    assert taken == [3] * 5


def test_odd_rows(spark, documents):
    rows = [(1, None, "xx", "s1"), (2, "", None, None), (None, "a b", "xx", "s1"), (4, "x " * 100_000, None, None)]
    docs = documents(rows).selectExpr("*", "1 as rest", "2 as epoch", "3 as cut")
    described = mixing.described(docs, DOMAIN)
    taken = mixing.selected(described, mixing.cuts(described, mixing.quotas(described, {}))).collect()
    assert {(r.doc_id, r.domain, r.source) for r in taken} == {(None, "d0", "s1"), (4, "unknown", "unknown")}
    nothing = mixing.described(documents([]), DOMAIN)
    assert mixing.selected(nothing, mixing.cuts(nothing, mixing.quotas(nothing, WEIGHTS))).count() == 0


def test_first_tokens(spark):
    rows = [(" a  b\nc d ", 2), ("a b", 5), ("a", 1)]
    df = spark.createDataFrame(rows, "text string, take long")
    assert [r[0] for r in df.select(mixing.first_tokens("text", "take")).collect()] == [" a  b", "a b", "a"]


def test_no_python_in_the_plan(documents, capsys):
    rows = mixing.described(documents(sample()), DOMAIN)
    mixing.selected(rows, mixing.cuts(rows, mixing.quotas(rows, WEIGHTS))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
