import hashlib
import random

import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage_dealt
from crawlspark.llm import paragraph_sketch as ps

PAIR = "id long, a array<long>, b array<long>"


def edits(rows):
    """(doc_id, text, edited text, next text) in descending order."""
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = []
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        third = len(text) // 3
        out.append((doc_id, text, text[: len(text) - third] + following[:third], following))
    return out


def paragraphs(text):
    import re

    return {p for p in re.split(r"\n+|(?<=[.!?]) +", text) if p}


def test_recovers_every_difference_at_any_size(spark):
    draw = random.Random(2)
    rows = []
    for i in range(120):
        common = [draw.getrandbits(62) for _ in range(draw.choice([0, 1, 5, 200]))]
        a = [draw.getrandbits(62) for _ in range(draw.choice([0, 1, 2, 8, 60]))]
        b = [-draw.getrandbits(62) for _ in range(draw.choice([0, 1, 3, 9, 700]))]
        rows.append((i, common + a, common + b, len(a) + len(b)))
    pairs = spark.createDataFrame([r[:3] for r in rows], PAIR)
    got = {r.id: r.differing for r in ps.compared(pairs, ["id"]).collect()}
    assert got == {r[0]: r[3] for r in rows}


def signed(spark, a, b, parts=1):
    rows = [(1, a, 1, parts), (1, b, -1, parts)]
    return spark.createDataFrame(rows, "id long, digests array<long>, sign int, parts long").coalesce(1)


def test_a_sketch_that_is_too_small_fails_and_a_larger_one_is_tried(spark):
    a, b = list(range(1, 6)), list(range(1000, 1100))
    for width, left in ((16, True), (256, False)):
        part = ps.peeled(ps.sketched(signed(spark, a, b), ["id"], width), ["id"], width).first()
        assert part.left is left
    assert sorted(part.found) == sorted(a + b)
    # Twenty digests agree on their lowest bits, so one part gets them all.
    crowded = [(7, [64 * i for i in range(20)], [64 * i + 1 for i in range(400)])]
    assert ps.compared(spark.createDataFrame(crowded, PAIR), ["id"]).first().differing == 420


def test_sketches_subtract_and_fold(spark):
    found = ps.peeled(ps.sketched(signed(spark, [1, 2, 3], [2, 3, 4], 4), ["id"]), ["id"]).collect()
    assert sorted(k for r in found for k in r.found) == [1, 4] and not any(r.left for r in found)
    keys, order = list(range(100, 160)), ["part", "slot", "n", "key", "check"]
    fine = ps.sketched(signed(spark, keys, [], 8), ["id"])
    folded = fine.selectExpr("id", "part % 2 as part", "slot", "n", "key", "check").groupBy("id", "part", "slot").agg(
        F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check")
    )
    coarse = ps.sketched(signed(spark, keys, [], 2), ["id"])
    assert sorted(folded.select(*order).collect()) == sorted(coarse.select(*order).collect())


def sample():
    rows = [(i * 3, "\n".join(prose(i * 50 + k, 8) for k in range(1 + i % 9))) for i in range(40)]
    return rows + [(500, rows[3][1]), (501, rows[3][1]), (600, "ab"), (601, "x"), (602, "é中🙂" * 50)]


@pytest.mark.parametrize("odd", [[], [(2, None), (1, ""), (700, prose(1, 20_000).replace("a", ".\n"))]])
def test_fingerprints_and_likeness(documents, odd):
    rows = sample() + odd
    docs = documents(rows).selectExpr("*", "1 as node", "'x' as fingerprint")
    got = {r.doc_id: r for r in ps.document_sketches(docs).collect()}
    expected = edits(rows)
    assert len(got) == len(expected)
    by_text = {}
    for doc_id, text, edited, following in expected:
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        by_text.setdefault(text, set()).add(r.fingerprint)
        by_text.setdefault(edited, set()).add(r.edited_fingerprint)
        for likeness, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = paragraphs(text), paragraphs(other)
            total = len(a) + len(b)
            assert likeness == pytest.approx(1.0 if not total else 2 * len(a & b) / total)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert len({next(iter(p)) for p in by_text.values()}) == len(by_text)


def test_repeated_and_unnamed_rows(documents):
    rows = [(5, "one.\ntwo."), (5, "one.\ntwo."), (5, "other"), (None, "no id. at all."), (9, "top text here")]
    got = ps.document_sketches(documents(rows)).collect()
    assert len(got) == 5
    assert len({(r.fingerprint, r.edited_sha256) for r in got if r.doc_id == 5 and r.n_chars == 9}) == 1
    # A NULL id comes last in descending order, so the first document follows it.
    last = next(r for r in got if r.doc_id is None)
    assert last.edited_sha256 == hashlib.sha256(b"no id. at top ").hexdigest()


def test_few_documents(documents):
    assert ps.document_sketches(documents([])).count() == 0
    only = ps.document_sketches(documents([(1, "abc def")])).first()
    # After the last comes the first: the document itself.
    assert only.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest() and only.near_next == 1.0


def test_no_python_in_the_plan(documents, capsys):
    ps.document_sketches(documents(sample())).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_only_digests_of_failed_parts_are_dealt_out_again(spark, monkeypatch):
    written = []
    cut = ps.cut_lineage
    monkeypatch.setattr(ps, "cut_lineage", lambda df, label: written.append(cut(df, label)) or written[-1])
    draw = random.Random(5)
    easy = [draw.getrandbits(62) for _ in range(400)]
    crowded = [64 * i for i in range(20)], [64 * i + 1 for i in range(400)]
    pairs = spark.createDataFrame([(1, easy, [*easy, 7]), (7, *crowded), (8, easy, easy)], PAIR)
    got = {r.id: r.differing for r in ps.compared(pairs, ["id"]).collect()}
    assert got == {1: 1, 7: 420, 8: 0}
    first = {r.id: r for r in written[0].collect()}
    # The pair that was peeled keeps no digests, and the other one those of its failed parts.
    assert first[1].differing == 1 and first[1].a is None and first[1].b is None
    assert sorted(first[7].b) == crowded[1] and len(first[7].a) in (0, 20)


def test_cells_that_are_not_in_use_are_not_listed(spark, capsys):
    cells = ps.sketched(signed(spark, [1, 2, 3], [3]), ["id"], 1 << 20)
    found = ps.peeled(cells, ["id"], 1 << 20)
    found.explain()
    assert "1048575" not in capsys.readouterr().out
    part = found.first()
    assert sorted(part.found) == [1, 2] and part.left is False


def test_digests_are_not_dealt_out_again(spark, documents, monkeypatch):
    plans = {}
    cut = ps.cut_lineage

    def seen(df, label):
        plans.setdefault(label, df._jdf.queryExecution().toString())
        return cut(df, label)

    monkeypatch.setattr(ps, "cut_lineage", seen)
    # The joins of larger tables, which are not broadcast.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ps.document_sketches(documents(sample()))
        last = got._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plans["sketch-peeled"]
    # Nor for the fingerprints: only numbers by node are.
    assert "Exchange" in last and "REPARTITION_BY_NUM" not in last


def test_a_table_that_lies_by_a_key_keeps_its_rows_and_leaves_no_name(spark):
    rows = spark.range(1000).selectExpr("id % 300 as k", "id").repartition(8, "k")
    names = spark.catalog.listTables("default")
    dealt = cut_lineage_dealt(rows, "by-key", "k")
    assert spark.catalog.listTables("default") == names
    assert sorted(dealt.collect()) == sorted(rows.collect())
    counted = dealt.groupBy("k").count()
    assert "Exchange" not in counted._jdf.queryExecution().toString() and counted.count() == 300


def test_pairs_of_one_row_fail_apart(spark):
    crowded = [64 * i for i in range(20)], [64 * i + 1 for i in range(400)]
    rows = [(1, "edited", *crowded), (1, "next", [5, 6], [6]), (1, "same", [5], [5]), (2, "edited", [8], [])]
    pairs = spark.createDataFrame(rows, "node long, pair string, a array<long>, b array<long>").repartition(8, "node")
    expected = {(1, "edited"): 420, (1, "next"): 1, (1, "same"): 0, (2, "edited"): 1}
    for given, dealt in ((pairs, False), (cut_lineage_dealt(pairs, "pairs", "node"), True)):
        got = ps.compared(given, ["node", "pair"], dealt).collect()
        assert {(r.node, r.pair): r.differing for r in got} == expected and len(got) == len(expected)
