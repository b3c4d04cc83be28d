import random

import numpy as np
import pytest
from llm_helpers import prose

from crawlspark.llm import cotraining as ct

LABELS = "doc_id long, quality int, toxic int"


def sample(n, seed, known=0.3):
    """Good and bad documents; the text and the source tell, each for itself."""
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = draw.random() < 0.6
        words = prose(seed * 10_000 + i, 60).split()
        if not good:
            words = [w + draw.choice(["###", "%%%", "", ""]) for w in words]
        source = f"s{draw.randint(0, 4)}" if good == (draw.random() < 0.95) else f"t{draw.randint(0, 4)}"
        rows.append((i, " ".join(words), "xx", source))
        labels.append((i, int(good), 0))
    return rows, labels, [r for r in labels if draw.random() < known]


def test_held_out_documents_and_the_gain_of_the_rounds(spark, documents):
    rows, truth, some = sample(900, 1, known=0.12)
    docs = documents(rows)
    table = ct.featured(docs, spark.createDataFrame(some, LABELS))
    known = {r[0] for r in some}
    accuracy = []
    for rounds in (1, 3):
        got = {r.doc_id: r for r in ct.score(table, ct.fit(table, rounds=rounds, confidence=0.9)).collect()}
        assert len(got) == len(rows)
        unseen = [(got[i].predicted, q) for i, q, _ in truth if i not in known]
        accuracy.append(np.mean([a == b for a, b in unseen]))
    assert accuracy[1] > 0.95 and accuracy[1] >= accuracy[0] - 0.01
    right_text = np.mean([(got[i].text_score >= 0.5) == q for i, q, _ in truth])
    right_meta = np.mean([(got[i].meta_score >= 0.5) == q for i, q, _ in truth])
    assert right_text > 0.9 and right_meta > 0.85


def test_views_see_different_things():
    same = [ct.meta_features("ab cd", lang, "s", 5) for lang in ("xx", "yy")]
    assert (same[0] != same[1]).sum() == 1
    assert [len(f) for f in ct.text_features(["", "ab", "abcabc", "é"])] == [0, 0, 3, 0]


def test_a_confident_view_teaches_the_other(spark, documents):
    rows, truth, some = sample(600, 2, known=0.2)
    table = ct.featured(documents(rows), spark.createDataFrame(some, LABELS))
    alone = ct._fitted(table, None, 0.9, 1.0)
    taught = ct._fitted(table, alone, 0.9, 1.0)
    # More features are beyond chance once the other view's documents are counted too.
    assert (taught.text.odds != 0).sum() > (alone.text.odds != 0).sum()


def test_odd_rows(spark, documents):
    rows, _, labels = sample(200, 3, known=1.0)
    odd = [(1000, None), (1001, ""), (None, "no id"), (1002, prose(1, 60_000)), (1003, "same"), (1003, "same")]
    more = [(1001, 1, None), (None, 1, 0), (1003, None, 0), (0, 0, 0), (0, 1, 0), (7777, 1, 0)]
    docs = documents(rows + odd).selectExpr("*", "1 as label", "'x' as part", "2 as text_f", "3 as score")
    table = ct.featured(docs, spark.createDataFrame(labels + more, LABELS))
    got = ct.score(table, ct.fit(table)).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id == 1003}) == 1


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_without_labels_of_both_classes(spark, documents, labels):
    table = ct.featured(documents([(1, "a text"), (2, "b text"), (3, None)]), spark.createDataFrame(labels, LABELS))
    assert {r.score for r in ct.score(table, ct.fit(table)).collect()} == {0.5}
    empty = ct.featured(documents([]), spark.createDataFrame(labels, LABELS))
    assert ct.score(empty, ct.fit(empty)).count() == 0
