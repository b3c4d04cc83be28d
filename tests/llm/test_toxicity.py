import random

import pytest
from llm_helpers import prose

from crawlspark.llm import toxicity as tx


LABELS = "doc_id long, quality int, toxic int"
BAD = ["gruntle", "snorkfest", "blatherskite"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute_force(terms, word):
    near = [(distance(word, t), t) for t in terms]
    near = [(d, t) for d, t in near if d <= tx.edits_allowed(t)]
    return min(near)[::-1] if near else None


def test_the_automaton_finds_what_edit_distances_find():
    draw = random.Random(4)
    terms = sorted({"".join(draw.choice("abcd") for _ in range(draw.randint(3, 13))) for _ in range(60)})
    automaton = tx.LexiconAutomaton(terms)
    words = ["", "a", *terms]
    for _ in range(3000):
        word = list(draw.choice(terms))
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(word) + 1)
            word[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "b", "c", "d", "x"])
        words.append("".join(word))
    for word in words:
        assert automaton.match(word) == brute_force(terms, word), word


def test_the_automaton_may_forget_its_states(monkeypatch):
    monkeypatch.setattr(tx, "MOST_STATES", 5)
    automaton = tx.LexiconAutomaton(["gruntle", "gristle"])
    assert [automaton.match(w) for w in ("gruntle", "grintle", "gristl", "zzz")] == [
        ("gruntle", 0),
        ("gristle", 1),
        ("gristle", 1),
        None,
    ]


def marked(documents, spark, n=240, seed=0):
    rows, labels = [], []
    for i in range(n):
        words = prose(seed + i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for k in range(3):
                words.insert(7 * k + 3, BAD[(i // 4 + k) % 3])
        elif i % 8 == 1:
            # A clean text may quote a term.
            words[20:20] = ["they", "said", '"', BAD[i % 3], '"', "once"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return documents(rows), spark.createDataFrame(labels, LABELS), rows


@pytest.fixture(scope="module")
def model(spark, documents):
    docs, labels, _ = marked(documents, spark)
    return tx.fit(docs, labels)


def test_held_out_documents_misspellings_and_quotations(spark, documents, model):
    assert set(BAD) <= set(model.weights)
    docs, labels, _ = marked(documents, spark, seed=5000)
    rows = tx.score(docs, model).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.97
    spelled = documents([(1, prose(9, 30) + " gruntel snorkfets gruntle " + prose(10, 30) + " blatherskitte snorkfest")])
    assert tx.score(spelled, model).first().predicted == 1
    quoted = f'{prose(11, 30)} they said " gruntle " once {prose(12, 30)}'
    meant = f"{prose(11, 30)} gruntle snorkfest {prose(12, 30)} gruntle"
    scores = {r.doc_id: r.score for r in tx.score(documents([(1, quoted), (2, meant)]), model).collect()}
    assert scores[1] < 0.5 < scores[2]


def test_odd_rows(documents, model):
    long_text = prose(1, 40_000) + " gruntle snorkfest blatherskite"
    rows = documents([(1, None), (2, ""), (None, "gruntle gruntle snorkfest"), (4, long_text), (4, long_text)])
    got = tx.score(rows.selectExpr("*", "'x' as score", "'y' as predicted"), model)
    assert got.columns.count("score") == 1
    found = [(r.doc_id, r.score, r.predicted) for r in got.collect()]
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p in found)
    by_id = {i: s for i, s, _ in found}
    assert by_id[1] == by_id[2] < 0.5
    assert len({s for i, s, _ in found if i == 4}) == 1
    assert tx.score(documents([]), model).count() == 0


def test_labels_of_one_class_or_none(spark, documents):
    docs = documents([(1, "some text"), (2, "more text"), (None, "x"), (4, None)])
    none = tx.fit(docs, spark.createDataFrame([], LABELS))
    assert tx.score(docs, none).where("predicted = 1").count() == 0
    nulls = spark.createDataFrame([(None, 1, 1), (1, 1, None), (9, 1, 1)], LABELS)
    assert tx.score(docs, tx.fit(docs, nulls)).where("predicted = 1").count() == 0
    toxic = tx.fit(docs, spark.createDataFrame([(1, 1, 1), (2, 0, 1)], LABELS))
    assert tx.score(docs, toxic).where("predicted = 0").count() == 0
    assert tx.fit(documents([]), spark.createDataFrame([(1, 1, 1)], LABELS)).weights == {}
