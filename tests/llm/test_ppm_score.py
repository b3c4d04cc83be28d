import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from crawlspark.llm import ppm_score as ppm
from crawlspark.llm.words import HashTable, lowered, word_hashes



def train():
    return F.col("doc_id") % 5 != 1


def plain_model(texts, order):
    """Counts of what followed each context, byte by byte; contexts before a text are zeros."""
    counts = defaultdict(Counter)
    for text in texts:
        padded = bytes(order) + text
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[padded[i - k : i]][padded[i]] += 1
    return counts


def plain_log10(counts, text, order):
    """Prediction by partial matching with escape method D and exclusion, one byte after the other."""
    padded, total = bytes(order) + text, 0.0
    for i in range(order, len(padded)):
        symbol, excluded = padded[i], set()
        for k in range(order, -1, -1):
            seen = {s: n for s, n in counts.get(padded[i - k : i], {}).items() if s not in excluded}
            if not seen:
                continue
            whole = sum(seen.values())
            if symbol in seen:
                total += math.log10((seen[symbol] - 0.5) / whole)
                break
            total += math.log10(len(seen) / 2 / whole)
            excluded |= seen.keys()
        else:
            total += math.log10(1 / (256 - len(excluded)))
    return total


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_scores_are_those_of_the_plain_algorithm(documents, order):
    texts = [prose(i, 12, "abcé") for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(101, "qq xyz \U0001f642 ab"), (106, "a"), (111, "")]
    got = {r.doc_id: r.score for r in ppm.score(documents(rows), train(), order).collect()}
    counts = plain_model([lowered(t) for i, t in rows if i % 5 != 1], order)
    for doc_id, text in rows:
        assert got[doc_id] == pytest.approx(plain_log10(counts, lowered(text), order), abs=1e-9)


def test_probabilities_of_all_bytes_add_up_to_one():
    raw = [lowered(prose(i, 30)) for i in range(5)]
    keys, n = ppm._counted(ppm.grams(raw, 3)[0])
    trie = ppm.ByteTrie(keys, n, 3)
    for context in (b"\0\0\0", b"abc", b" ab", b"zzz", b"a z", raw[2][10:13]):
        packed = np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)], np.uint64)
        assert (10 ** trie.log10(packed)).sum() == pytest.approx(1.0)


def expected_base(rows, train):
    tokens = {i: [*lowered(t).split(), None] for i, t in rows}
    counts = Counter(w for i, t in tokens.items() if train(i) for w in t)
    total, vocabulary = sum(counts.values()), len(counts)
    return {
        i: (
            len(t),
            sum(w in counts for w in t),
            total,
            sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (vocabulary + 1))) for w in t),
        )
        for i, t in tokens.items()
    }


@pytest.mark.parametrize("head", [1 << 18, 5, 0])
def test_base_scores(documents, head, monkeypatch):
    monkeypatch.setattr(ppm, "MOST_KEYS", 40)
    rows = [(i, prose(i, 80, "abcdE\n")) for i in range(60)] + [(201, "new words only"), (206, None), (211, ""), (216, " \t")]
    got = ppm.score(documents(rows), train(), head_words=head).collect()
    expected = expected_base(rows, lambda i: i % 5 != 1)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3]
        assert r.base_score == pytest.approx(expected[r.doc_id][3])


def test_blocks_do_not_change_scores(documents, monkeypatch):
    rows = [(i, prose(i, 50)) for i in range(40)]
    docs = documents(rows).repartition(1)
    whole = sorted(map(tuple, ppm.score(docs, train()).collect()))
    monkeypatch.setattr(ppm, "BLOCK", 100)
    for a, b in zip(whole, sorted(map(tuple, ppm.score(docs, train()).collect())), strict=True):
        assert a == pytest.approx(b)


def test_odd_rows(documents):
    long_text = prose(3, 60_000)
    rows = [(1, None), (2, long_text), (2, long_text), (None, "no id"), (6, long_text), (5, "x")]
    docs = documents(rows).selectExpr("*", "1 as row", "2 as key", "3 as n", "'x' as train")
    got = ppm.score(docs, train()).collect()
    assert len(got) == 6 and sum(r.doc_id == 2 for r in got) == 2
    assert next(r for r in got if r.doc_id == 1).score == 0.0
    assert ppm.score(documents([]), train()).count() == 0
    untrained = ppm.score(documents([(1, "ab c")]), train()).first()
    assert (untrained.n_tokens, untrained.n_known, untrained.train_tokens, untrained.base_score) == (3, 0, 0, 0.0)
    assert untrained.score == pytest.approx(4 * math.log10(1 / 256))


def test_rare_grams_are_left_out_by_count(documents):
    docs = documents([(i, "abcabcabc" * 5 + prose(i, 4)) for i in range(20)])
    small, large = ppm.fit_trie(docs, 4, most_grams=20).trie(), ppm.fit_trie(docs, 4).trie()
    kept = [len(t.orders[-1].gram_n) for t in (small, large)]
    assert kept[0] <= 20 < kept[1]
    keys = ppm.grams([b"abcabcabc"], 4)[0]
    assert np.isfinite(small.log10(keys)).all()


def test_word_hashes_and_their_table():
    draw = random.Random(0)
    texts = [prose(i, draw.randint(0, 40), "aB \n\té") for i in range(80)] + ["", " ", "x" * 3000]
    raw = [lowered(t) for t in texts]
    hashes, at = word_hashes(raw)
    names = {}
    for k, r in enumerate(raw):
        words = r.split()
        assert at[k + 1] - at[k] == len(words)
        for word, h in zip(words, hashes[at[k] : at[k + 1]].tolist(), strict=True):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    keys = np.array(sorted(names.values()), np.uint64)
    table = HashTable.of(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == -1).all()
    assert (HashTable.of(keys[:0]).find(keys) == -1).all()


@pytest.mark.parametrize("order", [1, 3, 5])
@pytest.mark.parametrize("head", [1 << 20, 60, 0])
def test_scores_do_not_depend_on_the_size_of_the_head(documents, order, head):
    rows = [(i, prose(i, 40, "abcdé")) for i in range(25)] + [(101, "qq abé \U0001f642 qq"), (106, None), (111, "")]
    got = {r.doc_id: r.score for r in ppm.score(documents(rows), train(), order, most_grams=head).collect()}
    counts = plain_model([lowered(t) for i, t in rows if i % 5 != 1], order)
    for doc_id, text in rows:
        assert got[doc_id] == pytest.approx(plain_log10(counts, lowered(text), order), abs=1e-9)
