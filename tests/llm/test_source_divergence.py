"""Divergences from joint tables against counting term by term."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from crawlspark.llm import source_divergence
from llm_helpers import prose

WHOLE = 10**9


def plain(rows, least=3, most=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(count):
            below = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + WHOLE * (count[t] + 1) // below for t in kept}

        of = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((of[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[lang, s][t] and of[s][t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1)}
    return out


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n long, rank string")
    names = ["lang", "source", "part", "item", "value", "rank"]
    answer = [tuple(r) for r in source_divergence.source_divergence(docs, **options).select(*names).collect()]
    assert len(set(answer)) == len(answer)
    return set(answer)


def corpus():
    rows = [(prose(i, 60, "abcde") + " the The THE" * (i % 9), "en" if i % 4 else "de", f"s{i * i % 5}") for i in range(80)]
    rows += [(None, "en", "silent"), ("", None, None), ("é É 1 é2é Ü", "de", None), ("é É é", "de", "s1"), ("é É é", "de", "s1")]
    rows += [("unique words only", "fr", "a"), ("others here", "fr", "b"), ("alone " * 5, "es", "x")] + [("alone", "es", "x")] * 2
    rows += [(" ".join(["long"] * 3000 + [prose(5, 2000, "abc")]), "en", "s0")]
    return rows


def test_against_counting(spark, monkeypatch):
    rows = corpus()
    expected = plain(rows)
    assert {r[2] for r in expected} == {"pair", "term"}
    assert ("fr", "a", "pair", "b", 0, 1) in expected
    assert found(spark, rows) == expected
    assert found(spark, rows, least_docs=1, most_terms=7) == plain(rows, 1, 7)


def test_blocks_and_pieces_change_nothing():
    draw = np.random.default_rng(1)
    term, source = (a.ravel() for a in np.nonzero(draw.random((60, 9)) < 0.6))
    level = draw.integers(1, 6, len(term))

    def cells():
        total = Counter()
        for a, i, b, j, n in source_divergence._cells(term, source, level):
            for key in zip(a.tolist(), i.tolist(), b.tolist(), j.tolist(), n.tolist()):
                total[key[:4]] += key[4]
        return total

    expected = Counter()
    for t in range(60):
        own = sorted(zip(source[term == t].tolist(), level[term == t].tolist()))
        expected.update((a, i, b, j) for x, (a, i) in enumerate(own) for b, j in own[x:])
    assert cells() == expected
    for columns in (4, 30):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(source_divergence, "MOST_COLUMNS", columns)
            assert cells() == expected
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(source_divergence, "PIECE", 7)
        data = b"ab cd efghijklmnop 12 q " * 3
        assert [t for piece in source_divergence._pieces(data) for t in piece] == source_divergence.TERM.findall(data)


def test_empty_table(spark):
    assert found(spark, []) == set()
