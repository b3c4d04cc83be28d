import random
import tracemalloc

import numpy as np

from crawlspark.llm import language_filters as lf

WORDS = {
    "aa": ["tamo", "relo", "vina", "soku", "pare", "limo"],
    "bb": ["grund", "schal", "weist", "knorp", "flacht", "zwerg"],
    "cc": ["ouira", "eaule", "queno", "vieux", "aimons", "roule"],
}


def text_of(lang, seed, words=40):
    draw = random.Random(f"{lang}{seed}")
    return " ".join(draw.choice(WORDS[lang]) for _ in range(words))


def training(documents, n=30):
    return documents([(i * 3 + k, text_of(lang, i), lang, "s") for i in range(n) for k, lang in enumerate(WORDS)])


def test_held_out_languages(spark, documents):
    model = lf.fit(training(documents), bits=1 << 14)
    unseen = documents([(i, text_of(lang, 1000 + i), lang, "s") for i in range(20) for lang in WORDS])
    rows = lf.predict(unseen, model).collect()
    assert all(r.lang_pred == r.lang and 0.9 < r.score <= 1 for r in rows)


def test_masks_name_every_language_of_a_gram_and_no_gram_is_lost(documents):
    docs = training(documents)
    model = lf.fit(docs, bits=1 << 14)
    for lang in WORDS:
        bit = np.uint64(1 << model.languages.index(lang))
        grams, _ = lf._grams([text_of(lang, 3)])
        masks = model.rows[0]
        found = masks[lf._positions(grams, 0, len(masks))]
        for probe in range(1, model.probes):
            found = found & masks[lf._positions(grams, probe, len(masks))]
        # A Bloom filter has no false negatives: all but the rarest grams are there.
        assert (found & bit != 0).mean() > 0.95


def test_correction_takes_false_positives_away(documents):
    # A table far too small: most probes hit by chance.
    model = lf.fit(training(documents), bits=1 << 9)
    rates = model.false_positive_rates()
    assert rates.max() > 0.001
    rows = lf.predict(documents([(1, "xyzzy plugh qwxz jjkq vvbn")]), model).collect()
    assert rows[0].score < 0.3


def test_odd_rows(documents):
    model = lf.fit(training(documents), bits=1 << 14)
    long_text = " ".join([text_of("bb", 1, 2000)] * 200)
    rows = documents(
        [(1, None), (2, ""), (3, "12 34 !?"), (4, "a"), (None, text_of("cc", 5)), (6, long_text), (6, long_text), (7, "é" * 5)]
    )
    extra = rows.selectExpr("*", "'x' as score", "1 as lang_pred", "2 as _other")
    got = lf.predict(extra, model)
    assert got.columns.count("score") == 1 and "_other" in got.columns
    found = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[4][0] in WORDS and found[7][0] in WORDS
    assert found[None][0] == "cc"
    assert found[6][0] == "bb" and got.where("doc_id = 6").distinct().count() == 1


def test_scores_do_not_depend_on_the_neighbours():
    texts = [text_of("aa", 1), "", "x", text_of("bb", 2), text_of("cc", 3, 3)]
    rows = np.zeros((1, 1 << 10), np.uint64)
    rows[0, ::3] = 3
    model = lf.LanguageFilters(["aa", "bb"], rows, 2)
    together, _ = lf._shares(model, texts)
    for text, expected in zip(texts, together, strict=True):
        assert np.allclose(lf._shares(model, [text])[0][0], expected)


def test_a_text_of_many_blocks_counts_whole(monkeypatch):
    monkeypatch.setattr(lf, "BLOCK", 50)
    text = text_of("aa", 9, 100)
    _, total = lf._shares(lf.LanguageFilters(["aa"], np.zeros((1, 1 << 8), np.uint64), 1), [text])
    # Each piece stands between spaces of its own.
    assert total[0] >= len(text) - len(text) // 50


def test_more_languages_than_a_word_has_bits(documents):
    names = [f"l{i:02}" for i in range(70)]

    def text(name, seed):
        draw = random.Random(f"{name}{seed}")
        own = random.Random(name)
        words = ["".join(own.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(8)]
        return " ".join(draw.choice(words) for _ in range(30))

    docs = documents([(i * 3 + k, text(name, k), name, "s") for i, name in enumerate(names) for k in range(3)])
    model = lf.fit(docs, bits=1 << 16)
    assert sorted(model.languages) == names and model.rows.shape == (2, 1 << 16)
    found = lf.predict(documents([(i, text(name, 99), name, "s") for i, name in enumerate(names)]), model).collect()
    assert [(r.lang_pred, r.score > 0.4) for r in found] == [(r.lang, True) for r in found]


def test_against_counting_in_sets(documents):
    docs = training(documents)
    model = lf.fit(docs, bits=1 << 20)
    seen = {}
    for r in docs.collect():
        for gram in set(lf._grams([r.text])[0].tolist()):
            seen.setdefault(r.lang, {}).setdefault(gram, set()).add(r.doc_id)
    learned = {lang: {g for g, ids in grams.items() if len(ids) >= 2} for lang, grams in seen.items()}
    texts = {i: " ".join([text_of("aa", i, i), text_of("bb", i, 9 - i), text_of("cc", i, 4)]) for i in range(1, 9)}
    for r in lf.predict(documents(texts.items()), model).collect():
        grams = lf._grams([texts[r.doc_id]])[0].tolist()
        shares = {lang: sum(g in own for g in grams) / len(grams) for lang, own in learned.items()}
        best = max(shares.values())
        assert abs(shares[r.lang_pred] - best) < 1e-3 and abs(r.score - best) < 1e-3


def test_marks_alone_are_no_language(documents):
    model = lf.fit(training(documents), bits=1 << 14)
    found = {r.doc_id: r.lang_pred for r in lf.predict(documents([(1, "\u0301\u0302 \u0303"), (2, "e\u0301")]), model).collect()}
    assert found[1] == "und" and found[2] in WORDS


def test_nothing_to_learn_from(documents):
    empty = documents([])
    model = lf.fit(empty)
    assert model.languages == []
    assert lf.predict(empty, model).count() == 0
    assert lf.predict(documents([(1, "text")]), model).first().lang_pred == "und"
    assert lf.fit(documents([(1, None, "aa", "s"), (2, "text", None, "s")])).languages == []


def test_memory_does_not_follow_the_number_of_texts(monkeypatch):
    model = lf.LanguageFilters(list(WORDS), np.full((1, 1 << 14), 5, dtype=np.uint64), 3)
    texts = [text_of(lang, i, 400) for i in range(200) for lang in WORDS]
    tracemalloc.start()
    shares, total = lf._shares(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All of them at once take 60 MB.
    assert sum(map(len, texts)) > 1_200_000 and peak < 30_000_000
    monkeypatch.setattr(lf, "BATCH", 1)
    alone, number = lf._shares(model, texts)
    assert (alone == shares).all() and (number == total).all()


def test_counting_holds_a_bounded_number_of_grams(monkeypatch):
    texts = [text_of(lang, i, 400) for i in range(100) for lang in WORDS]
    whole = {}
    for text in texts:
        for gram in set(lf._grams([text])[0].tolist()):
            whole[gram] = whole.get(gram, 0) + 1
    monkeypatch.setattr(lf, "HELD", 1000)
    monkeypatch.setattr(lf, "BATCH", 10_000)
    parts = list(lf._gram_counts(texts))
    summed = {}
    for grams, n in parts:
        for gram, k in zip(grams.tolist(), n.tolist(), strict=True):
            summed[gram] = summed.get(gram, 0) + k
    assert len(parts) > 5 and summed == whole
