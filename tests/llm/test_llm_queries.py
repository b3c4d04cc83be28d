"""The registered queries that SQL can't state, over the smallest tables, against plain versions."""

import hashlib
import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crawlspark.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_languages(spark, docs):
    rows = run(spark, "op3_language_filters")
    assert {r.doc_id for r in rows} == docs.keys() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in unseen) >= 0.97 * len(unseen)


def test_toxicity(spark, docs, labels):
    rows = run(spark, "op7_toxicity_automaton")
    assert {r.doc_id for r in rows} == docs.keys()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) for r in rows)
    # A dozen toxic documents teach little, but clean ones are left alone.
    clean = [r for r in rows if r.doc_id in labels and not labels[r.doc_id].toxic]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_quality(spark, docs, labels):
    rows = run(spark, "op2_cotraining")
    assert {r.doc_id for r in rows} == docs.keys()
    known = [r for r in rows if r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id].quality for r in known) >= 0.85 * len(known)


def test_packing(spark, docs):
    rows = run(spark, "op4_best_fit_packing")
    words = Counter()
    for r in rows:
        words[r.doc_id] += r.n_tokens
    assert words == Counter({i: len(d.text.encode().split()) for i, d in docs.items()})


def test_token_files(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for doc_id in sorted(docs):
        ids = [*tokenizer.encode(docs[doc_id].text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in run(spark, "op5_token_files")) == expected


def test_sketches(spark, docs):
    order = sorted(docs, reverse=True)
    for r in run(spark, "op6_paragraph_sketch"):
        text = docs[r.doc_id].text
        following = docs[order[(order.index(r.doc_id) + 1) % len(order)]].text
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1.0)


def test_language_model(spark, docs):
    tokens = {i: [*d.text.encode().lower().split(), None] for i, d in docs.items()}
    counts = Counter(w for i, t in tokens.items() if fold(i, 5) != 1 for w in t)
    total, below = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    rows = run(spark, "op10_ppm_score")
    assert len(rows) == len(docs)
    for r in rows:
        words = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(r.doc_id, 5) == 1, len(words), total)
        assert r.n_known == sum(w in counts for w in words) and r.score < 0
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / below) for w in words))


def test_pieces(spark, docs):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = []
    for doc_id, row in docs.items():
        ids = library.encode(row.text or "", add_bos=True, add_eos=True)
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        expected.append((doc_id, len(ids), *digests))
    rows = run(spark, "op13_chunk_pieces")
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(expected)
