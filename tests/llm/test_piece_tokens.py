"""Ids and texts of the distinct-chunk table against the library's own."""

from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from crawlspark.lineage import cut_lineage
from crawlspark.llm import piece_tokens
from llm_helpers import prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "   a   b   ", "▁", "a▁b ▁▁ c", "▁▁", "\n", "\t x\r\n y", "x\x00y \x00",
    "<s> </s> <unk> <0x0A>", "é ü 漢字 😀 ｱ ﬁ", " a b", "x" * 3000, " " * 300, "ab" * 200 + " " + "1 " * 500, "a b a b a b",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def check(rows, texts, library):
    assert [r.doc_id for r in rows] == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids, repr(texts[r.doc_id])
        assert r.decoded == library.decode(ids)


def test_odd_texts(spark, documents, library):
    texts = dict(enumerate(ODD))
    docs = documents(texts.items()).withColumn("ids", F.lit(1)).withColumn("batch", F.lit("x"))
    found = piece_tokens.decode(piece_tokens.encode(docs, MODEL), MODEL)
    check(found.orderBy("doc_id").collect(), texts, library)


def test_many_batches(spark, documents, library, monkeypatch):
    # Texts of many batches share words, and a busy word occurs everywhere.
    texts = {i: "the " * (i % 50) + prose(i % 7, 40) + ODD[i % len(ODD)].__str__() for i in range(300)}
    docs = cut_lineage(documents(texts.items()).repartition(3), "piece-docs")
    monkeypatch.setattr(piece_tokens, "BATCH_CHARS", 2000)
    for buckets in (1, 16):
        found = piece_tokens.encode(docs, MODEL, buckets, decoded=True)
        check(found.orderBy("doc_id").collect(), texts, library)


def test_equal_batches(spark, documents, library, monkeypatch):
    monkeypatch.setattr(piece_tokens, "BATCH_CHARS", 5)
    texts = dict.fromkeys(range(20), "a b c")
    docs = documents([(1, "a b c")] * 20)
    rows = piece_tokens.encode(docs, MODEL, decoded=True).collect()
    assert len(rows) == 20 and {r.decoded for r in rows} == set(texts.values())


def test_another_reading_is_noticed(spark, documents):
    clock = "concat(text, cast(reflect('java.lang.System', 'nanoTime') as string))"
    docs = documents([(i, f"word{i} ") for i in range(5)]).withColumn("text", F.expr(clock))
    with pytest.raises(Exception, match="encode a written table"):
        piece_tokens.encode(docs, MODEL).collect()


def test_repeated_and_missing_ids(spark, documents, library):
    docs = documents([(1, "a b"), (1, "a b"), (1, "c"), (None, "d e"), (None, "d e")])
    rows = piece_tokens.encode(docs, MODEL).collect()
    expected = [(1, "a b"), (1, "a b"), (1, "c"), (None, "d e"), (None, "d e")]
    ids = [(i, tuple(library.encode(t, add_bos=True, add_eos=True))) for i, t in expected]
    assert sorted([(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows], key=repr) == sorted(ids, key=repr)


def test_empty_table(spark, documents):
    found = piece_tokens.decode(piece_tokens.encode(documents([]), MODEL), MODEL)
    assert found.columns == ["doc_id", "ids", "decoded"] and found.count() == 0


def test_each_distinct_chunk_is_segmented_once(library, monkeypatch):
    pieces = piece_tokens.Pieces(MODEL)
    assert pieces.chunks("a  b") == ["a", "▁b"] and pieces.chunks("a ") == ["a", ""]
    asked = []
    monkeypatch.setattr(piece_tokens, "_pieces", lambda path: pieces)
    monkeypatch.setattr(pieces, "segmented", lambda chunks: asked.extend(chunks) or [[1]] * len(chunks), raising=False)
    monkeypatch.setattr(piece_tokens.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    deal = piece_tokens._deal(4, documents=False)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b a c", "b b d"])], names=["doc_id", "text"])
    dealt = [row for _ in range(2) for part in deal(iter([batch])) for row in part.to_pylist()]
    rows = sorted((r for r in dealt if r["bucket"] >= 0), key=lambda r: r["bucket"])
    table = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("batch", pa.string()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())]))
    list(piece_tokens._segment(MODEL)(iter([table])))
    assert sorted(asked) == ["a", "b", "c", "d"]
