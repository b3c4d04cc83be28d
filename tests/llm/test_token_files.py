import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from llm_helpers import prose
from tokenizers import Tokenizer

from crawlspark.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = [
    "",
    " ",
    "  a",
    "a  b",
    "a ",
    "\n",
    "a\nb \nc\n\n d",
    "it's they'll  'tis",
    "é ü ñ 中文 字 　x y z",
    "a\tb \t c\x1cd e\x85f",
    "<|endoftext|> x<|endoftext|>",
    "a <|endoftext|> b",
    "<|endoftext|>",
    " <|endoftext|><|endoftext|>  b <|endoftext |> <|endof",
    "1234 56,78 %%% ### a&&&",
    "🙂 🙂🙂 👩‍👩‍👧 é ",
    "x" * 5000,
]


def test_words_encode_as_whole_texts_do(tokenizer):
    encoder = tf.WordEncoder(PATH)
    encoder.MOST_WORDS = 50
    texts = [*ODD, *(prose(i, 50, "abc dé\n,.'1") for i in range(60))]
    for text, encoded in zip(texts * 2, encoder.encode(texts) + encoder.encode(texts), strict=True):
        got = np.frombuffer(encoded, encoder.dtype).tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document_in_order(documents, folder, tokenizer, monkeypatch):
    rows = [(1000 - i, text) for i, text in enumerate(ODD)] + [(i, prose(i, 200)) for i in range(300)]
    rows += [(None, "no id"), (5000, None), (5001, prose(1, 30_000)), (7, "again"), (7, "again"), (-3, "below")]
    docs = documents(rows).selectExpr("*", "1 as start", "2 as shard")
    manifest = tf.write_token_files(docs, PATH, folder, shards=5)
    got = tf.read_token_files(manifest, folder).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(tokenizer, rows)
    files = manifest.orderBy("shard").collect()
    assert [f.start for f in files] == np.cumsum([0, *(f.tokens for f in files)])[:-1].tolist()
    assert sum(f.docs for f in files) == len(rows)

    found = tf.fetch_documents(manifest, folder, [5001, 7, 12345, -3])
    assert found.keys() == {5001, 7, -3} and len(found[7]) == 3
    assert found[5001].pop().tolist() == [*tokenizer.encode(prose(1, 30_000), add_special_tokens=False).ids, 0]


def test_an_empty_table_gives_no_file(documents, folder):
    manifest = tf.write_token_files(documents([]), PATH, folder)
    assert manifest.count() == 0 and tf.read_token_files(manifest, folder).count() == 0
    assert tf.fetch_documents(manifest, folder, [1]) == {}


class Recorded:
    """A file in memory that notes what is read."""

    def __init__(self, data):
        self.data, self.at, self.reads = data, 0, []

    def size(self):
        return len(self.data)

    def seek(self, at):
        self.at = at

    def read(self, n):
        self.reads.append((self.at, n))
        return bytes(self.data[self.at : self.at + n])


def written(docs, dtype="<u2"):
    import io

    stream = io.BytesIO()
    writer = tf.TokenFileWriter(stream, dtype)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, dtype).tobytes())
    writer.close()
    return stream.getvalue()


def test_only_the_wanted_frames_are_read(monkeypatch):
    monkeypatch.setattr(tf, "FRAME_BYTES", 100)
    monkeypatch.setattr(tf, "MOST_FRAME_BYTES", 400)
    docs = [(i, range(i, i + 30)) for i in range(50)] + [(99, range(5000)), (100, [1])]
    data = written(docs)
    file = Recorded(data)
    reader = tf.TokenFileReader(file)
    assert len(reader.sizes) > 25 and max(reader.sizes) <= 400
    file.reads.clear()
    assert reader.document(reader.rows_of(20)[0]).tolist() == list(range(20, 50))
    assert len(file.reads) == 1 and file.reads[0][1] < 200
    # A long document spans frames.
    assert reader.document(reader.rows_of(99)[0]).tolist() == list(range(5000))
    assert [i.tolist() for _, i in reader.documents()] == [list(ids) for _, ids in docs]
    # Any zstandard reader takes the frames, and skips the tables.
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(np.array(ids, "<u2").tobytes() for _, ids in docs)


def test_damage_is_noticed():
    data = bytearray(written([(1, range(1000)), (2, range(50))]))
    whole = tf.TokenFileReader(Recorded(data))
    at = int(whole.file_at[0]) + int(whole.packed[0]) // 2
    for change in (at, len(data) - 1, len(data) - tf.FOOTER.size - 2):
        broken = bytearray(data)
        broken[change] ^= 0xFF
        with pytest.raises(tf.CorruptFile):
            for _ in tf.TokenFileReader(Recorded(broken)).documents():
                pass
    assert len(list(tf.TokenFileReader(Recorded(written([]))).documents())) == 0


def test_new_words_are_encoded_some_to_a_text(tokenizer):
    class Noted:
        def __init__(self, inner):
            self.inner, self.texts = inner, []

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.inner.encode_batch_fast(texts, **options)

    encoder = tf.WordEncoder(PATH)
    encoder.tokenizer = noted = Noted(encoder.tokenizer)
    texts = [prose(i, 300, "abcdeé,.'1") for i in range(20)]
    for text, encoded in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(encoded, encoder.dtype).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert 1 < max(t.count(" ") for t in noted.texts) <= encoder.WORDS_OF_TEXT


class Counted:
    """A tokenizer that notes the texts it is given."""

    def __init__(self, inner):
        self.inner, self.texts = inner, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.inner.encode_batch_fast(texts, **options)

    def words(self):
        return [word for text in self.texts for word in text.split(" ")[1:]]


def test_the_library_gets_a_word_of_many_texts_once(tokenizer):
    encoder = tf.WordEncoder(PATH)
    encoder.MOST_WORDS = 50
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    # Common words come again after more new ones than the memory holds, in one call and in the next.
    common = [f"common{i}é," for i in range(20)]
    texts = ["a " + " ".join(common if i % 100 == 0 else [f"new{i}x{k}" for k in range(8)]) for i in range(300)]
    later = ["a " + " ".join(common), *texts[1:100], "a " + " ".join(common)]
    for part in (texts, later):
        counted.texts.clear()
        for text, encoded in zip(part, encoder.encode(part), strict=True):
            assert np.frombuffer(encoded, encoder.dtype).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(counted.words()) == len(set(counted.words()))
        assert len(encoder.words) <= 50
    assert not {*common} & {*counted.words()}


def test_groups_and_calls_of_any_size_give_the_same_ids(tokenizer):
    texts = [*ODD, "a \x85b", "b　 c", *(prose(i, 30, "abé\n,.'1") for i in range(40))]
    texts.append("long " + "y" * 5000 + " word")
    for group, call in ((1, 1), (300, 40), (1 << 23, 1 << 18)):
        encoder = tf.WordEncoder(PATH)
        encoder.GROUP_BYTES, encoder.CALL_BYTES = group, call
        for text, encoded in zip(texts * 2, encoder.encode(texts * 2), strict=True):
            got = np.frombuffer(encoded, encoder.dtype).tolist()
            assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert "y" * 5000 not in encoder.words.to_pylist()


def test_a_text_full_of_spaces_takes_no_room_from_long_words(tokenizer):
    encoder = tf.WordEncoder(PATH)
    texts = ["a " + "é" * 100_000, "b" + " " * 1_000_000 + "c d", "e only  once"]
    for text, encoded in zip(texts, encoder.encode(texts), strict=True):
        got = np.frombuffer(encoded, encoder.dtype).tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids
    assert not len(encoder.words)
