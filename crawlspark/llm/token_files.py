"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames, each with its own checksum,
then two skippable frames: the document index, and the seek table of the public
seekable format (compressed size, size and checksum of each frame, and a footer
that is found from the end of the file). A reader takes the two tables from the
end and decompresses only the frames that the wanted documents lie in. Any
zstandard reader can decompress the whole file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.session import checkpoint_root

SEEK_TABLE = 0x184D2A5E
DOCUMENT_INDEX = 0x184D2A50
FOOTER = struct.Struct("<IBI")
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
HEADER = struct.Struct("<II")
#: A frame is closed once it holds so many bytes; one of a longer document has this many at most.
FRAME_BYTES, MOST_FRAME_BYTES = 1 << 16, 1 << 26


class CorruptFile(ValueError):
    """A checksum or a mark of the format is not what it must be."""


class WordEncoder:
    """A tokenizer that remembers the ids of words.

    The pre-tokenizer of byte-level BPE starts a new token wherever a single
    space stands between two characters that are not white space. A text may so
    be cut before these spaces and its pieces be encoded one by one, and most
    pieces have been met before. Arrow tells the different words of many texts,
    looks them up and puts their ids in the texts' order. The new ones are
    encoded some to a text, and told apart by the tokens that begin with a space:
    the library takes longer for a word by itself, and for each word of a long
    text. When the memory is full, words that were met once go first, then those
    not met for longest. A text that holds a special token as such goes to the
    library in pieces, without the memory.
    """

    MOST_WORDS = 300_000
    #: Longer words are not remembered.
    MOST_WORD_BYTES = 64
    #: Texts whose words are told together, and what goes to the library in one call.
    GROUP_BYTES, CALL_BYTES = 1 << 23, 1 << 18
    #: New words of one text.
    WORDS_OF_TEXT = 50
    BOUNDARY = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.after_space = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.after_space[number] = token.startswith("\u0120")
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def _whole(self, text: str) -> bytes:
        whole = any(" " in token and token in text for token in self.special)
        pieces = self.tokenizer.encode_batch_fast([text] if whole else self.BOUNDARY.split(text), add_special_tokens=False)
        return b"".join(np.array(e.ids, self.dtype).tobytes() for e in pieces)

    def _begin(self, firsts: pa.Array) -> pa.Array:
        """The ids of each text's first word, as bytes."""
        out = []
        for part in _slices(firsts, self.CALL_BYTES):
            encoded = self.tokenizer.encode_batch_fast(part.to_pylist(), add_special_tokens=False)
            out.append(pa.array([np.array(e.ids, self.dtype).tobytes() for e in encoded], pa.large_binary()))
        return pa.concat_arrays(out)

    def _learn(self, new: pa.Array) -> pa.Array:
        """The ids of each word after a space, as bytes; white space begins or ends none of them."""
        out = [pa.array([], pa.large_binary())]
        for part in _slices(new, self.CALL_BYTES):
            words = part.to_pylist()
            some = range(0, len(words), self.WORDS_OF_TEXT)
            joined = [" " + " ".join(words[start : start + self.WORDS_OF_TEXT]) for start in some]
            encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in encoded), self.dtype)
            starts = np.flatnonzero(self.after_space[ids])
            if len(starts) != len(words):
                raise ValueError(f"{len(words)} words gave {len(starts)} tokens that begin with a space")
            ends = np.r_[starts, len(ids)] * self.dtype.itemsize
            buffers = [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(ids)]
            out.append(pa.Array.from_buffers(pa.large_binary(), len(words), buffers))
        return pa.concat_arrays(out)

    def _group(self, texts: pa.Array) -> list[bytes]:
        alone = np.zeros(len(texts), dtype=bool)
        for token in self.special:
            alone |= _flags(pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(pa.array(alone), "", texts), " ")
        bounds = split.offsets.to_numpy()
        firsts = split.values.take(pa.array(bounds[:-1]))
        coded = split.values.dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy()
        rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
        after = np.ones(len(codes), dtype=bool)
        after[bounds[:-1]] = False
        # A space beside other white space is no place to cut.
        fit = _flags(pc.equal(pc.utf8_trim_whitespace(words), words)) & _flags(pc.not_equal(words, ""))
        alone[rows[after & ~fit[codes]]] = True
        alone |= (np.diff(bounds) > 1) & ~_flags(pc.equal(pc.utf8_rtrim_whitespace(firsts), firsts))
        after &= ~alone[rows]
        counts = np.bincount(codes[after], minlength=len(words))

        # Place of each word's ids among those remembered and the new ones; -1: it needs none.
        places = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype("i8")
        new = np.flatnonzero((places < 0) & (counts > 0))
        places[new] = len(self.words) + np.arange(len(new))
        ids = pa.concat_arrays([self.ids, self._learn(words.take(pa.array(new)))])
        begun = self._begin(pc.if_else(pa.array(alone), "", firsts))
        # What lies in a text that is encoded as a whole stands for its first word, which is empty here.
        wanted = np.where(after, places[codes], len(ids) + rows)
        joined = pa.concat_arrays([ids, begun]).take(pa.array(wanted))
        _, ends, data = joined.buffers()
        cuts = np.frombuffer(ends, "<i8", len(joined) + 1)[bounds].tolist()
        view = memoryview(data or b"")
        out = [view[a:b].tobytes() for a, b in pairwise(cuts)]
        for row in np.flatnonzero(alone).tolist():
            out[row] = self._whole(texts[row].as_py())
        self._remember(words, ids, places, counts, new)
        return out

    def _remember(self, words: pa.Array, ids: pa.Array, places: np.ndarray, counts: np.ndarray, new: np.ndarray) -> None:
        """Keep ``ids``, those remembered and then those of the ``new`` ones of the ``words``."""
        all_words = pa.concat_arrays([self.words, words.take(pa.array(new))])
        met = (places >= 0) & (counts > 0)
        before = np.ones(len(self.words), dtype=bool)
        before[places[met & (places < len(self.words))]] = False
        again = met & ((places < len(self.words)) | (counts > 1))
        order = np.concatenate([places[again], np.flatnonzero(before), places[met & ~again]])
        short = pc.binary_length(all_words).to_numpy() <= self.MOST_WORD_BYTES
        keep = pa.array(order[short[order]][: self.MOST_WORDS])
        self.words, self.ids = all_words.take(keep), ids.take(keep)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, as bytes of ``dtype``; those of NULL are none."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        return [ids for group in _slices(texts.fill_null(""), self.GROUP_BYTES) for ids in self._group(group)]


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(bool)


def _slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Successive texts of about ``most`` bytes together."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    starts = np.flatnonzero(np.diff(ends // most, prepend=-1)).tolist()
    for start, stop in pairwise([*starts, len(texts)]):
        yield texts.slice(start, stop - start)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents one after the other; holds one frame and the two tables."""

    def __init__(self, stream, dtype: np.dtype, level: int = 3):
        self.stream, self.dtype = stream, np.dtype(dtype)
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids))
        for start in range(0, len(ids), MOST_FRAME_BYTES):
            part = ids[start : start + MOST_FRAME_BYTES]
            if self.held and self.held_bytes + len(part) > MOST_FRAME_BYTES:
                self._flush()
            self.held.append(part)
            self.held_bytes += len(part)
        if self.held_bytes >= FRAME_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            data = b"".join(self.held)
            frame = self.compressor.compress(data)
            self.stream.write(frame)
            self.frames.append((len(frame), len(data), _checksum(data)))
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self._flush()
        known = np.array([i is not None for i in self.ids], dtype=np.uint8)
        ids = np.array([i or 0 for i in self.ids], dtype="<i8")
        lengths = np.array(self.lengths, dtype="<u8")
        head = struct.pack("<BQ", self.dtype.itemsize, len(ids))
        index = self.compressor.compress(head + known.tobytes() + ids.tobytes() + lengths.tobytes())
        self.stream.write(HEADER.pack(DOCUMENT_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += FOOTER.pack(len(self.frames), CHECKSUMS, FOOTER_MAGIC)
        self.stream.write(HEADER.pack(SEEK_TABLE, len(table)) + table)


class TokenFileReader:
    """Reads documents of one file by their id."""

    def __init__(self, file):
        self.file = file
        self.decompressor = zstandard.ZstdDecompressor()
        size = file.size()
        frames, flags, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise CorruptFile("no seek table with checksums at the end")
        length = 12 * frames + FOOTER.size
        head = HEADER.unpack(self._read(size - length - HEADER.size, HEADER.size))
        if head != (SEEK_TABLE, length):
            raise CorruptFile("the seek table's header does not fit its footer")
        table = np.frombuffer(self._read(size - length, 12 * frames), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = table.T
        self.file_at = np.r_[0, np.cumsum(self.packed)]
        self.data_at = np.r_[0, np.cumsum(self.sizes)]
        at = int(self.file_at[-1])
        mark, length = HEADER.unpack(self._read(at, HEADER.size))
        if mark != DOCUMENT_INDEX:
            raise CorruptFile("no document index after the frames")
        index = self.decompressor.decompress(self._read(at + HEADER.size, length))
        width, n = struct.unpack_from("<BQ", index)
        self.dtype = np.dtype(f"<u{width}")
        self.known = np.frombuffer(index, np.uint8, n, 9).astype(bool)
        self.ids = np.frombuffer(index, "<i8", n, 9 + n)
        lengths = np.frombuffer(index, "<u8", n, 9 + 9 * n).astype(np.int64)
        self.starts = np.r_[0, np.cumsum(lengths)]
        self.frame: tuple[int, bytes] = (-1, b"")

    def _read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def _frame(self, number: int) -> bytes:
        if self.frame[0] != number:
            packed = self._read(int(self.file_at[number]), int(self.packed[number]))
            try:
                data = self.decompressor.decompress(packed)
            except zstandard.ZstdError as error:
                raise CorruptFile(f"frame {number}: {error}") from error
            if len(data) != self.sizes[number] or _checksum(data) != self.sums[number]:
                raise CorruptFile(f"frame {number} has a wrong size or checksum")
            self.frame = (number, data)
        return self.frame[1]

    def document(self, row: int) -> np.ndarray:
        """Ids of the file's document number ``row``; only its frames are decompressed."""
        start, stop = int(self.starts[row]), int(self.starts[row + 1])
        parts = []
        if stop > start:
            first = int(np.searchsorted(self.data_at, start, "right")) - 1
            last = int(np.searchsorted(self.data_at, stop, "left")) - 1
            for number in range(first, last + 1):
                at = int(self.data_at[number])
                parts.append(self._frame(number)[max(0, start - at) : stop - at])
        return np.frombuffer(b"".join(parts), dtype=self.dtype)

    def rows_of(self, doc_id: int) -> list[int]:
        """Numbers of the documents with this id; none if it isn't here."""
        return np.flatnonzero(self.known & (self.ids == doc_id)).tolist()

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for row, (known, doc_id) in enumerate(zip(self.known.tolist(), self.ids.tolist(), strict=True)):
            yield doc_id if known else None, self.document(row)


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Write the texts' ids in ascending doc_id order and return the manifest.

    One row (shard, path, first_id, last_id, docs, tokens, start) per file;
    ``start`` counts the ids of all files before. ``docs`` has doc_id and text; a
    NULL text is empty, rows without an id come first, and rows of one id are in
    the order of their texts. An empty table gives no files. A file appears under
    its name only once it is complete, so an attempt that is lost or repeated
    leaves nothing half written. ``folder`` is a URI that all executors share.
    """
    tasks = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        writer = stream = None
        store, root = _filesystem(folder)
        name = f"{root}/shard-{shard:06d}.zst"
        partial = f"{root}/_writing-{shard:06d}-{uuid.uuid4().hex}"
        tokens = 0
        for batch in batches:
            if writer is None and batch.num_rows:
                store.create_dir(root, recursive=True)
                stream = store.open_output_stream(partial, compression=None)
                writer = TokenFileWriter(stream, encoder.dtype)
            for doc_id, encoded in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                writer.add(doc_id, encoded + end)
                tokens += len(encoded) // encoder.dtype.itemsize + 1
        if writer is not None:
            writer.close()
            stream.close()
            store.move(partial, name)
            known = [i for i in writer.ids if i is not None]
            row = [shard, name, min(known, default=None), max(known, default=None), len(writer.ids), tokens]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), *[pa.int64()] * 4), strict=True)],
                names=["shard", "path", "first_id", "last_id", "docs", "tokens"],
            )

    written = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(tasks, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "shard int, path string, first_id long, last_id long, docs long, tokens long")
    )
    manifest = cut_lineage(written, "token-files")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row (doc_id, start, n_tokens, ids_crc32) per document, from the files of a manifest."""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _filesystem(folder)
        for frame in frames:
            for path, start in zip(frame["path"], frame["start"], strict=True):
                with store.open_input_file(path) as file:
                    rows = []
                    for doc_id, ids in TokenFileReader(file).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                answer = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield answer.astype({"doc_id": "Int64"})

    return manifest.repartition(tasks, "shard").mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def fetch_documents(manifest: DataFrame, folder: str, doc_ids: Iterable[int]) -> dict[int, list[np.ndarray]]:
    """Ids of a few documents, by reading only the frames they lie in."""
    wanted = sorted(set(doc_ids))
    store, _ = _filesystem(folder)
    found: dict[int, list[np.ndarray]] = {}
    near = F.lit(False)
    for doc_id in wanted:
        near = near | F.lit(doc_id).between(F.col("first_id"), F.col("last_id"))
    for row in manifest.where(near).select("path").orderBy("path").collect():
        with store.open_input_file(row["path"]) as file:
            reader = TokenFileReader(file)
            for doc_id in wanted:
                for number in reader.rows_of(doc_id):
                    found.setdefault(doc_id, []).append(reader.document(number))
    return found


def token_folder(docs: DataFrame) -> str:
    """A new folder under the one that all executors share."""
    return f"{checkpoint_root(docs.sparkSession)}/crawlspark/token-files-{uuid.uuid4().hex}"
