"""SentencePiece ids by a table of distinct chunks.

The model writes a space as a marker and puts one before the text. Where no
piece holds a marker after another character, none can reach from one marked
word into the next: a chunk, markers and what follows them up to the next
marker, has the same ids wherever it stands.

Documents are cut into chunks in batches. A batch keeps its documents as
numbers of its distinct chunks, and deals the chunks themselves by their hash.
Where they meet those of all other batches, each distinct one is segmented once.
Their ids go back to the batch in the order in which the chunks came, and are
put in the places of their numbers. A frequent word goes over once per batch,
never once per occurrence. A batch is read twice, for its chunks and for its
documents, rather than stored in between.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
CHUNK = re.compile(f"{MARKER}+[^{MARKER}]*")
#: No byte of UTF-8.
BETWEEN = b"\xff"
#: Characters of the texts that make up a batch; a longer text is one of its own.
BATCH_CHARS = 1 << 22

DEALT = "batch string, bucket int, doc_ids array<long>, payload binary"


class Pieces:
    """A model whose pieces stay inside a chunk."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        pieces = map(model.id_to_piece, range(model.vocab_size()))
        if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
            raise ValueError("pieces of this model reach over a marker")
        probe = "  a b ﬁ\t "
        if model.normalize(probe) != MARKER + probe.replace(" ", MARKER):
            raise ValueError("this model changes texts before it segments them")
        self.bos, self.eos = model.bos_id(), model.eos_id()
        self.dtype = np.dtype("<u2" if model.vocab_size() <= 1 << 16 else "<u4")
        # A text can't be so that it is a lone marker, but can end with one.
        self.lone = model.encode("a ")[len(model.encode("a")) :]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The text's chunks, without the first marker of each."""
        if not text:
            return []
        marked = MARKER + text.replace(" ", MARKER)
        if MARKER * 2 in marked:
            return [chunk[1:] for chunk in CHUNK.findall(marked)]
        return marked.split(MARKER)[1:]

    def segmented(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each of the chunks."""
        found = self.model.encode([chunk.replace(MARKER, " ") for chunk in chunks], num_threads=1)
        return [ids if chunk else self.lone for ids, chunk in zip(found, chunks, strict=True)]

    def decoded(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed value, their bytes by significance."""
    parts = [np.array([len(a) for a in arrays], "<u4").tobytes()]
    parts += [np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpacked(data: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    arrays, at = [], 4 * count
    for length in raw[:at].view("<u4").tolist():
        planes = raw[at : at + 4 * length].reshape(4, length)
        arrays.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
        at += 4 * length
    return arrays


def _deal(buckets: int, documents: bool):
    """Rows of the batches of a partition: their documents, or their chunks by bucket."""

    def batch_of(number: int, doc_ids: list[int | None], texts: list[str]) -> Iterator[tuple]:
        split = [Pieces.chunks(text) for text in texts]
        lengths = np.array([len(s) for s in split], dtype=np.int64)
        known: dict[str, int] = {}
        numbers = np.array([known.setdefault(chunk, len(known)) for s in split for chunk in s], dtype=np.int64)
        chunks = np.array(list(known), dtype=object)
        # Frequent chunks get small numbers.
        often = np.argsort(-np.bincount(numbers, minlength=len(chunks)), kind="stable")
        renumbered = np.empty(len(chunks), dtype=np.int64)
        renumbered[often] = np.arange(len(chunks))
        chunks, numbers = chunks[often], renumbered[numbers]
        hashes = pd.util.hash_array(chunks, categorize=False) if len(chunks) else np.empty(0, np.uint64)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        content = xxhash.xxh128_hexdigest(repr((doc_ids, texts)).encode("utf-8", "surrogatepass"))
        name = f"{TaskContext.get().partitionId()}-{number}-{content}"
        if documents:
            yield name, -1, doc_ids, _packed(lengths, numbers, bucket)
            return
        order = np.argsort(bucket, kind="stable")
        borders = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True]) if len(order) else []
        for start, stop in zip(borders[:-1], borders[1:], strict=True):
            own = BETWEEN.join(chunk.encode() for chunk in chunks[order[start:stop]])
            yield name, int(bucket[order[start]]), None, zstandard.ZstdCompressor(level=3).compress(own)

    def rows(dealt: Iterator[tuple]) -> pa.RecordBatch:
        names, of_bucket, doc_ids, payloads = list(zip(*dealt, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(of_bucket, pa.int32()),
                pa.array(doc_ids, pa.list_(pa.int64())),
                pa.array(payloads, pa.binary()),
            ],
            names=["batch", "bucket", "doc_ids", "payload"],
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list[int | None] = []
        texts: list[str] = []
        held = number = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                if texts and held + len(text) > BATCH_CHARS:
                    yield rows(batch_of(number, doc_ids, texts))
                    doc_ids, texts, held, number = [], [], 0, number + 1
                doc_ids.append(doc_id)
                texts.append(text)
                held += len(text)
        if texts:
            yield rows(batch_of(number, doc_ids, texts))

    return deal


def _segment(path: str):
    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        bucket, table = None, {}
        for batch in batches:
            payloads = []
            for number, payload in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if number != bucket:
                    # Rows come in the order of buckets; the table is that of one.
                    bucket, table = number, {}
                raw = zstandard.ZstdDecompressor().decompress(payload)
                chunks = [chunk.decode() for chunk in raw.split(BETWEEN)]
                new = [chunk for chunk in chunks if chunk not in table]
                table.update(
                    (chunk, np.array(ids, pieces.dtype).tobytes()) for chunk, ids in zip(new, pieces.segmented(new), strict=True)
                )
                ids = [table[chunk] for chunk in chunks]
                sizes = np.array([len(i) for i in ids]) // pieces.dtype.itemsize
                payloads.append(_answer(sizes, b"".join(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(payloads, pa.binary())], names=batch.schema.names
            )

    return segment


def _answer(sizes: np.ndarray, ids: bytes) -> bytes:
    """How many ids each chunk has, and the ids one after the other."""
    head = np.array([len(sizes)], "<u4").tobytes() + sizes.astype("<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + ids)


def _answered(data: bytes, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    end = 4 + 4 * int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw[4:end], "<u4"), np.frombuffer(raw, dtype, offset=end)


def _join_back(path: str, decoded: bool):
    def documents(name: str, doc_ids: list[int | None], packed: bytes, answers: list[bytes]) -> pa.RecordBatch:
        pieces = _pieces(path)
        lengths, numbers, bucket = _unpacked(packed, 3)
        parts = [_answered(answer, pieces.dtype) for answer in answers]
        in_order = np.concatenate([p[0] for p in parts] or [np.empty(0, "<u4")]).astype(np.int64)
        if len(in_order) != len(bucket):
            raise ValueError(f"batch {name} was another one when it was read again; encode a written table")
        order = np.argsort(bucket, kind="stable")
        sizes, starts = np.empty((2, len(order)), dtype=np.int64)
        sizes[order] = in_order
        starts[order] = np.cumsum(in_order) - in_order
        table = np.concatenate([p[1] for p in parts] or [np.empty(0, pieces.dtype)]).astype("<u4")
        # Every chunk's ids in its place, one after the other.
        size = sizes[numbers]
        first = np.cumsum(size) - size
        ids = table[np.repeat(starts[numbers] - first, size) + np.arange(int(size.sum()))]
        stops = np.r_[0, np.cumsum(size)][np.cumsum(lengths, dtype=np.int64)]
        begin, end = (np.array([e], "<u4").tobytes() for e in (pieces.bos, pieces.eos))
        out, texts, at = [], [], 0
        for stop in stops.tolist():
            out.append(begin + ids[at:stop].tobytes() + end)
            if decoded:
                texts.append(pieces.decoded(out[-1]))
            at = stop
        columns = [pa.array(doc_ids, pa.int64()), pa.array(out, pa.binary()), *([pa.array(texts, pa.string())] if decoded else [])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    def join_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The documents of a batch come before the answers to its chunks.
        waiting = None
        for batch in batches:
            for name, number, doc_ids, payload in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if number == -1:
                    if waiting:
                        yield documents(*waiting)
                    waiting = (name, doc_ids, payload, [])
                elif waiting is None or waiting[0] != name:
                    raise ValueError(f"batch {name} was another one when it was read again; encode a written table")
                else:
                    waiting[3].append(payload)
        if waiting:
            yield documents(*waiting)

    return join_back


def encode(docs: DataFrame, model: str, buckets: int | None = None, decoded: bool = False) -> DataFrame:
    """Columns doc_id and ids, the model's ids of every text between its begin and end ids.

    ``ids`` holds little-endian unsigned 32-bit integers; with ``decoded`` their
    text follows as a column of that name. ``docs`` has doc_id and text; further
    columns don't matter. It is read twice and must give the same rows in the
    same order, as a table does; otherwise the job fails. A NULL or empty text
    has the two ends only; rows with the same id, or without one, each give a
    row; an empty table gives none. ``model`` is a path that all executors have.
    A model whose pieces reach over a marker, or that changes texts before it
    segments them, is refused.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    answers = (
        rows.mapInArrow(_deal(buckets or tasks, documents=False), DEALT)
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_segment(model), DEALT)
    )
    return (
        rows.mapInArrow(_deal(buckets or tasks, documents=True), DEALT)
        .unionByName(answers)
        .repartition(tasks, "batch")
        .sortWithinPartitions("batch", "bucket")
        .mapInArrow(_join_back(model, decoded), "doc_id long, ids binary" + (", decoded string" if decoded else ""))
    )


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the model's text of the ids; NULL ids have none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            texts = [None if ids is None else pieces.decoded(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(read, "doc_id long, ids binary, decoded string")
