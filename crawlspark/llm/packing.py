"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut into pieces of the longest permitted length at the most. The
pieces are dealt to tasks by a hash, and each task packs runs of a bounded
number of them: in descending order, every piece goes into the open bin that it
fills best, and where none has room a bin is opened of the size whose cost per
token it can hope to fill is least. That is done once for every permitted
smallest size to open, the cheapest packing is kept, and each of its bins is
finally given the smallest size that holds its contents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.mixing import n_tokens

CAPACITIES = (512, 1024, 2048, 4096)


def sequence_cost(length: int) -> float:
    """Cost of a sequence: its tokens, the part of attention that grows with the square, and a fixed part."""
    return length * (1 + length / 8192) + 64


def pack(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = sequence_cost
) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the size of each bin.

    ``lengths`` are in descending order, positive and at most the largest
    capacity. Of equally full bins the one opened last is taken.
    """
    sizes = sorted(set(capacities))
    best = None
    for least in sizes:
        found = _packed(lengths, sizes, cost, least)
        total = sum(cost(size) for size in found[2])
        if best is None or total < best[0]:
            best = (total, found)
    return best[1]


def _packed(lengths, sizes, cost, least):
    # Tokens of all pieces up to each length: what could still fill a gap.
    upto = np.zeros(sizes[-1] + 1, dtype=np.int64)
    np.add.at(upto, np.asarray(lengths, dtype=np.int64), np.asarray(lengths, dtype=np.int64))
    upto = np.cumsum(upto).tolist()
    rooms: list[list[int]] = [[] for _ in range(sizes[-1] + 1)]  # open bins by the room they have
    open_rooms = 0  # bit r is set if there is a bin with room r
    bins, offsets, filled, room_of = [], [], [], []
    opened: dict[int, int] = {}
    for length in lengths:
        fitting = open_rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            size = opened.get(length)
            if size is None:
                size = opened[length] = min(
                    (s for s in sizes if s >= max(length, min(least, sizes[-1]))),
                    key=lambda s: (cost(s) / (length + min(s - length, upto[min(s - length, length)])), s),
                )
            room, number = size, len(filled)
            filled.append(0)
            room_of.append(size)
        bins.append(number)
        offsets.append(filled[number])
        filled[number] += length
        left = room - length
        if left:
            if not rooms[left]:
                open_rooms |= 1 << left
            rooms[left].append(number)
    final = [next(s for s in sizes if s >= f) for f in filled]
    return bins, offsets, final


def packed_documents(
    docs: DataFrame, capacities: Sequence[int] = CAPACITIES, run_rows: int = 20_000
) -> DataFrame:
    """One row for each piece of every row of ``docs`` (doc_id, text).

    Columns: doc_id, piece (from 0), start (words of the document before it),
    n_tokens (its words), bin_id, bin_size and bin_offset. A text without a word,
    or NULL, has one piece of 0 tokens in no bin. Rows that repeat an id are
    packed each; a NULL doc_id is kept. ``run_rows`` pieces are packed together.
    """
    longest = max(capacities)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # As text, so that no id is ever rounded on its way through pandas.
    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), n_tokens("text").alias("total"))
    last = F.greatest(F.ceil(F.col("total") / longest) - 1, F.lit(0))
    pieces = (
        counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
        .withColumn("start", F.col("piece") * longest)
        .withColumn("n_tokens", F.least(F.col("total") - F.col("start"), F.lit(longest)).cast("long"))
        .drop("total")
        .withColumn("deal", F.xxhash64("doc_id", "piece", "n_tokens"))
    )

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        held, rows, run = [], 0, 0
        for frame in frames:
            for start in range(0, len(frame), run_rows):
                part = frame.iloc[start : start + run_rows]
                if rows + len(part) > run_rows and rows:
                    yield filled(pd.concat(held), (task << 40) + (run << 20))
                    held, rows, run = [], 0, run + 1
                held.append(part)
                rows += len(part)
        if held:
            yield filled(pd.concat(held), (task << 40) + (run << 20))

    def filled(frame: pd.DataFrame, first_bin: int) -> pd.DataFrame:
        frame = frame.sort_values("n_tokens", ascending=False, kind="stable", ignore_index=True)
        placed = int((frame["n_tokens"] > 0).sum())
        bins, offsets, sizes = pack(frame["n_tokens"].tolist()[:placed], capacities)
        empty = [None] * (len(frame) - placed)
        frame["bin_id"] = pd.array([first_bin + b for b in bins] + empty, dtype="Int64")
        frame["bin_size"] = pd.array([sizes[b] for b in bins] + empty, dtype="Int64")
        frame["bin_offset"] = pd.array(offsets + empty, dtype="Int64")
        return frame.drop(columns="deal")

    return (
        pieces.repartition(tasks, "deal")
        .sortWithinPartitions("deal", "doc_id", "piece")
        .mapInPandas(
            fill,
            "doc_id string, piece long, start long, n_tokens long, bin_id long, bin_size long, bin_offset long",
        )
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    )
