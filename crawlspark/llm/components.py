"""Connected components over links, inside a task and over a whole table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the links (a[i], b[i]) connect it with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _shuffled(lookup: DataFrame) -> DataFrame:
    """The lookup with its key as an expression, so that both sides of a join come straight out of a shuffle.

    Only then adaptive execution splits the partition of a busy key.
    """
    return lookup.withColumn("u", F.expr("u ^ 0L"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Every link from both of its ends, in one pass over the pairs."""
    ends = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    return pairs.select(ends.alias("link")).select("link.*")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that connect what those of this partition do: each larger node with the smallest of its component.

    Links are merged as they come, so a task holds its distinct nodes, not its links.
    """
    nodes, roots = np.empty(0, np.int64), np.empty(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    many = 0

    def merge() -> None:
        nonlocal nodes, roots, held, many
        a = np.concatenate([nodes, *[u for u, _ in held]])
        b = np.concatenate([roots, *[v for _, v in held]])
        names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = local_components(len(names), place[: len(a)], place[len(a) :])
        moved = label != np.arange(len(names))
        nodes, roots, held, many = names[moved], names[label[moved]], [], 0

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        many += batch.num_rows
        if many > 1 << 19:
            merge()
    if held:
        merge()
    for start in range(0, len(nodes), 1 << 16):
        part = slice(start, start + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(roots[part])], names=["u", "v"])


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``root`` (smallest node connected with it) for every node of ``links``.

    A round hands the larger neighbours of every node to the smallest one it
    knows, then makes a forest of the links that have their larger end in common,
    until all components are stars. Each round is a written table. The minimum
    of a busy node is pre-aggregated, its links are joined with a lookup that
    adaptive execution may split, and every task makes a forest of what it holds
    before links are shuffled by their larger end, so that no node comes more
    than once out of a task. NULL ends and links of a node with itself are left out.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = cut_lineage(pairs.mapInArrow(_forest, "u long, v long"), "links")
    while not _stars(pairs):
        both = _both_ways(pairs)
        least = _shuffled(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = large.mapInArrow(_forest, "u long, v long")
        pairs = cut_lineage(held.repartition("u").mapInArrow(_forest, "u long, v long"), "links")
    named = F.explode(F.array(*[F.struct(F.col(end).alias("node"), F.col("v").alias("root")) for end in ("u", "v")]))
    return pairs.select(named.alias("found")).select("found.*").distinct()


def _stars(pairs: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has no other one."""
    around = _both_ways(pairs).groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return around.where("low < u and low < high").limit(1).count() == 0
