"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Unit vectors are projected on many random directions. Two vectors at the cosine
threshold differ along each by a known normal amount, so the number of
directions on which one lies in the other's window follows a binomial
distribution: pairs are verified from the count on that keeps the target recall.

The first projection is sorted over the whole table and cut into blocks of
bounded size; blocks too far apart on it are never compared. Inside a pair of
blocks the others are sorted, windows are found by bisection, and collisions are
counted. Verified pairs are only counted and joined to components, never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.llm.components import connected, local_components
from crawlspark.operators.ordered import row_numbers

#: Queries whose windows are looked up together.
TILE = 64


def directions(dim: int, projections: int, seed: int) -> np.ndarray:
    """Gaussian directions, one a column; the same for every vector of this length."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, projections))


def unit(vectors: list) -> np.ndarray:
    """The vectors in double precision, each of length 1."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def within(width: float, distance: float) -> float:
    """Probability that the projections of vectors this far apart differ by ``width`` at the most."""
    return math.erf(width / (distance * math.sqrt(2)))


def collisions_needed(projections: int, chance: float, recall: float) -> int:
    """The highest count that a pair with this chance of each collision reaches with probability ``recall``."""
    missed = 0.0
    for count in range(projections + 1):
        missed += math.comb(projections, count) * chance**count * (1 - chance) ** (projections - count)
        if missed > 1 - recall:
            return count
    return projections


def collision_counts(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """For each row of ``a`` and of ``b`` on how many projections ``b`` is in the window around ``a``."""
    counts = np.zeros((len(a), len(b)), dtype=np.uint8)
    for j in range(a.shape[1]):
        order_a, order_b = np.argsort(a[:, j], kind="stable"), np.argsort(b[:, j], kind="stable")
        sorted_a, sorted_b = a[order_a, j], b[order_b, j]
        low = np.searchsorted(sorted_b, sorted_a - width, "left")
        high = np.searchsorted(sorted_b, sorted_a + width, "right")
        for start in range(0, len(a), TILE):
            stop = min(start + TILE, len(a))
            first, last = low[start], high[stop - 1]
            if first < last:
                at = np.arange(first, last)
                inside = (at >= low[start:stop, None]) & (at < high[start:stop, None])
                counts[np.ix_(order_a[start:stop], order_b[first:last])] += inside
    return counts


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    recall: float = 0.9995,
    projections: int = 24,
    width: float = 1.5,
    block_rows: int = 2048,
    seed: int = 5,
) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked if their labels and lengths are equal and their
    cosine, in double precision, is ``threshold`` or more; a link is missed with
    a chance of 2 (1 - ``recall``) at the most. ``width`` is the half width of a
    window in standard deviations of a pair at the threshold.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component,
    and rows with a NULL label or vec_id, link with nothing and are kept.
    Repeated rows are vectors of their own that link with each other;
    ``component_id`` is then the same id for all of them, and they are kept.
    """
    distance = math.sqrt(2 - 2 * threshold)
    reach = width * distance
    needed = collisions_needed(projections, within(reach, distance), recall)
    # On the sorted projection a pair must be in reach with the same recall.
    first_reach = reach
    while within(first_reach, distance) < recall:
        first_reach += 0.05 * distance

    def lead(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.full(len(batch), np.nan)
            lengths = np.array([len(v) for v in batch], dtype=int)
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                # On its own, so that a row's value doesn't depend on the batch it came in.
                out[rows] = (unit([batch.iloc[r] for r in rows]) * directions(dim, projections + 1, seed)[:, 0]).sum(axis=1)
            yield pd.Series(out)

    rows = vectors.select("vec_id", "embedding", "label")
    good = F.expr(
        "vec_id is not null and label is not null and embedding is not null and size(embedding) > 0 "
        "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(embedding, x -> x != 0)"
    )
    usable = rows.where(good).withColumn("part", F.concat_ws(":", "label", F.size("embedding")))
    placed = usable.withColumn("lead", F.pandas_udf(lead, "double")("embedding")).drop("label")
    ranked = row_numbers(placed, "part", ["lead", "vec_id"], "rank")
    ranked = cut_lineage(
        ranked.select(
            "part",
            F.floor((F.col("rank") - 1) / block_rows).alias("block"),
            F.xxhash64("part", "rank").alias("node"),
            "vec_id",
            "lead",
            "embedding",
        ),
        "embedding-blocks",
    )
    blocks = ranked.groupBy("part", "block").agg(F.min("lead").alias("low"), F.max("lead").alias("high"))
    left = blocks.select("part", F.col("block").alias("a"), F.col("high").alias("a_high"))
    right = blocks.select("part", F.col("block").alias("b"), F.col("low").alias("b_low"))
    pairs = left.join(right, "part").where((F.col("a") <= F.col("b")) & (F.col("b_low") - F.col("a_high") <= first_reach))
    pairs = cut_lineage(pairs.select("part", "a", "b"), "embedding-block-pairs")
    data = ranked.select("part", "block", "node", "embedding")
    sides = data.join(pairs.withColumn("block", F.col("a")), ["part", "block"]).withColumn("side", F.lit(0)).unionByName(
        data.join(pairs.where("a != b").withColumn("block", F.col("b")), ["part", "block"]).withColumn("side", F.lit(1))
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "node"], ignore_index=True)
        x = unit(list(frame["embedding"]))
        projected = x @ directions(x.shape[1], projections + 1, seed)[:, 1:]
        first = int((frame["side"] == 0).sum())
        alone = first == len(frame)
        a, b = np.arange(first), np.arange(first if not alone else 0, len(frame))
        near = collision_counts(projected[a], projected[b], reach) >= needed
        i, j = np.nonzero(np.triu(near, 1) if alone else near)
        i, j = a[i], b[j]
        real = np.zeros(len(i), dtype=bool)
        for start in range(0, len(i), 1 << 16):
            s = slice(start, start + (1 << 16))
            real[s] = (x[i[s]] * x[j[s]]).sum(axis=1) >= threshold
        i, j = i[real], j[real]
        nodes = frame["node"].to_numpy()
        links = np.bincount(i, minlength=len(frame)) + np.bincount(j, minlength=len(frame))
        root = local_components(len(frame), i, j)
        out = pd.DataFrame({"node": nodes, "links": links, "linked": nodes[root]})
        return out[out["links"] > 0]

    found = sides.groupBy("part", "a", "b").applyInPandas(compare, "node long, links long, linked long")
    found = cut_lineage(found, "embedding-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = connected(found, "node", "linked")
    linked = ranked.select("node", "vec_id").join(counts, "node").join(roots, "node")
    least = linked.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = linked.join(least.withColumn("root", F.expr("root ^ 0L")), "root").select("vec_id", "n_links", "component_id")
    alone = ranked.join(counts, "node", "left_anti").select("vec_id").unionByName(
        rows.where(~F.coalesce(good, F.lit(False))).select("vec_id")
    )
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
