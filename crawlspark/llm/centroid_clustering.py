"""Clusters around centroids, with vectors as codes of subvectors.

Components become integers, and every few neighbouring dimensions are a block.
In a chunk of vectors a block takes few different values, its subvectors: the
chunk keeps a dictionary of them for every block, and a code in place of each
value. Nothing is rounded. In a round the squared distances of a dictionary's
subvectors to all centroids are computed once, and a vector's distance to a
centroid is the sum of those that its codes name. The new centroids come from
how often each code occurs in each cluster. A dictionary lives and dies with
its chunk, so none of them is sent anywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage

#: Dimensions of a block and vectors of a chunk.
BLOCK, CHUNK = 2, 1 << 14
#: Beyond these components a distance wouldn't fit 64 bits.
MOST = 1 << 27

ENCODED = "ids array<long>, books array<binary>, codes array<binary>"


def whole(vector: Column, dim: int) -> Column:
    """True for a vector of ``dim`` components, all there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dim) & finite, F.lit(False))


def _integers(values: np.ndarray, scale: int, dim: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * scale).reshape(-1, dim)
    if len(scaled) and np.abs(scaled).max() > MOST:
        raise OverflowError(f"a component lies beyond {MOST // scale}; distances would not be exact")
    return scaled.astype(np.int64)


def _dictionary(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a block and for each row the number of its own."""
    low = block.min(axis=0)
    spans = (block.max(axis=0) - low + 1).tolist()
    if np.prod([float(s) for s in spans]) < 2.0**62:
        key = np.zeros(len(block), dtype=np.int64)
        for column, span in zip((block - low).T, spans, strict=True):
            key = key * span + column
        _, first, codes = np.unique(key, return_index=True, return_inverse=True)
        return block[first], codes
    return np.unique(block, axis=0, return_inverse=True)


def encoded(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """Chunks of the whole vectors among ``vectors`` (vec_id, embedding), as dictionaries and codes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        rows: list[np.ndarray] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            numbers = np.concatenate(rows)
            books, codes = [], []
            for start in range(0, dim, BLOCK):
                book, code = _dictionary(numbers[:, start : start + BLOCK])
                books.append(book.astype("<i8").tobytes())
                codes.append(code.astype("<u2").tobytes())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([books], pa.list_(pa.binary())),
                    pa.array([codes], pa.list_(pa.binary())),
                ],
                names=["ids", "books", "codes"],
            )

        for batch in batches:
            numbers = _integers(np.asarray(batch.column(1).flatten()), scale, dim)
            at = 0
            while at < len(numbers):
                take = min(CHUNK - held, len(numbers) - at)
                ids.extend(batch.column(0).slice(at, take).to_pylist())
                rows.append(numbers[at : at + take])
                held, at = held + take, at + take
                if held == CHUNK:
                    yield chunk()
                    ids, rows, held = [], [], 0
        if held:
            yield chunk()

    kept = vectors.where(whole(F.col("embedding"), dim))
    return kept.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(encode, ENCODED)


Chunk = tuple[list, list[np.ndarray], list[np.ndarray]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for ids, books, codes in zip(*(batch.column(i) for i in range(3)), strict=True):
            blocks = [np.frombuffer(b, "<i8").reshape(-1, BLOCK) for b in books.as_py()]
            yield ids.as_py(), blocks, [np.frombuffer(c, "<u2") for c in codes.as_py()]


def _nearest(books: list[np.ndarray], codes: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, and the squared distance."""
    total = np.zeros((len(codes[0]), len(centroids)), dtype=np.int64)
    for number, (book, code) in enumerate(zip(books, codes, strict=True)):
        away = book[:, None, :] - centroids[None, :, number * BLOCK : (number + 1) * BLOCK]
        total += (away * away).sum(axis=2)[code]
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(len(total)), nearest]


def _sums(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        counts, totals = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for _, books, codes in _chunks(batches):
            nearest, _ = _nearest(books, codes, centroids)
            counts += np.bincount(nearest, minlength=k)
            for number, (book, code) in enumerate(zip(books, codes, strict=True)):
                often = np.bincount(nearest * len(book) + code, minlength=k * len(book)).reshape(k, len(book))
                totals[:, number * BLOCK : (number + 1) * BLOCK] += often @ book
        cluster, place = np.indices((k, dim))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cluster.ravel(), pa.int32()),
                pa.array(place.ravel(), pa.int32()),
                pa.array(np.repeat(counts, dim), pa.int64()),
                pa.array(totals.ravel(), pa.int64()),
            ],
            names=["cluster", "place", "n", "total"],
        )

    return add


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after every vector has gone to the nearest of them; one without vectors stays."""
    sums = chunks.mapInArrow(_sums(centroids), "cluster int, place int, n long, total long")
    exact = sums.groupBy("cluster", "place").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    new = centroids.copy()
    for row in exact.where("n > 0").collect():  # one row per centroid and dimension
        new[row["cluster"], row["place"]] = int(row["total"]) // int(row["n"])
    return new


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Columns vec_id, cluster and distance for every vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, books, codes in _chunks(batches):
            nearest, distance = _nearest(books, codes, centroids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return chunks.mapInArrow(assign, "vec_id long, cluster int, distance long")


def first_centroids(vectors: DataFrame, k: int, dim: int, scale: int, seed: int) -> np.ndarray:
    """The ``k`` whole vectors whose sha256 of ``seed:vec_id`` is smallest, in that order.

    Rows of one id follow each other in the order of their components; rows without an id come last.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("long").cast("string")), 256)
    vector = F.col("embedding").cast("array<double>")
    rows = (
        vectors.where(whole(F.col("embedding"), dim))
        .select(drawn.alias("drawn"), vector.alias("vector"))
        .orderBy(F.asc_nulls_last("drawn"), "vector")
        .limit(k)
        .collect()
    )
    return _integers(np.array([r["vector"] for r in rows], dtype=np.float64), scale, dim)


def centroid_clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """Cluster of every whole vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid.

    ``vectors`` has vec_id and embedding; further columns don't matter. Vectors
    that are NULL, of another length than ``dim`` (an even number) or hold a NULL
    or non-finite component have no row. Components become floor(scale * x), and
    all that follows is exact. Each of ``rounds`` sends every vector to the
    nearest centroid (of equally near ones the first) and moves a centroid to
    the componentwise floor of its vectors' mean. Fewer whole vectors than ``k``
    give as many centroids as there are, none give no rows. Repeated rows count
    each. A component beyond 2**27 / scale is an error, as distances wouldn't fit.
    """
    if dim % BLOCK:
        raise ValueError(f"the dimensions are cut into blocks of {BLOCK}")
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding")
    chunks = cut_lineage(encoded(rows, dim, scale), "cluster-codes")
    centroids = first_centroids(rows, k, dim, scale, seed)
    columns = "cluster int, centroid array<long>, centroid_sha256 string, cluster_inertia long, inertia long"
    if not len(centroids):
        return assigned(chunks, np.zeros((1, dim), dtype=np.int64)).join(spark.createDataFrame([], columns), "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
        )
    for _ in range(rounds):
        centroids = moved(chunks, centroids)
    members = cut_lineage(assigned(chunks, centroids), "cluster-members")
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # one row per centroid
    inertia = {r["cluster"]: r["inertia"] for r in sums}
    described = [
        (
            number,
            centroid,
            hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest(),
            inertia.get(number, 0),
            sum(inertia.values()),
        )
        for number, centroid in enumerate(centroids.tolist())
    ]
    # One row per centroid.
    return members.join(F.broadcast(spark.createDataFrame(described, columns)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
