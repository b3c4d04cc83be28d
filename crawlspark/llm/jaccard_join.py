"""N-gram Jaccard self-join by chosen paths.

The set of a document is its word shingles. A run samples tokens of each set
with a hash that all sets share, so two similar sets choose a common token with
a known probability; sets that chose the same token meet in a bucket. A bucket
that is too large is split again by further tokens, as a path of two tokens, and
small buckets are compared by brute force. Runs are repeated until a pair at the
threshold is met with the target recall.

Equal sets are one node from the start, whatever their number. Buckets only
propose links, by sketches of the sets; the nodes these connect are then
compared exactly, which also counts each link once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.llm.common import uniform
from crawlspark.llm.components import connected, local_components
from crawlspark.llm.words import constants, lowered, mixed, word_hashes

#: Bytes of a set's sketch, one MinHash each.
SKETCH = 64
#: Text bytes hashed at once in a task; each takes about forty.
BLOCK = 1 << 18
#: Different sketch bytes up to which a row is settled by a pivot.
SETTLED = 20


def shingle_sets(texts: Iterable[str | None], words: int = 5) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text
    with fewer words than a shingle has one shingle of all its words; NULL and
    texts without a word have none.
    """
    sets: list[np.ndarray] = []
    raw, size = [], 0
    for lower in map(lowered, texts):
        if raw and size + len(lower) >= BLOCK:
            sets += _sets_of(raw, words)
            raw, size = [], 0
        raw.append(lower)
        size += len(lower) + 1
    return sets + _sets_of(raw, words) if raw else sets


def _sets_of(raw: list[bytes], words: int) -> list[np.ndarray]:
    word, at = word_hashes(raw)
    rotate = constants(words, 29)
    shingle = np.zeros(max(0, len(word) - words + 1), dtype=np.uint64)
    for k in range(words):
        shingle += word[k : k + len(shingle)] * rotate[k]
    shingle = mixed(shingle)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(shingle[a : b - words + 1]))
        elif b > a:
            short = (word[a:b] * rotate[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _digest(tokens: np.ndarray) -> int | None:
    """A 64-bit digest of a set; None for the empty set."""
    if not len(tokens):
        return None
    total = mixed(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    A set of n tokens takes each with probability 1 / (threshold n). A pair at
    the threshold shares ``threshold`` n tokens of its larger set at least, so it
    takes none in common with probability exp(-1) at most.
    """
    return max(1, math.ceil(math.log(1 - recall) / -1.0))


def _described(
    docs: DataFrame, words: int, threshold: float, runs: int, deep_runs: int, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Per document the digest of its set, and what the buckets need of it."""
    factors = constants(SKETCH, 41)
    seeds = constants(runs + deep_runs, 53)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(s, 1000) for b in batches for s in range(0, b.num_rows, 1000)):
            digests, sizes, sketches, roots, deeps = [], [], [], [], []
            for tokens in shingle_sets(batch.column("text").to_pylist(), words):
                n = len(tokens)
                sizes.append(n)
                if not n:
                    digests.append(None), sketches.append(None), roots.append([]), deeps.append([])
                    continue
                digests.append(_digest(tokens))
                low = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
                for s in range(0, n, 4096):
                    part = tokens[s : s + 4096, None] * factors
                    low = np.minimum(low, (part ^ (part >> np.uint64(32))).min(axis=0))
                sketches.append((mixed(low) >> np.uint64(56)).astype(np.uint8).tobytes())
                most = np.uint64(min(2**64 - 1, int(2**64 / (threshold * n))))
                taken = []
                for seed in seeds:
                    drawn = mixed(tokens ^ seed)
                    taken.append(mixed(drawn[drawn <= most] + seed).view(np.int64))
                roots.append(np.concatenate(taken[:runs]))
                deeps.append(np.concatenate(taken[runs:]))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in names],
                    pa.array(digests, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.binary()),
                    pa.array(roots, longs),
                    pa.array(deeps, longs),
                ],
                names=[*names, "digest", "n", "sketch", "root", "deep"],
            )

    names = ["doc_id", "text_key", *carried]
    rows = docs.select("doc_id", _text_key().alias("text_key"), *carried, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(describe, f"{kinds}, digest long, n int, sketch binary, root array<long>, deep array<long>")


def _text_key() -> Column:
    """What a row without an id is found by."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text"))


def _whole_groups(frames: Iterator[pd.DataFrame], key: list[str], rows: int = 16_384) -> Iterator[pd.DataFrame]:
    """Frames that hold whole groups, from frames sorted by ``key``."""
    held: list[pd.DataFrame] = []
    count = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        count += len(frame)
        if count < rows:
            continue
        joined = pd.concat(held, ignore_index=True)
        last = (joined[key] == joined[key].iloc[-1]).all(axis=1).to_numpy()
        cut = len(joined) - int(last[::-1].argmin()) if not last.all() else 0
        if cut:
            yield joined.iloc[:cut]
        held, count = [joined.iloc[cut:]], len(joined) - cut
    if count:
        yield pd.concat(held, ignore_index=True)


def _pairs(group: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within equal runs of ``group``; in ``cross`` groups only of different sides, and of side -1."""
    i = np.arange(len(group))
    step = 0
    while True:
        step += 1
        i = i[i + step < len(group)]
        i = i[group[i] == group[i + step]]
        if not len(i):
            return
        wanted = ~cross[i] | (side[i] != side[i + step]) | (side[i] < 0)
        yield i[wanted], i[wanted] + step


def _in_blocks(members: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each member under every pair of blocks that it belongs to.

    ``blocks`` is the number of blocks of the member's group. A group of one
    block stays as it is; a larger one becomes block pairs, so that no task gets
    more than two blocks of it and every two members meet once.
    """
    side = F.when(F.col(blocks) > 1, F.pmod(F.xxhash64("digest"), F.col(blocks))).otherwise(F.lit(0)).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    return (
        members.withColumn("side", side)
        .withColumn("other", other)
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
        .drop("other", blocks)
    )


def equal_bytes_of(threshold: float, recall: float = 0.9999) -> int:
    """Equal sketch bytes that a pair at the threshold has with probability ``recall``: a binomial tail."""
    tail = 0.0
    for k in range(SKETCH + 1):
        tail += math.comb(SKETCH, k) * threshold**k * (1 - threshold) ** (SKETCH - k)
        if tail > 1 - recall:
            return k
    return SKETCH


def _equal_bytes(a: pd.Series, b: pd.Series) -> pd.Series:
    left, right = (np.frombuffer(b"".join(x), dtype=np.uint8).reshape(-1, SKETCH) for x in (a, b))
    return pd.Series((left == right).sum(axis=1))


def _united(buckets: DataFrame, bands: int = 4) -> DataFrame:
    """Rows (bucket, digest) of large buckets, those that hold nearly the same sets made one.

    The buckets of many runs hold a large group of similar sets, or all sets with
    a frequent passage, over and over. Two of them are united if two MinHashes of
    what they hold are equal in one of the bands, over two steps from bucket to
    bucket. A whole bucket gets one name, so no two of its members are parted: a
    bucket that is larger than need be, or one left alone, only compares more.
    """
    least = [F.min(F.xxhash64("digest", F.lit(k))).alias(f"m{k}") for k in range(2 * bands)]
    signed = buckets.groupBy("bucket").agg(*least)
    keys = F.array(*[F.xxhash64(F.lit(k), f"m{2 * k}", f"m{2 * k + 1}") for k in range(bands)])
    signed = cut_lineage(signed.select("bucket", F.explode(keys).alias("key")), "signed")
    named = signed.select("bucket", F.col("bucket").alias("name"))
    for _ in range(2):
        # Every key takes the least name of its buckets, then every bucket that of its keys.
        of_key = signed.join(named, "bucket").groupBy("key").agg(F.min("name").alias("name"))
        named = signed.join(of_key, "key").groupBy("bucket").agg(F.min("name").alias("name"))
    found = buckets.join(named.withColumn("bucket", F.expr("bucket ^ 0L")), "bucket")
    return found.select(F.col("name").alias("bucket"), "digest").distinct()


def _consensus(frame: pd.DataFrame) -> pd.DataFrame:
    """For a sample of a bucket's rows the sketch of their most frequent bytes."""
    sketch = np.frombuffer(b"".join(frame["sketch"]), dtype=np.uint8).reshape(-1, SKETCH)
    own = bytes(int(np.bincount(column, minlength=256).argmax()) for column in sketch.T)
    return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "own": [own]})


def _pivoted(rows: DataFrame, least: int, rounds: int, sample: int = 64) -> tuple[DataFrame, DataFrame]:
    """Rows (bucket, digest, rows, sketch) of large buckets with ``open``, and links (a, b) that settle the others.

    Nearly equal sets stay together however they are split. In each round the
    most frequent sketch bytes of some open rows are their bucket's pivot: what
    is within ``SETTLED`` bytes of it is settled, and all that a settled row can
    be similar to is linked with the pivot, by the triangle inequality. So only
    pairs with an open row are left. The sample decides where a pivot is, not
    what is found.
    """
    reach = SKETCH - least + SETTLED
    alike = F.pandas_udf(_equal_bytes, "long")
    rows = cut_lineage(rows.withColumn("open", F.lit(True)), "pivoted")
    links = []
    for number in range(rounds):
        some = rows.where(F.col("open") & (uniform("digest", seed=100 + number) < sample / F.col("rows")))
        pivots = some.groupBy("bucket").applyInPandas(_consensus, "bucket long, own binary")
        compared = rows.join(pivots.withColumn("bucket", F.expr("bucket ^ 0L")), "bucket", "left")
        compared = compared.withColumn("different", F.lit(SKETCH) - alike("sketch", F.coalesce("own", "sketch")))
        compared = cut_lineage(compared.withColumn("known", F.col("own").isNotNull()).drop("own"), "pivoted")
        near = compared.where(F.col("known") & (F.col("different") <= reach))
        links.append(near.select(F.col("digest").alias("a"), F.xxhash64("bucket", F.lit(number)).alias("b")))
        settled = F.col("known") & (F.col("different") <= SETTLED)
        rows = compared.withColumn("open", F.col("open") & ~settled).drop("known", "different")
    return cut_lineage(rows, "pivoted"), reduce(DataFrame.unionByName, links)


def _against_open(rows: DataFrame, block_rows: int) -> DataFrame:
    """Large buckets with few open rows, dealt to blocks that each get all the open ones."""
    blocks = F.ceil(F.col("rows") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("digest"), blocks).cast("int")
    places = F.when(F.col("open"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    return (
        rows.withColumn("low", F.explode(places))
        .withColumn("high", F.lit(-1))
        .withColumn("side", F.when(F.col("open"), -1).otherwise(0))
        .select("bucket", "digest", "side", "low", "high")
    )


def _merged(root: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    a, b = (np.concatenate(x) for x in zip((np.arange(len(root)), root), *held, strict=True))
    return local_components(len(root), a, b)


def _proposed(members: DataFrame, threshold: float, least: int) -> DataFrame:
    """Links (a, b) between nodes of a bucket whose sketches have ``least`` equal bytes, enough to connect them all."""
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def propose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ["bucket", "low", "high"]
        for frame in _whole_groups(frames, key):
            group = frame.groupby(key, sort=False).ngroup().to_numpy()
            sketch = np.frombuffer(b"".join(frame["sketch"]), dtype=np.uint8).reshape(-1, SKETCH)
            n = frame["n"].to_numpy()
            # Root of each row; pairs are merged into it before many are held.
            root, held, many = np.arange(len(frame)), [], 0
            for i, j in _pairs(group, frame["side"].to_numpy(), (frame["low"] != frame["high"]).to_numpy()):
                near = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])
                i, j = i[near], j[near]
                alike = (sketch[i] == sketch[j]).sum(axis=1) >= least
                held.append((i[alike], j[alike]))
                many += int(alike.sum())
                if many > 1 << 18:
                    root, held, many = _merged(root, held), [], 0
            root = _merged(root, held)
            digests = frame["digest"].to_numpy()
            moved = root != np.arange(len(frame))
            yield pd.DataFrame({"a": digests[moved], "b": digests[root[moved]]}).drop_duplicates()

    return (
        members.repartition(tasks, "bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .select("bucket", "low", "high", "side", "digest", "n", "sketch")
        .mapInPandas(propose, "a long, b long")
    )


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of the intersections."""
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.zeros((len(sets), len(sets)))
    width = max(1024, (1 << 22) // len(sets))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, len(tokens), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), min(width, len(tokens) - start)), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += part @ part.T
    return out


def _verified(members: DataFrame, threshold: float, words: int) -> DataFrame:
    """Exact links of the members: per node its links to other documents, and links enough to connect it."""
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ["bucket", "low", "high"]
        for chunk in _whole_groups(frames, key, 512):
            out = {"digest": [], "links": [], "linked": []}
            for (_, low, high), rows in chunk.groupby(key, sort=False):
                frame = rows.drop_duplicates("digest")
                sets = [np.frombuffer(t, dtype=np.uint64) for t in frame["tokens"]]
                size, copies = np.array([len(s) for s in sets]), frame["copies"].to_numpy()
                common = _common(sets)
                linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
                np.fill_diagonal(linked, False)
                if low != high:
                    side = frame["side"].to_numpy()
                    linked &= side[:, None] != side[None, :]
                digests = frame["digest"].to_numpy()
                root = local_components(len(sets), *np.nonzero(np.triu(linked)))
                out["digest"] += digests.tolist()
                out["links"] += (linked @ copies).tolist()
                out["linked"] += digests[root].tolist()
            yield pd.DataFrame(out).astype({"digest": "int64", "links": "int64", "linked": "int64"})

    def tokens(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, digests in batches:
            sets = shingle_sets(texts, words)
            # Of rows that share an id but not a text, only the wanted one has the digest.
            yield pd.Series([s.tobytes() if _digest(s) == d else None for s, d in zip(sets, digests, strict=True)])

    # The filter would else compute the sets as well, in a second Python worker of every task.
    once = F.pandas_udf(tokens, "binary").asNondeterministic()
    return (
        members.withColumn("tokens", once("text", "digest"))
        .where("tokens is not null")
        .transform(lambda df: _in_blocks(df, "bucket", "blocks"))
        .repartition(tasks, "bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .select("bucket", "low", "high", "side", "digest", "copies", "tokens")
        .mapInPandas(verify, "digest long, links long, linked long")
    )


def similar_documents(
    docs: DataFrame,
    threshold: float = 0.8,
    words: int = 5,
    recall: float = 0.9999,
    bucket_rows: int = 1024,
    block_tokens: int = 1 << 20,
    pivots: int = 3,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row (doc_id, class_id, n_links) for every row of ``docs`` (doc_id, text).

    With ``carried``, columns of ``docs``, each row has these as well, and
    ``class_key``: equal for the rows of a class, NULL for a text without a word.

    ``n_links`` is the number of other rows whose shingle sets have a Jaccard
    similarity of ``threshold`` or more, copies included; ``class_id`` is the
    smallest doc_id that can be reached over such links, its own included. Every
    link that is counted is exact; one is missed with probability 1 - ``recall``
    at the most, and only if no chain of other proposals joins its ends.

    NULL texts and texts without a word have no links and are classes of their
    own. Repeated rows are copies. A NULL doc_id is never a class id while the
    class has another id. Buckets over ``bucket_rows`` that hold nearly the same
    sets are united, and the rows around a few pivots are settled. If few rows are then open, all are compared with
    these, in blocks. Else the bucket is split by a second token; one that
    doesn't split, and parts that stay larger, are compared in pairs of blocks.
    """
    # A link is lost by the runs, by the split of large buckets or by its sketches: each has a third of what may be.
    share = 1 - (1 - recall) / 3
    runs, least = runs_for(threshold, share), equal_bytes_of(threshold, share)
    described = cut_lineage(_described(docs, words, threshold, runs, runs, carried), "shingle-sets")
    nodes = (
        described.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min("text_key").alias("text_key"),
            F.count("*").alias("copies"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("root").alias("root"),
            F.first("deep").alias("deep"),
        )
    )
    nodes = cut_lineage(nodes, "shingle-nodes")

    def in_buckets(paths: DataFrame, wanted: str = "rows > 1") -> DataFrame:
        counted = [F.count("*").alias("rows")]
        if "open" in paths.columns:
            counted.append(F.sum(F.col("open").cast("long")).alias("open_rows"))
        sizes = paths.groupBy("bucket").agg(*counted).where(wanted)
        # As an expression, the key is shuffled again, and a busy bucket's partition can be split.
        return paths.join(sizes.withColumn("bucket", F.expr("bucket ^ 0L")), "bucket")

    sketches = nodes.select("digest", "n", "sketch")
    first = cut_lineage(in_buckets(nodes.select(F.explode("root").alias("bucket"), "digest")), "buckets")
    one_block = F.lit(1).cast("long").alias("blocks")
    members = _in_blocks(first.where(F.col("rows") <= bucket_rows).select("bucket", "digest", one_block), "bucket", "blocks")
    large = first.where(F.col("rows") > bucket_rows)
    links = None
    if large.limit(1).count():
        large = cut_lineage(in_buckets(_united(large.select("bucket", "digest"))), "large-buckets")
        rows, links = _pivoted(large.join(nodes.select("digest", "sketch"), "digest"), least, pivots)
        rows = cut_lineage(in_buckets(rows.select("bucket", "digest", "open"), "open_rows > 0"), "open-buckets")
        few = F.col("open_rows") <= bucket_rows // 2
        members = members.unionByName(_against_open(rows.where(few), bucket_rows // 2))
        wide = rows.where(~few).select("bucket", "digest", "open", F.col("rows").alias("whole"))
        split = wide.join(nodes.select("digest", F.explode("deep").alias("token")), "digest")
        split = split.select(F.xxhash64("bucket", "token").alias("part"), F.col("bucket").alias("whole_bucket"), "whole", "digest", "open")
        parts = in_buckets(split.withColumnRenamed("part", "bucket"), "rows > 1 and open_rows > 0")
        parts = cut_lineage(parts, "buckets")
        # Where a part has half of its bucket, splitting doesn't help: the bucket is compared as a whole.
        stuck = parts.where((F.col("rows") > bucket_rows) & (F.col("rows") * 2 >= F.col("whole")))
        stuck = cut_lineage(stuck.select(F.col("whole_bucket").alias("bucket")).distinct(), "stuck-buckets")
        blocks_of = F.ceil(F.col("rows") / bucket_rows).alias("blocks")
        parts = parts.join(stuck.withColumnRenamed("bucket", "whole_bucket"), "whole_bucket", "left_anti")
        whole = wide.withColumnRenamed("whole", "rows").join(stuck, "bucket", "left_semi")
        second = parts.select("bucket", "digest", blocks_of).unionByName(whole.select("bucket", "digest", blocks_of))
        members = members.unionByName(_in_blocks(second, "bucket", "blocks"))
    # Written, as the forests of the links would else hold a second Python worker beside each that proposes.
    proposed = cut_lineage(_proposed(members.join(sketches, "digest"), threshold, least), "proposals")
    groups = cut_lineage(connected(proposed if links is None else proposed.unionByName(links)), "proposed")

    sizes = groups.join(nodes.select(F.col("digest").alias("node"), "n", "copies"), "node")
    totals = sizes.groupBy("root").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    blocks = F.ceil(F.greatest(F.col("rows") / (bucket_rows // 2), F.col("tokens") / block_tokens))
    totals = totals.select(F.expr("root ^ 0L").alias("root"), blocks.alias("blocks"))
    placed = sizes.join(totals, "root").select(
        F.col("node").alias("digest"), F.col("root").alias("bucket"), "copies", "blocks"
    )
    # One document stands for each set: the one of the smallest id, the first of repeated rows.
    chosen = placed.join(
        described.select("digest", "doc_id").join(
            nodes.select(F.expr("digest ^ 0L").alias("digest"), F.col("least_id").alias("doc_id")), ["digest", "doc_id"]
        ).distinct(),
        "digest",
    )
    texts = docs.select("doc_id", "text").where("text is not null")
    candidates = texts.join(chosen, "doc_id").select(*chosen.drop("doc_id").columns, "text")
    # Sets that only rows without an id hold are found by their text; their copies collapse first.
    unnamed = texts.where("doc_id is null").select("text", _text_key().alias("text_key")).dropDuplicates(["text_key"])
    of_unnamed = nodes.where("least_id is null").select(F.expr("digest ^ 0L").alias("digest"), "text_key")
    keyed = placed.join(of_unnamed, "digest").join(unnamed, "text_key").select(*candidates.columns)
    candidates = candidates.unionByName(keyed).withColumn("own", F.lit(1))
    verified = cut_lineage(_verified(candidates, threshold, words), "verified")
    return _classes(described, nodes, verified, carried)


def _classes(described: DataFrame, nodes: DataFrame, verified: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    counts = verified.groupBy("digest").agg(F.sum("links").alias("links"))
    roots = connected(verified, "digest", "linked")
    linked = nodes.select("digest", "least_id", "copies").join(counts, "digest", "left").join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    linked = linked.select(
        "digest",
        "least_id",
        F.coalesce("root", "digest").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    least = linked.groupBy("root").agg(F.min("least_id").alias("class_id"))
    answers = linked.join(least.withColumn("root", F.expr("root ^ 0L")), "root").select(
        F.expr("digest ^ 0L").alias("digest"), F.col("root").alias("class_key"), "class_id", "n_links"
    )
    return described.select("doc_id", *carried, "digest").join(answers, "digest", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        *([*carried, "class_key"] if carried else []),
    )
