"""Language-model scores by prediction by partial matching, and a word baseline.

The model is a trie of byte contexts with the counts of what followed them in the
training texts. A byte is coded in its longest context if it was seen there;
otherwise an escape is coded, whose probability is estimated from the number of
different bytes seen (method D: half a count of each goes to the escape), and the next shorter context is tried without
the bytes that the longer one has already ruled out. As every byte seen in a
context was seen in its shorter ones too, the ruled-out counts belong to the
context and are summed up once, when the trie is made.

Whole batches of texts are scored at once: the bytes in their contexts that are
most frequent in the training texts are looked up in a hash table that every task
has. All others are joined with tables of the counts of each order, once for each
different one; only the shortest contexts, of which there are few, are a trie in
memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.llm.common import chunks_of
from crawlspark.llm.words import HashTable, lowered, word_hashes

#: Bytes of text handled at once.
BLOCK = 1 << 20
#: Different keys that a task holds before it passes on their counts.
MOST_KEYS = 1 << 20
#: Bytes of context up to which an order is held in memory, 2**16 grams at the most.
SHORT = 1


def grams(raw: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with its ``order`` bytes of context (zeros before a text), packed, and the texts' borders."""
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    pad = b"\0" * order
    data = np.frombuffer(pad + b"".join(r + pad for r in raw), dtype=np.uint8).astype(np.uint64)
    n = len(data) - order
    packed = np.zeros(n, dtype=np.uint64)
    for k in range(order + 1):
        packed = (packed << np.uint64(8)) | data[k : n + k]
    ends = np.cumsum(lengths + order)
    inside = np.ones(n, dtype=bool)
    for k in range(order):
        inside[ends - 1 - k] = False
    return packed[inside], np.r_[0, np.cumsum(lengths)]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(keys)
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    return ordered[first], np.diff(np.r_[first, len(ordered)])


@dataclass(frozen=True)
class Order:
    """Contexts of one length, what followed them, and what an escape from a longer one leaves."""

    grams: HashTable
    gram_n: np.ndarray
    contexts: HashTable
    total: np.ndarray  # bytes seen in the context
    distinct: np.ndarray  # different bytes seen in it
    left_total: np.ndarray  # of the next shorter context, without the bytes seen here
    left_distinct: np.ndarray


class ByteTrie:
    """Model from packed grams of ``order`` + 1 bytes and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        self.order = order
        self.orders: list[Order] = []
        shorter: tuple | None = None
        for length in range(order + 1):
            mask = np.uint64((1 << 8 * (length + 1)) - 1)
            gram, n = _summed(keys & mask, counts)
            context, owner, distinct = np.unique(gram >> np.uint64(8), return_inverse=True, return_counts=True)
            total = np.bincount(owner, weights=n, minlength=len(context))
            left_total = left_distinct = np.zeros(len(context))
            if shorter is not None:
                lower = shorter
                outer = np.uint64((1 << 8 * length) - 1)
                parent = lower.contexts.find(context & (outer >> np.uint64(8)))
                seen = np.bincount(owner, weights=lower.gram_n[lower.grams.find(gram & outer)], minlength=len(context))
                left_total = lower.total[parent] - seen
                left_distinct = lower.distinct[parent] - distinct
            shorter = Order(
                HashTable.of(gram), n.astype(float), HashTable.of(context), total, distinct, left_total, left_distinct
            )
            self.orders.append(shorter)

    def log10(
        self, packed: np.ndarray, total: np.ndarray | None = None, left: np.ndarray | None = None
    ) -> np.ndarray:
        """log10 of the probability of each byte given the bytes before it.

        ``total`` and ``left`` are what the longest context here has left where a
        still longer one has ruled out bytes, and NaN elsewhere.
        """
        out = np.zeros(len(packed))
        at = np.arange(len(packed))
        for length in range(self.order, -1, -1):
            order = self.orders[length]
            mask = np.uint64((1 << 8 * (length + 1)) - 1)
            keys = packed[at] & mask
            found = order.grams.find(keys)
            if total is None:
                total, left = np.full(len(at), np.nan), np.full(len(at), np.nan)
            hit = found >= 0
            # A byte that was seen: its context is known.
            known = np.full(len(at), -1, dtype=np.int64)
            plain = np.isnan(total)
            need = plain | ~hit
            known[need] = order.contexts.find(keys[need] >> np.uint64(8))
            here = plain & (known >= 0)
            total[here], left[here] = order.total[known[here]], order.distinct[known[here]]
            out[at[hit]] += np.log10((order.gram_n[found[hit]] - 0.5) / total[hit])
            miss = ~hit
            escaped = miss & (total > 0)
            out[at[escaped]] += np.log10(0.5 * left[escaped] / total[escaped])
            at, known = at[miss], known[miss]
            seen = known >= 0
            total, left = np.full(len(at), np.nan), np.full(len(at), np.nan)
            if length:
                total[seen], left[seen] = order.left_total[known[seen]], order.left_distinct[known[seen]]
            if not len(at):
                return out
        root = self.orders[0].distinct
        out[at] -= np.log10(256 - (root[0] if len(root) else 0))
        return out


@dataclass(frozen=True)
class TrieCounts:
    """What a trie is made of: packed grams and their counts.

    The tables are made where texts are scored: that takes a few times the room of
    the counts, and a second or two of each worker.
    """

    name: str
    keys: np.ndarray
    counts: np.ndarray
    order: int

    def trie(self) -> ByteTrie:
        """The trie; a worker keeps the last one."""
        if self.name not in _LAST_TRIE:
            _LAST_TRIE.clear()
            _LAST_TRIE[self.name] = ByteTrie(self.keys, self.counts, self.order)
        return _LAST_TRIE[self.name]


_LAST_TRIE: dict[str, ByteTrie] = {}
_LAST_HEAD: dict[str, HashTable] = {}


def _head_table(name: str, keys: np.ndarray) -> HashTable:
    """A table of the keys; a worker keeps the last one."""
    if name not in _LAST_HEAD:
        _LAST_HEAD.clear()
        _LAST_HEAD[name] = HashTable.of(keys)
    return _LAST_HEAD[name]


def _flushed(batches: Iterator[pa.RecordBatch], keys_of) -> Iterator[pa.RecordBatch]:
    """Counts of keys, passed on whenever many different ones are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def batch(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    for given in batches:
        raw = [lowered(t) for t in given.column("text").to_pylist()]
        for start, stop in chunks_of([len(r) for r in raw], BLOCK):
            keys, n = _counted(keys_of(raw[start:stop]))
            held.append((keys, n))
            size += len(keys)
            if size > MOST_KEYS:
                keys, n = _summed(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [(keys, n)], len(keys)
                if size > MOST_KEYS // 2:
                    yield batch(keys, n)
                    held, size = [], 0
    if held:
        yield batch(*_summed(*map(np.concatenate, zip(*held, strict=True))))


def _most_frequent(totals: DataFrame, most: int, value: str = "n") -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the most frequent rows (key, n), at most ``most``; rows of one count come all or not at all.

    The least count is found from a table of counts, so that no task passes on
    more than what is kept.
    """
    # Counts in steps of a sixteenth of their power of two: a bounded table, whatever the corpus.
    step = F.floor(F.log2("n") * 16)
    sizes = totals.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    kept, least = 0, None
    for row in sizes:
        if kept + row["rows"] > most:
            break
        kept, least = kept + row["rows"], row["step"]
    chosen = totals.where(step >= least) if least is not None else totals.limit(0)
    # As Arrow columns, whatever the session says: a million row objects would fill the driver.
    table = chosen.select("key", F.col(value).alias("value")).toArrow()
    keys, values = table.column("key").to_numpy().astype(np.int64), table.column("value").to_numpy()
    order = np.argsort(keys, kind="stable")
    return keys[order].view(np.uint64), values[order]


def word_counts(train: DataFrame) -> DataFrame:
    """Columns ``key`` (64-bit hash of a word) and ``n`` over all texts of ``train``."""
    counted = train.select("text").mapInArrow(
        lambda batches: _flushed(batches, lambda raw: word_hashes(raw)[0]), "key long, n long"
    )
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def gram_counts(train: DataFrame, order: int) -> DataFrame:
    """Columns ``key`` (packed gram of ``order`` + 1 bytes) and ``n`` over all texts of ``train``, written."""
    counted = train.select("text").mapInArrow(
        lambda batches: _flushed(batches, lambda raw: grams(raw, order)[0]), "key long, n long"
    )
    return cut_lineage(counted.groupBy("key").agg(F.sum("n").alias("n")), "ppm-grams")


def fit_trie(train: DataFrame, order: int = 5, most_grams: int = 1 << 20) -> TrieCounts:
    """Counts of a trie over all texts of ``train``, of ``order`` bytes of context at the most.

    A model of bounded size: beyond ``most_grams`` different grams the rare ones
    are left out, all those of a count alike. ``score`` uses ``fit_tables``, which leaves out none.
    """
    return TrieCounts(uuid.uuid4().hex, *_most_frequent(gram_counts(train, order), most_grams), order)


def _lowest(column: Column | str, n: int) -> Column:
    """The last ``n`` bytes of packed ones."""
    column = F.col(column) if isinstance(column, str) else column
    return column.bitwiseAND(F.lit((1 << 8 * n) - 1 if n < 8 else -1).cast("long"))


def _context(gram: Column | str) -> Column:
    return F.shiftrightunsigned(gram, 8)


@dataclass(frozen=True)
class Tables:
    """Counts of all grams of the training texts: tables of the long orders, a trie of the short ones."""

    order: int
    grams: dict[int, DataFrame]  # by bytes of context: key, n
    contexts: dict[int, DataFrame]  # context, total, distinct, left_total, left_distinct
    logs: DataFrame  # of the longest grams: key, n, log
    short: TrieCounts


def fit_tables(train: DataFrame, order: int = 5) -> Tables:
    """Counts of every order over all texts of ``train``, of ``order`` bytes of context at the most."""
    counted = {order: gram_counts(train, order)}
    for length in range(order - 1, -1, -1):
        shorter = counted[length + 1].groupBy(_lowest("key", length + 1).alias("key")).agg(F.sum("n").alias("n"))
        counted[length] = cut_lineage(shorter, "ppm-grams") if length >= min(order, SHORT) else shorter
    short = min(order, SHORT)
    # All of them: there are 2**16 at the most.
    held = counted[short].select("key", "n").toArrow()
    keys, n = (held.column(name).to_numpy().astype(np.int64) for name in ("key", "n"))
    trie = TrieCounts(uuid.uuid4().hex, keys.view(np.uint64), n, short)
    sums = [F.sum("n").alias("total"), F.count("*").alias("distinct")]
    contexts = {short: counted[short].groupBy(_context("key").alias("context")).agg(*sums)}
    for length in range(short + 1, order + 1):
        lower = counted[length - 1].select(F.col("key").alias("inner"), F.col("n").alias("lower_n"))
        # Each gram has its shorter one.
        both = counted[length].withColumn("inner", _lowest("key", length)).join(lower, "inner")
        own = both.groupBy(_context("key").alias("context")).agg(*sums, F.sum("lower_n").alias("seen"))
        parent = contexts[length - 1].select(
            F.col("context").alias("parent"), F.col("total").alias("whole"), F.col("distinct").alias("kinds")
        )
        left = own.withColumn("parent", _lowest("context", length - 1)).join(parent, "parent").select(
            "context",
            "total",
            "distinct",
            (F.col("whole") - F.col("seen")).alias("left_total"),
            (F.col("kinds") - F.col("distinct")).alias("left_distinct"),
        )
        contexts[length] = cut_lineage(left, "ppm-contexts")
    seen = counted[order].withColumn("context", _context("key"))
    logs = seen.join(contexts[order].select("context", "total"), "context").select(
        "key", "n", F.log10((F.col("n") - 0.5) / F.col("total")).alias("log")
    )
    return Tables(order, counted, contexts, cut_lineage(logs, "ppm-logs"), trie)


def resolved(keys: DataFrame, tables: Tables) -> DataFrame:
    """Columns ``key`` and ``log``, the log10 probability, for distinct packed grams ``key``."""
    short = tables.short.order
    nothing = F.lit(None).cast("double")
    # ``total`` and ``left`` are what the context has left where a longer one has ruled out bytes.
    state = keys.select("key", F.lit(0.0).alias("log"), F.lit(False).alias("done"), nothing.alias("total"), nothing.alias("left"))
    for length in range(tables.order, short, -1):
        contexts = tables.contexts[length].select(
            F.expr("context ^ 0L").alias("context"), F.col("total").alias("c_total"), "distinct", "left_total", "left_distinct"
        )
        counts = tables.grams[length].select(F.expr("key ^ 0L").alias("gram"), "n")
        state = state.withColumn("gram", _lowest("key", length + 1)).withColumn("context", _context("gram"))
        state = state.join(counts, "gram", "left").join(contexts, "context", "left")
        state = state.withColumn("whole", F.coalesce("total", F.col("c_total").cast("double")))
        state = state.withColumn("kinds", F.coalesce("left", F.col("distinct").cast("double")))
        coded = F.log10((F.col("n") - 0.5) / F.col("whole"))
        escape = F.when(F.col("whole") > 0, F.log10(0.5 * F.col("kinds") / F.col("whole"))).otherwise(0.0)
        state = state.select(
            "key",
            F.when(F.col("done"), F.col("log")).when(F.col("n").isNotNull(), F.col("log") + coded).otherwise(F.col("log") + escape).alias("log"),
            (F.col("done") | F.col("n").isNotNull()).alias("done"),
            F.col("left_total").cast("double").alias("total"),
            F.col("left_distinct").cast("double").alias("left"),
        )
    shared = keys.sparkSession.sparkContext.broadcast(tables.short)

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = shared.value.trie()
        for frame in frames:
            log, to_do = frame["log"].to_numpy(dtype=float, copy=True), ~frame["done"].to_numpy(dtype=bool)
            some = frame[to_do]
            log[to_do] += trie.log10(
                some["key"].to_numpy(dtype=np.int64).view(np.uint64),
                some["total"].to_numpy(dtype=float, copy=True),
                some["left"].to_numpy(dtype=float, copy=True),
            )
            yield pd.DataFrame({"key": frame["key"], "log": log})

    return state.mapInPandas(finish, "key long, log double")


def _listed(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each of ``n`` owners its distinct keys, and how often it has each."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]) if len(keys) else np.empty(0, np.int64)
    times = np.diff(np.r_[first, len(keys)])
    cuts = np.searchsorted(owner[first], np.arange(n + 1))
    return tuple([x[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for x in (keys[first].view(np.int64), times))


def score(docs: DataFrame, train: Column, order: int = 5, most_grams: int = 1 << 20, head_words: int = 1 << 18) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by models of the rows that ``train`` is true for.

    Columns: doc_id, n_tokens (words and one end), n_known (those that occur in
    the training tokens), train_tokens, base_score (log10 probability by smoothed
    word frequencies) and score (log10 probability of the bytes by the trie). A-Z
    is lower-cased for both; words are runs of anything but ASCII white space,
    identified by a 64-bit hash. A NULL text is empty: one end, score 0. Each
    row of a repeated doc_id is scored by itself. Without training rows the
    base score is 0 and every byte has probability 1/256.

    The most frequent words and grams, up to ``head_words`` and ``most_grams``, go
    to every task; the others of each text are joined with the tables of all
    counts. The sizes of the heads change no score.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))
    counts = cut_lineage(word_counts(rows.where("train")), "word-counts")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()[0]
    ends = rows.where("train").count()
    total = (sums["n"] or 0) + ends
    vocabulary = sums["v"] + (ends > 0)
    head_keys, head_n = _most_frequent(counts, head_words)
    below = total + 0.5 * (vocabulary + 1)
    tables = fit_tables(rows.where("train"), order)
    gram_head = _most_frequent(tables.logs, most_grams, "log")
    name = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((head_keys, np.log10((head_n + 0.5) / below), *gram_head))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, gram_keys, gram_logs = shared.value
        table, gram_table = HashTable.of(keys), _head_table(name, gram_keys)
        for given in batches:
            raw = [lowered(t) for t in given.column("text").to_pylist()]
            out = {"words": [], "known": [], "sum": [], "score": [], "rare": [], "grams": [], "times": []}
            for start, stop in chunks_of([len(r) for r in raw], BLOCK):
                part = raw[start:stop]
                hashes, at = word_hashes(part)
                found = table.find(hashes)
                owner = np.repeat(np.arange(len(part)), np.diff(at))
                known = found >= 0
                out["words"] += np.diff(at).tolist()
                out["known"] += np.bincount(owner[known], minlength=len(part)).tolist()
                out["sum"] += np.bincount(owner[known], weights=logs[found[known]], minlength=len(part)).tolist()
                packed, borders = grams(part, order)
                found = gram_table.find(packed)
                owner_of = np.repeat(np.arange(len(part)), np.diff(borders))
                here = found >= 0
                out["score"] += np.bincount(owner_of[here], weights=gram_logs[found[here]], minlength=len(part)).tolist()
                for field, lists in zip(("grams", "times"), _listed(packed[~here], owner_of[~here], len(part)), strict=True):
                    out[field] += lists
                rare, rare_owner = hashes[~known].view(np.int64), owner[~known]
                cuts = np.searchsorted(rare_owner, np.arange(len(part) + 1))
                out["rare"] += [rare[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    given.column("doc_id"),
                    pa.array(out["words"], pa.int64()),
                    pa.array(out["known"], pa.int64()),
                    pa.array(out["sum"], pa.float64()),
                    pa.array(out["score"], pa.float64()),
                    *[pa.array(out[field], pa.list_(pa.int64())) for field in ("rare", "grams", "times")],
                ],
                names=["doc_id", *out],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    rated = rows.select("doc_id", "text").mapInArrow(
        rate,
        f"doc_id {kind}, words long, known long, sum double, score double, "
        "rare array<long>, grams array<long>, times array<long>",
    )
    # Written once with a number for each row, as ids may be NULL or repeated.
    rated = cut_lineage(rated.withColumn("row", F.monotonically_increasing_id()), "ppm-scores")
    log_of = F.log10((F.col("n") + 0.5) / F.lit(below))
    rare = rated.select("row", F.explode("rare").alias("key"))
    tail = rare.join(counts, "key", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), log_of).otherwise(F.log10(F.lit(0.5) / F.lit(below)))).alias("tail_sum"),
        F.count("n").alias("tail_known"),
    )
    unlisted = rated.select("row", F.explode(F.arrays_zip("grams", "times")).alias("g"))
    unlisted = unlisted.select("row", F.col("g.grams").alias("key"), "g.times")
    # Grams of the training texts first; only those that none of these has need escapes.
    unlisted = cut_lineage(unlisted.join(tables.logs.select("key", "log"), "key", "left"), "ppm-unlisted")
    unseen = unlisted.where("log is null")
    found = cut_lineage(resolved(unseen.select("key").distinct(), tables), "ppm-resolved")
    found = unseen.drop("log").join(found.select(F.expr("key ^ 0L").alias("key"), "log"), "key")
    logs = unlisted.where("log is not null").select("row", "times", "log").unionByName(found.select("row", "times", "log"))
    rest = logs.groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("rest"))
    end = F.log10(F.lit(ends + 0.5) / F.lit(below)) if total else F.lit(0.0)
    nothing = F.lit(0)
    return rated.drop("rare", "grams", "times").join(tail, "row", "left").join(rest, "row", "left").select(
        "doc_id",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("tail_known", nothing) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("sum") + F.coalesce("tail_sum", F.lit(0.0)) + end).alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )
