"""How far the word use of each source of a language lies from the other sources' and from the language's.

A share depends only on how often a term occurs in a group, its count level. So
it suffices to know for two sources how many terms have level i in the one and
level j in the other: their joint table. Terms are cut into blocks; in a block
every (source, level) that occurs is an indicator column with a one for each
term that has it, and the columns' matrix times its transpose holds the joint
tables of all pairs of sources at once. Added up over the blocks, each cell is
priced once, whatever the number of terms in it.

The columns are those of levels above zero. What a level of zero adds follows
from the diagonal, which holds how many terms have a level: with f(i, j) the
price of a cell, a pair's sum over all V terms is the sum over cells of
n * (f(i,j) - f(i,0) - f(0,j) + f(0,0)), over levels of one source of
n * (f(i,0) - f(0,0)), of the other of n * (f(0,j) - f(0,0)), and V * f(0,0).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage

#: Letters of ASCII, lower-cased, and everything beyond ASCII, as UTF-8.
TERM = re.compile(rb"[a-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^a-z\x80-\xff]")
#: Bytes of a text that are split into terms at a time, and entries a task holds before it passes them on.
PIECE, MOST_HELD = 1 << 20, 400_000
#: Terms of a block, and indicator columns of one product.
MOST_TERMS, MOST_COLUMNS = 8192, 2048
#: Shares are counted in parts of this.
WHOLE = 1_000_000_000


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number at a time."""
    start = 0
    while start < len(data):
        end = NO_TERM.search(data, start + PIECE) if start + PIECE < len(data) else None
        stop = end.start() if end else len(data)
        yield TERM.findall(data, start, stop)
        start = stop


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in held.items():
            # The row without a term says that there is such a group.
            terms = [None, *occurrences]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([0, *occurrences.values()], pa.int64()),
                    pa.array([0, *map(documents.__getitem__, occurrences)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    entries = 0
    for batch in batches:
        for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            before, once = len(occurrences), set()
            for terms in _pieces(text.encode().lower()):
                occurrences.update(terms)
                once.update(terms)
            documents.update(once)
            entries += len(occurrences) - before
        if entries > MOST_HELD:
            yield from passed_on()
            entries = 0
    yield from passed_on()


def kept_terms(docs: DataFrame, least_docs: int = 3) -> DataFrame:
    """One row per language and term that occurs in ``least_docs`` of its documents: lang, term, n, sources.

    ``sources`` lists (source, n) where the term occurs. The row of a language
    whose term is NULL lists all of its sources. Counts are added up inside
    tasks first, so a frequent term crosses the shuffle once per task and source.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = named.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    per_source = (
        counted.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    per_term = per_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return per_term.where(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs")


def _cells(term: np.ndarray, source: np.ndarray, level: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells (source, level, source, level, terms) of the joint tables of a block's entries, the diagonal included."""
    levels, of_level = np.unique(level, return_inverse=True)
    columns, column = np.unique(source * len(levels) + of_level, return_inverse=True)
    rows = np.unique(term, return_inverse=True)[1]
    if len(columns) > MOST_COLUMNS and (terms := int(rows.max()) + 1) > 1:
        # Fewer terms have fewer levels.
        for half in (rows < terms // 2, rows >= terms // 2):
            yield from _cells(term[half], source[half], level[half])
        return

    def indicators(start: int) -> np.ndarray:
        # Sums of ones stay far below the numbers that single precision holds exactly.
        ones = np.zeros((int(rows.max()) + 1, min(MOST_COLUMNS, len(columns) - start)), dtype=np.float32)
        here = (column >= start) & (column < start + MOST_COLUMNS)
        ones[rows[here], column[here] - start] = 1
        return ones

    for first in range(0, len(columns), MOST_COLUMNS):
        left = indicators(first)
        for second in range(first, len(columns), MOST_COLUMNS):
            product = left.T @ (left if second == first else indicators(second))
            i, j = np.nonzero(product)
            upper = i + first <= j + second
            n = product[i[upper], j[upper]].astype(np.int64)
            a, b = columns[i[upper] + first], columns[j[upper] + second]
            yield a // len(levels), levels[a % len(levels)], b // len(levels), levels[b % len(levels)], n


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        sizes = np.asarray(lists.value_lengths())
        entries = lists.flatten()
        names, source = np.unique(np.asarray(entries.field(0).to_pylist(), dtype=object), return_inverse=True)
        level = np.asarray(entries.field(1))
        term = np.repeat(np.arange(len(sizes)), sizes)
        langs = np.asarray(batch.column(0).to_pylist(), dtype=object)
        borders = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1], True])
        for start, stop in zip(borders[:-1], borders[1:], strict=True):
            for first in range(start, stop, MOST_TERMS):
                here = slice(*np.searchsorted(term, [first, min(first + MOST_TERMS, stop)]))
                for a, i, b, j, n in _cells(term[here], source[here], level[here]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([langs[start]] * len(n), pa.string()),
                            pa.array(names[a], pa.string()),
                            pa.array(i, pa.int64()),
                            pa.array(names[b], pa.string()),
                            pa.array(j, pa.int64()),
                            pa.array(n, pa.int64()),
                        ],
                        names=["lang", "a", "i", "b", "j", "n"],
                    )


def joint_tables(terms: DataFrame) -> DataFrame:
    """How many terms have level ``i`` in source ``a`` and ``j`` in ``b``: lang, a, i, b, j, n.

    From rows of ``kept_terms``. ``a`` comes before ``b``; where they are one source, the
    row says how many of its terms have that level. Terms of like frequency go
    into one block, as they share their levels.
    """
    cells = (
        terms.where("term is not null")
        .sortWithinPartitions("lang", "n")
        .select("lang", "sources")
        .mapInArrow(_multiply, "lang string, a string, i long, b string, j long, n long")
    )
    return cells.groupBy("lang", "a", "i", "b", "j").agg(F.sum("n").alias("n"))


def _share(count: Column | str, below: str) -> Column:
    """1 + floor(WHOLE * (count + 1) / below), exact; NULL below zero terms."""
    count = F.col(count) if isinstance(count, str) else count
    above = F.lit(WHOLE).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"))
    return F.lit(1) + F.call_function("div", above, F.nullif(F.col(below), F.lit(0)).cast("decimal(20,0)"))


def _price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q).cast("decimal(38,0)")


def source_divergence(docs: DataFrame, least_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """Divergence of every (lang, source) from the other sources (part ``pair``) and the terms that it overuses
    (part ``term``, the first ``most_terms``): lang, source, part, item, value, rank.

    ``docs`` has text, lang and source; NULL is '' in each. A term is a run of
    ASCII letters, lower-cased, and characters beyond ASCII. Each language keeps
    the terms of at least ``least_docs`` documents. A group's share of a term is
    p = 1 + floor(10**9 * (count + 1) / (N + V)), and the price of p against q is
    floor((p - q)**2 / q). A source is compared with each other source over all
    kept terms, and a term's share in it with the share in the language, where
    it is above. Equal values rank by item. A group without kept terms has pairs
    (of value 0, where its language keeps none) but no terms; a language of one
    source has no pair. An empty table gives no rows, and repeated rows count each.
    """
    terms = cut_lineage(kept_terms(docs, least_docs), "divergence-terms")
    entries = terms.where("term is not null").select(
        "lang", "term", F.col("n").alias("lang_n"), F.explode("sources").alias("entry")
    ).select("lang", "term", "lang_n", "entry.source", "entry.n")
    sizes = terms.groupBy("lang").agg(F.count("term").alias("v"), F.sum("n").alias("lang_total"))
    groups = terms.where("term is null").select("lang", F.explode("sources.source").alias("source"))
    # A written table: the planner knows its bytes before it chooses a join.
    totals = cut_lineage(
        groups.join(entries.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(sizes, "lang")
        .select(
            "lang",
            "source",
            "v",
            (F.coalesce("total", F.lit(0)) + F.col("v")).alias("below"),
            (F.col("lang_total") + F.col("v")).alias("lang_below"),
        ),
        "divergence-groups",
    )

    p, q = _share("n", "below"), _share("lang_n", "lang_below")
    overused = (
        entries.join(totals, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", _price(F.col("p"), F.col("q")).alias("value"))
    )

    other = totals.select("lang", F.col("source").alias("item"), F.col("below").alias("item_below"))
    # As many rows as the result has.
    pairs = totals.join(other, "lang").where("source <> item").select("lang", "source", "item", "v", "below", "item_below")
    cells = cut_lineage(joint_tables(terms), "divergence-joint")
    levels = cells.where("a = b")
    joint = cells.where("a <> b")
    both = joint.select("lang", F.col("a").alias("source"), "i", F.col("b").alias("item"), "j", "n").unionByName(
        joint.select("lang", F.col("b").alias("source"), F.col("j").alias("i"), F.col("a").alias("item"), F.col("i").alias("j"), "n")
    )
    zero = F.lit(0)

    def f(i: Column, j: Column) -> Column:
        return _price(_share(i, "below"), _share(j, "item_below"))

    i, j, n = F.col("i"), F.col("j"), F.col("n")
    parts = [
        pairs.withColumn("value", F.col("v") * f(zero, zero)),
        pairs.join(levels.select("lang", F.col("a").alias("source"), "i", "n"), ["lang", "source"]).withColumn(
            "value", n * (f(i, zero) - f(zero, zero))
        ),
        pairs.join(levels.select("lang", F.col("a").alias("item"), "j", "n"), ["lang", "item"]).withColumn(
            "value", n * (f(zero, j) - f(zero, zero))
        ),
        both.join(pairs, ["lang", "source", "item"]).withColumn(
            "value", n * (f(i, j) - f(i, zero) - f(zero, j) + f(zero, zero))
        ),
    ]
    summed = parts[0].select("lang", "source", "item", F.col("value").cast("decimal(38,0)"))
    for part in parts[1:]:
        summed = summed.unionByName(part.select("lang", "source", "item", F.col("value").cast("decimal(38,0)")))
    compared = summed.groupBy("lang", "source", "item").agg(F.coalesce(F.sum("value"), zero).alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        compared.withColumn("rank", F.row_number().over(order))
        .unionByName(overused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_terms))
        .withColumn("value", F.col("value").cast("long"))
    )
