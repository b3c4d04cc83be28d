"""Mixing sources to target weights by hierarchical budgets.

A token budget goes down a tree of domains, their languages and their sources.
Every node shares its budget among its children in proportion to their weights,
but gives none more than it can fill with its tokens in the allowed number of
epochs. What one child can't fill goes to its siblings first; only what all of
them can't fill is left to the node's own siblings, as a node's capacity is that
of its children together. The shares are whole tokens and add up exactly.

Each source then gives the first tokens of a stream of epochs, every epoch being
its documents in an order of its own, drawn with a seed. Only the last epoch is
cut. The cut is found by summing tokens over ranges of the drawn numbers, twice,
so that no source is ever sorted as a whole.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage

LEVELS = ["domain", "lang", "source"]
#: Words, the unit of the budgets: runs of anything but ASCII white space.
WORD = r"[^ \t\n\r\f\x0B]+"
UNKNOWN = "unknown"
#: Bits of the drawn numbers, and of each of the two steps that narrow the cut down.
DRAWN_BITS, STEP_BITS = 60, 10


def described(docs: DataFrame, domain: str) -> DataFrame:
    """By the SQL expression ``domain``: doc_id, domain, lang, source and n_tokens of every row; NULL names are ``unknown``, a NULL text has no token."""
    return docs.select(
        "doc_id",
        F.coalesce(F.expr(domain), F.lit(UNKNOWN)).alias("domain"),
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"),
        F.coalesce("source", F.lit(UNKNOWN)).alias("source"),
        n_tokens("text").alias("n_tokens"),
    )


def n_tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(38,0)")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    """Weight of a node by its name; 1 for one that isn't named."""
    out = F.lit(1)
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """``children`` (name, weight, capacity, budget of their parent) with ``quota``.

    Children are filled in the order of capacity by weight: one whose fair share
    of what is left exceeds its capacity is full. The others share the rest;
    their bounds are rounded down on the running sum of weights, so that they
    add up to the rest.
    """
    by_ratio = Window.partitionBy(*parent).orderBy("ratio", "name")
    everyone = Window.partitionBy(*parent)
    by_name = Window.partitionBy(*parent).orderBy("full", "name")
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        children.withColumn("ratio", F.col("capacity").cast("double") / F.col("weight").cast("double"))
        .withColumn("weight_left", F.sum("weight").over(from_here))
        .withColumn("budget_left", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
        .withColumn("full", _exact("capacity") * _exact("weight_left") <= _exact("budget_left") * _exact("weight"))
    )
    rest = F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(everyone)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everyone)
    upto = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(by_name)
    bounds = filled.withColumns({"rest": rest, "open_weight": open_weight, "upto": upto})

    def bound(weight: Column) -> Column:
        return F.floor(_exact("rest") * _exact(weight) / F.greatest(F.col("open_weight"), F.lit(1)).cast("decimal(19,0)"))

    part = (bound(F.col("upto")) - bound(F.col("upto") - F.col("weight"))).cast("long")
    return bounds.withColumn("quota", F.when(F.col("full"), F.col("capacity")).otherwise(part)).drop(
        "ratio", "weight_left", "budget_left", "full", "rest", "open_weight", "upto"
    )


def quotas(
    rows: DataFrame, weights: dict[str, dict[str, int]], budget_permille: int = 1000, max_epochs: int = 4
) -> DataFrame:
    """Leaves (domain, lang, source, supply, quota) from rows with these names and n_tokens.

    The budget is ``budget_permille`` thousandths of all tokens. ``weights``
    gives whole weights by level and name, 1 where it is silent; a node of
    weight 0 gets nothing and its tokens don't count as capacity. If all
    capacity is below the budget, every leaf is filled. An empty table has no
    leaves. The tables here have a row per source, whatever the corpus.
    """
    everything = cut_lineage(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply")), "mix-supply")
    total = everything.agg(F.sum("supply")).collect()[0][0] or 0
    leaves = everything.withColumns({f"{level}_weight": _weight(level, weights) for level in LEVELS}).where(
        " and ".join([*(f"{level}_weight > 0" for level in LEVELS), "supply > 0"])
    )
    leaves = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    nodes = None
    for depth, level in enumerate(LEVELS):
        path, parent = LEVELS[: depth + 1], LEVELS[:depth]
        children = leaves.groupBy(*path).agg(
            F.sum("capacity").alias("capacity"), F.first(f"{level}_weight").alias("weight")
        )
        root = F.lit(total * int(budget_permille) // 1000).cast("long")
        joined = children.join(nodes, parent) if parent else children.withColumn("budget", root)
        shared = share_out(joined.withColumn("name", F.col(level)), parent or [F.lit(0)])
        nodes = shared.select(*path, F.col("quota").alias("budget"))
    found = leaves.select(*LEVELS, "supply").join(nodes, LEVELS).withColumnRenamed("budget", "quota")
    return cut_lineage(found, "mix-quotas")


def drawn(seed: int, epoch: Column | str, doc_id: str = "doc_id") -> Column:
    """The number that places a document in an epoch: 60 bits of an MD5 of seed, epoch and id."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col(epoch) if isinstance(epoch, str) else epoch, F.col(doc_id))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAWN_BITS // 4), 16, 10).cast("long")


def _crossed(sums: DataFrame, place: str) -> DataFrame:
    """Per leaf the place in which the running sum of tokens passes ``rest``, and the rest that is left for it."""
    before = Window.partitionBy(*LEVELS).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    hit = ahead.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("tokens")))
    return hit.withColumn("rest", F.col("rest") - F.col("before")).drop("before", "tokens")


def cuts(rows: DataFrame, leaves: DataFrame, seed: int = 0) -> DataFrame:
    """``leaves`` with ``epochs`` (whole ones) and where the last epoch is cut.

    Documents drawn below ``cut`` are taken whole, the one at ``cut`` with its
    first ``cut_tokens`` words. Rows that repeat an id are drawn together; at the
    cut they share what is left evenly, rounded down.
    """
    leaves = leaves.withColumn("epochs", F.expr("quota div supply")).withColumn("rest", F.expr("quota % supply"))
    last = rows.where("n_tokens > 0").join(leaves.where("rest > 0"), LEVELS)
    last = last.withColumn("drawn", drawn(seed, F.col("epochs") + 1)).select(*LEVELS, "drawn", "n_tokens", "rest")
    last = cut_lineage(last, "mix-drawn")
    shift = DRAWN_BITS
    steps: list[str] = []
    open_rows = last
    for number in (1, 2):
        shift -= STEP_BITS
        place = f"place{number}"
        ranges = open_rows.withColumn(place, F.shiftright("drawn", shift))
        sums = ranges.groupBy(*LEVELS, place, "rest").agg(F.sum("n_tokens").alias("tokens"))
        found = _crossed(sums, place)
        open_rows = ranges.drop("rest", *steps).join(found, [*LEVELS, place])
        steps = [place]
    ties = open_rows.groupBy(*LEVELS, "drawn", "rest").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")
    )
    at = _crossed(ties, "drawn").select(
        *LEVELS, F.col("drawn").alias("cut"), F.expr("rest div rows").alias("cut_tokens")
    )
    out = leaves.drop("rest").join(at, LEVELS, "left")
    return cut_lineage(
        out.withColumns({"cut": F.coalesce("cut", F.lit(0)), "cut_tokens": F.coalesce("cut_tokens", F.lit(0))}), "mix-cuts"
    )


def selected(rows: DataFrame, leaves: DataFrame, seed: int = 0) -> DataFrame:
    """``rows`` once for every epoch that takes them, with ``epoch`` (from 1) and ``take_tokens``.

    Rows need the names of the leaves, doc_id and n_tokens, and keep their other
    columns. Those without a token, or of a leaf without a quota, are in no
    epoch. Only the table of leaves is joined.
    """
    joined = rows.where("n_tokens > 0").join(leaves.drop("supply", "quota"), LEVELS)
    place = drawn(seed, F.col("epochs") + 1)
    last = F.when(place < F.col("cut"), F.col("n_tokens")).when(
        place == F.col("cut"), F.least("n_tokens", "cut_tokens")
    )
    partly = joined.withColumn("last_take", F.coalesce(last, F.lit(0)))
    number = F.col("epochs") + (F.col("last_take") > 0).cast("long")
    return (
        partly.where(number > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), number)))
        .withColumn("take_tokens", F.when(F.col("epoch") <= F.col("epochs"), F.col("n_tokens")).otherwise(F.col("last_take")))
        .drop("epochs", "cut", "cut_tokens", "last_take")
    )


def first_tokens(text: str, take: str) -> Column:
    """The text up to and with its word number ``take``."""
    words = F.split(F.col(text), r"(?<=[^ \t\n\r\f\x0B])(?=[ \t\n\r\f\x0B])")
    return F.array_join(F.slice(words, 1, F.col(take).cast("int")), "")
