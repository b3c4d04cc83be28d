"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A sketch is dealt to parts by the digests' low bits, and a part has three tables
of cells. Each digest of a text's paragraphs is added to one cell of every
table; a cell keeps the number of digests, and the XOR of the digests and of a
check number of each. Sketches of two versions subtract cell by cell: what both
contain is gone, and a cell that one digest is left in (its check number fits)
tells that digest, which is then taken out of its other cells too. Peeling goes
on, table by table, until all cells are empty, and so recovers the digests in
which the versions differ. If cells are left over in a part, its tables were too
small, and it is tried again with larger ones.

Only DataFrame operations are used. Cells are summed where a document's digests
lie, and a part is peeled inside its row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.functions.binding import let
from crawlspark.lineage import cut_lineage, cut_lineage_dealt
from crawlspark.operators.ordered import previous_value

TABLES = 3
#: Cells of each table at first, and how many times as many each further attempt has.
WIDTH, GROWTH = 16, 4
#: Digests that a part is meant for.
PART = 16
#: Turns in which one of the three tables is peeled, before a part counts as failed.
TURNS = 15
#: Where paragraphs end: at line ends, and within a line after a sentence.
PARAGRAPH_END = r"\n+|(?<=[.!?]) +"


def digests(text: Column) -> Column:
    """64-bit digests of the distinct paragraphs of a text."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def parts_for(count: Column) -> Column:
    """Parts for so many digests: a power of two, so that a finer sketch folds to a coarser one."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(count, F.lit(PART)) / PART))).cast("long")


def _place(table: Column, key: Column, width: int) -> Column:
    return F.pmod(F.xxhash64(key, table.cast("int")), F.lit(width)).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(97))


def sketched(sets: DataFrame, by: list[str], width: int = WIDTH) -> DataFrame:
    """Cells (slot, n, key, check) that aren't empty by ``by`` and ``part``.

    ``sets`` has the array ``digests``, its ``sign`` and the number of ``parts``.
    Slots count through the tables. Rows of one ``by`` have to lie in one partition.
    """
    each = sets.select(*by, "parts", "sign", F.explode("digests").alias("key"))
    slots = F.array(*[_place(F.lit(t), F.col("key"), width) + t * width for t in range(TABLES)])
    part = F.pmod("key", "parts").alias("part")
    cells = each.select(*by, part, "sign", "key", _check(F.col("key")).alias("check"), F.explode(slots).alias("slot"))
    summed = cells.groupBy(*by, "part", "slot").agg(
        F.sum("sign").cast("long").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check")
    )
    return summed.where("n != 0 or key != 0 or check != 0")


def peeled(cells: DataFrame, by: list[str], width: int = WIDTH, turns: int = TURNS) -> DataFrame:
    """Parts with ``found``, the digests that peeling recovers, and whether cells are ``left``."""

    listed = cells.groupBy(*by, "part").agg(F.collect_list(F.struct("slot", "n", "key", "check")).alias("cells"))
    numbers = F.sequence(F.lit(0), F.lit(TABLES - 1))
    tables = F.transform(
        numbers, lambda t: F.filter("cells", lambda c: (c["slot"] >= t * width) & (c["slot"] < (t + 1) * width))
    )

    def slot_of(table: Column, key: Column) -> Column:
        return _place(table, key, width) + table * width

    def pure(c: Column, table: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])) & (slot_of(table, c["key"]) == c["slot"])

    def without(c: Column, other: Column) -> Column:
        return F.struct(
            c["slot"].alias("slot"),
            (c["n"] - other["n"]).alias("n"),
            c["key"].bitwiseXOR(other["key"]).alias("key"),
            c["check"].bitwiseXOR(other["check"]).alias("check"),
        )

    def in_use(c: Column) -> Column:
        return (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0)

    def turn(state: Column, number: Column) -> Column:
        # A digest has one cell in a table, so none is recovered twice.
        table = F.pmod(number, F.lit(TABLES))

        def taken_out(found: Column) -> Column:
            def emptied(cells: Column, other: Column) -> Column:
                # The slots of the found digests are computed once, not for every cell that looks for them.
                placed = F.transform(
                    found,
                    lambda p: F.struct(
                        slot_of(other, p["key"]).alias("slot"),
                        p["n"].alias("n"),
                        p["key"].alias("key"),
                        p["check"].alias("check"),
                    ),
                )

                def left(moved: Column) -> Column:
                    here = F.transform(
                        cells, lambda c: F.aggregate(F.filter(moved, lambda p: p["slot"] == c["slot"]), c, without)
                    )
                    return F.filter(here, in_use)

                # The pure cells hold nothing else than what was found.
                rest = F.filter(cells, lambda c: ~pure(c, table))
                return F.when(F.size(cells) == 0, cells).when(other == table, rest).otherwise(let(placed, left))

            new = F.struct(
                F.transform(state["tables"], emptied).alias("tables"),
                F.concat(state["found"], F.transform(found, lambda p: p["key"])).alias("found"),
                F.lit(0).alias("idle"),
            )
            idle = F.struct(state["tables"].alias("tables"), state["found"].alias("found"), (state["idle"] + 1).alias("idle"))
            return F.when(F.size(found) == 0, idle).otherwise(new)

        found = F.filter(F.get(state["tables"], table), lambda c: pure(c, table))
        # Where none of the tables had a pure cell, no later turn finds one.
        return F.when(state["idle"] >= TABLES, state).otherwise(let(found, taken_out))

    start = F.struct(tables.alias("tables"), F.array().cast("array<bigint>").alias("found"), F.lit(0).alias("idle"))
    end = listed.select(*by, "part", F.aggregate(F.sequence(F.lit(0), F.lit(turns - 1)), start, turn).alias("end"))
    left = F.exists("end.tables", lambda cells: F.size(cells) > 0)
    return end.select(*by, "part", F.col("end.found").alias("found"), left.alias("left"))


def compared(pairs: DataFrame, by: list[str], dealt: bool = False) -> DataFrame:
    """Rows of ``by`` with ``differing``: in how many digests the arrays ``a`` and ``b`` differ, from their sketches.

    The number of parts follows from both numbers of digests. Parts that can't be
    peeled are sketched again, with more cells each time; only their digests go on.
    A pair has to be unique by ``by``. ``dealt`` tells that ``pairs`` lies by the
    first column of ``by``, as from ``cut_lineage_dealt``, and needs no shuffle.
    """
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = F.explode(
        F.array(
            F.struct(F.lit(1).alias("sign"), F.col("a").alias("digests")),
            F.struct(F.lit(-1).alias("sign"), F.col("b").alias("digests")),
        )
    )
    waiting = pairs.select(*by, parts_for(F.size("a") + F.size("b")).alias("parts"), "a", "b")
    width, rounds = WIDTH, []
    while True:
        # The parts come from these partitions, and go back to their pair without being dealt out again.
        if not (dealt and width == WIDTH):
            waiting = waiting.repartition(tasks, by[0])
        sets = waiting.select(*by, "parts", sides.alias("s")).select(*by, "parts", "s.*")
        found = F.when(~F.col("left"), F.size("found"))
        result = peeled(sketched(sets, by, width), by, width).groupBy(*by).agg(
            F.coalesce(F.sum(found), F.lit(0)).alias("differing"),
            F.collect_set(F.when(F.col("left"), F.col("part"))).alias("failed"),
        )

        # A join by more columns than the rows are dealt by would shuffle them.
        listed = result.groupBy(by[0]).agg(F.collect_list(F.struct(*by[1:], "differing", "failed")).alias("results"))

        def of_pair(r: Column) -> Column:
            return reduce(Column.__and__, (r[c] == F.col(c) for c in by[1:]), F.lit(True))

        def of_failed(digest: Column) -> Column:
            return F.array_contains("r.failed", F.pmod(digest, F.col("parts")))

        joined = waiting.join(listed, by[0]).withColumn("r", F.get(F.filter("results", of_pair), F.lit(0)))
        kept = [F.when(F.size("r.failed") > 0, F.filter(c, of_failed)).alias(c) for c in ("a", "b")]
        joined = joined.where("r is not null").select(*by, "parts", "r.differing", *kept)
        result = cut_lineage(joined, "sketch-peeled")
        rounds.append(result.select(*by, "differing"))
        waiting = result.where("a is not null").select(*by, "parts", "a", "b")
        if not waiting.limit(1).count():
            break
        width *= GROWTH
    total = reduce(DataFrame.unionByName, rounds).groupBy(*by).agg(F.sum("differing").alias("differing"))
    # Equal texts leave no cell at all.
    return pairs.select(*by).join(total, by, "left").withColumn("differing", F.coalesce("differing", F.lit(0)))


def likeness(differing: Column, a: Column, b: Column) -> Column:
    """Share of both texts' digests that they have in common; 1 for two texts without any."""
    total = a + b
    return F.when(total == 0, 1.0).otherwise((total - differing) / total)


def fingerprints(versions: DataFrame, by: list[str], dealt: bool = False) -> DataFrame:
    """Rows of ``by`` with ``fingerprint``: the sketch of the array ``digests`` as text.

    The number of digests, which tells the parts, then every cell in use: its part and slot,
    how many digests it holds, and their XORs in hexadecimal. ``dealt`` tells that
    ``versions`` lies by the first column of ``by``, as for ``compared``.
    """
    tasks = int(versions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = versions.select(*by, parts_for(F.size("digests")).alias("parts"), F.lit(1).alias("sign"), "digests")
    cells = sketched(sets if dealt else sets.repartition(tasks, by[0]), by)
    check = F.lower(F.lpad(F.hex(F.expr("check & 4294967295L")), 8, "0"))
    cell = F.struct("part", "slot", F.concat_ws(".", "part", "slot", "n", F.lower(F.hex("key")), check).alias("text"))
    listed = cells.groupBy(*by).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list(cell)), lambda c: c["text"])).alias("cells"),
        (F.sum("n") / TABLES).cast("long").alias("count"),
    )
    return listed.select(*by, F.concat_ws(":", "count", "cells").alias("fingerprint"))


NO_PARAGRAPH = "0:"


def edited_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Written table of every distinct row, its text's edit, and the digests of the texts.

    The edit replaces the last third of the code points, rounded down, by the
    first as many of the next document in descending id; after the last comes
    the first. Rows of one id are ordered by a hash of their text; NULL ids come
    last. The table lies by node. Columns: node, doc_id, copies, n_chars,
    edited_sha256, own, edited, next.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.xxhash64("doc_id", "text"))
    narrow = rows.select("doc_id", "node", F.length("text").alias("n_chars"))
    narrow = cut_lineage(narrow.groupBy("doc_id", "node", "n_chars").agg(F.count("*").alias("copies")), "sketch-documents")
    top = narrow.orderBy(F.desc_nulls_last("doc_id"), F.desc("node")).select("node").limit(1).collect()
    first = F.lit(top[0]["node"] if top else None).cast("long")
    # The next one in descending order is the one before in ascending order.
    linked = previous_value(narrow.withColumn("all", F.lit(0)), "all", ["doc_id", "node"], "node")
    links = cut_lineage(
        linked.select("doc_id", "node", "copies", "n_chars", F.coalesce("previous", first).alias("next_node")), "sketch-links"
    )
    once = Window.partitionBy("node").orderBy("node")
    texts = rows.select("node", "text").withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    heads = texts.withColumnRenamed("node", "next_node").join(links.select("node", "next_node", "n_chars"), "next_node")
    heads = heads.select(
        "node", F.substring("text", F.lit(1), third).alias("head"), digests(F.col("text")).alias("next")
    )
    edit = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - third), F.col("head"))
    # A merge join leaves the rows by node, as they are written.
    both = texts.join(heads.hint("merge"), "node").join(links.drop("next_node"), "node").withColumn("edit", edit)
    return cut_lineage_dealt(
        both.select(
            "node",
            "doc_id",
            "copies",
            F.col("n_chars").cast("long").alias("n_chars"),
            F.sha2("edit", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"),
            digests(F.col("edit")).alias("edited"),
            "next",
        ),
        "sketch-edits",
        "node",
    )


def document_sketches(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text), with its fingerprint and its edit's.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next, the likeness of the text's sketch to its edit's
    and to the next document's. A NULL text is empty. Equal texts have equal
    fingerprints; repeated rows are one document and give equal rows. An empty
    table gives none.
    """
    table = edited_documents(docs)
    kinds = F.explode(
        F.array(
            F.struct(F.lit("edited").alias("pair"), F.col("own").alias("a"), F.col("edited").alias("b")),
            F.struct(F.lit("next").alias("pair"), F.col("own").alias("a"), F.col("next").alias("b")),
        )
    )
    pairs = table.select("node", kinds.alias("p")).select("node", "p.*")
    near = compared(pairs, ["node", "pair"], dealt=True)
    near = near.groupBy("node").agg(
        *(F.max(F.when(F.col("pair") == name, F.col("differing"))).alias(name + "_differing") for name in ("edited", "next"))
    )
    versions = F.explode(
        F.array(
            F.struct(F.lit("own").alias("version"), F.col("own").alias("digests")),
            F.struct(F.lit("edited").alias("version"), F.col("edited").alias("digests")),
        )
    )
    versions = table.select("node", versions.alias("v")).select("node", "v.*")
    prints = fingerprints(versions, ["node", "version"], dealt=True)
    prints = prints.groupBy("node").agg(
        *(F.max(F.when(F.col("version") == name, F.col("fingerprint"))).alias(name + "_print") for name in ("own", "edited"))
    )
    sized = table.select(
        "node", "doc_id", "copies", "n_chars", "edited_sha256", *(F.size(c).alias("n_" + c) for c in ("own", "edited", "next"))
    )
    joined = sized.join(prints, "node", "left").join(near, "node")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.coalesce("own_print", F.lit(NO_PARAGRAPH)).alias("fingerprint"),
        F.coalesce("edited_print", F.lit(NO_PARAGRAPH)).alias("edited_fingerprint"),
        likeness(F.col("edited_differing"), F.col("n_own"), F.col("n_edited")).alias("near_edited"),
        likeness(F.col("next_differing"), F.col("n_own"), F.col("n_next")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
