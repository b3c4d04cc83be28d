"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on everything that its
predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.llm import jaccard_join, language_filters, mixing, packing, toxicity
from crawlspark.llm.common import importable, table
from crawlspark.llm.queries import DOMAIN, MIX_EPOCHS, MIX_PERMILLE, MIX_SEED, MIX_WEIGHTS
from crawlspark.session import checkpoint_root

#: A text whose n-grams are less known than this is in none of the learned languages.
LEAST_KNOWN = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a learned language; those without a letter go."""
    importable(spark)
    model = language_filters.fit(docs)
    named = language_filters.predict(docs.withColumn("_row", F.struct(*docs.columns)), model)
    known = (F.col("lang_pred") != language_filters.UNDETERMINED) & (F.col("score") >= LEAST_KNOWN)
    return named.where(known).select("_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't predicted as toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.withColumn("_row", F.struct(*docs.columns)), model)
    return scored.where("predicted = 0").select("_row.*")


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones, the one of the smallest id, and of repeated rows one.

    Rows are told apart by all that they hold, so a missing or repeated id
    hides none: a class without any id keeps one row as well.
    """
    importable(spark)
    keys = ("_key", "_other_key")
    keyed = docs.withColumns({key: F.xxhash64(F.lit(n), *docs.columns) for n, key in enumerate(keys)})
    similar = jaccard_join.similar_documents(keyed, carried=keys).where("class_key is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *keys)).alias("first")
    leaders = similar.groupBy(F.expr("class_key ^ 0L").alias("class_key")).agg(first)
    others = similar.join(leaders, "class_key").where(F.struct(*keys) != F.struct(*[f"first.{key}" for key in keys]))
    kept = keyed.join(others.select(*keys).distinct(), list(keys), "left_anti")
    return kept.dropDuplicates(list(keys)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents once for every epoch that takes them, the last of a source cut to its first words."""
    rows = mixing.described(docs, DOMAIN)
    leaves = mixing.cuts(rows, mixing.quotas(rows, MIX_WEIGHTS, MIX_PERMILLE, MIX_EPOCHS), MIX_SEED)
    whole = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "lang", "source")
    named = whole.select(
        "_row",
        "doc_id",
        F.coalesce(F.expr(DOMAIN), F.lit(mixing.UNKNOWN)).alias("domain"),
        F.coalesce("lang", F.lit(mixing.UNKNOWN)).alias("lang"),
        F.coalesce("source", F.lit(mixing.UNKNOWN)).alias("source"),
        mixing.n_tokens("text").alias("n_tokens"),
    )
    taken = mixing.selected(named, leaves, MIX_SEED).select("_row.*", "n_tokens", "take_tokens")
    cut = F.col("take_tokens") < F.col("n_tokens")
    text = F.when(cut, mixing.first_tokens("text", "take_tokens")).otherwise(F.col("text"))
    taken = taken.withColumn("n_chars", F.when(cut, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return taken.withColumn("text", text).select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and place of every piece of every document."""
    importable(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_similar),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_documents),
]

#: Classifiers that are learned from the rows can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again, over the documents of a data folder."""
    folder = f"{checkpoint_root(spark)}/crawlspark/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
