"""The registered queries of the operators, and the SQL that checks them where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from crawlspark.lineage import cut_lineage
from crawlspark.llm import (
    centroid_clustering,
    cotraining,
    embedding_dedup,
    jaccard_join,
    language_filters,
    mixing,
    packing,
    paragraph_sketch,
    piece_tokens,
    ppm_score,
    source_divergence,
    sql,
    token_files,
    toxicity,
)
from crawlspark.llm.common import in_fold, table

#: Target weights of the mix, by level; what isn't named weighs 1.
MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 3, "de": 2, "fr": 2, "es": 1},
}
MIX_PERMILLE, MIX_EPOCHS, MIX_SEED = 1000, 4, 0
#: The documents name no domain: their sources are dealt to four by number.
DOMAIN = "concat('domain', CAST(nullif(regexp_extract(source, '[0-9]+', 0), '') AS BIGINT) % 4)"


def op1_source_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every epoch takes of every document, under the weights above."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = cut_lineage(mixing.described(docs, DOMAIN), "mix-rows")
    leaves = mixing.cuts(rows, mixing.quotas(rows, MIX_WEIGHTS, MIX_PERMILLE, MIX_EPOCHS), MIX_SEED)
    return mixing.selected(rows, leaves, MIX_SEED).select(
        "doc_id", *mixing.LEVELS, "epoch", "n_tokens", "take_tokens"
    )


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a fifth of them is held out from learning."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & ~in_fold("doc_id", 5, 0))
    rows = cotraining.featured(docs, labels)
    return cotraining.score(rows, cotraining.fit(rows)).withColumn("held_out", in_fold("doc_id", 5, 0))


def op3_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a third of them is held out from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_filters.fit(docs.where(~in_fold("doc_id", 3, 1) & F.col("doc_id").isNotNull()))
    return language_filters.predict(docs, model).select(
        "doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score"
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bin and place of every piece of every document."""
    return packing.packed_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to seekable files and read back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.token_folder(docs)
    manifest = token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_files.read_token_files(manifest, folder)


def op6_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edit, and their likeness."""
    return paragraph_sketch.document_sketches(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_toxicity_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a fifth of them is held out from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & ~in_fold("doc_id", 5, 0))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", "predicted"
    )


def op8_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of similar documents of every document."""
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_projection_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, at a cosine of 0.93."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document; a fifth of them is held out from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = F.col("doc_id").isNotNull() & ~in_fold("doc_id", 5, 1)
    return ppm_score.score(docs, train).withColumn("held_out", in_fold("doc_id", 5, 1))


def op11_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms it overuses."""
    return source_divergence.source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds around 16 centroids."""
    return centroid_clustering.centroid_clusters(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_chunk_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's SentencePiece ids and of the text that they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_tokens.encode(docs, model, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_source_budgets": op1_source_budgets,
    "op2_cotraining": op2_cotraining,
    "op3_language_filters": op3_language_filters,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_token_files": op5_token_files,
    "op6_paragraph_sketch": op6_paragraph_sketch,
    "op7_toxicity_automaton": op7_toxicity_automaton,
    "op8_chosen_path_join": op8_chosen_path_join,
    "op9_projection_collisions": op9_projection_collisions,
    "op10_ppm_score": op10_ppm_score,
    "op11_level_products": op11_level_products,
    "op12_subvector_clusters": op12_subvector_clusters,
    "op13_chunk_pieces": op13_chunk_pieces,
}

SQL = {
    "op1_source_budgets": sql.mixed_sources(DOMAIN, MIX_WEIGHTS, MIX_PERMILLE, MIX_EPOCHS, MIX_SEED),
    "op8_chosen_path_join": sql.SIMILAR_DOCUMENTS,
    "op9_projection_collisions": sql.NEAR_VECTORS,
    "op11_level_products": sql.SOURCE_DIVERGENCE,
    "op12_subvector_clusters": sql.centroid_clusters(16, 3),
}
