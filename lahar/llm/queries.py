"""One query for each operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lahar.llm import bpe, clusters, langid, lines, maxent, media, mixing, neardup, neighbours, runs, secrets, substrings, toxicity
from lahar.llm.sql import CLUSTERS_SQL, LINES_SQL, MIX_SQL, NEAR_SQL, NEAREST_SQL, RUNS_SQL, SUBSTRINGS_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.repeated_words(_table(spark, sf_dir, "documents"), width=35))


def op2_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.dedup_lines(_table(spark, sf_dir, "documents"), leaf_shares=lines.SHARES))


def op2_lines_by_leaf_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2_template_lines has become; kept under its earlier name."""
    return op2_template_lines(spark, sf_dir)


def op3_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=5, percent=85)


def op4_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(_table(spark, sf_dir, "documents"), folds=7, held=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), "toxic", folds=5, held=0)
    return toxicity.score(docs, model).select("doc_id", (toxicity.fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents")
    html, url = F.col("html"), F.col("url")
    return langid.identify(pages, langid.text_model(docs), ["page_id"], langid.page_text(html), langid.declared_in(html), langid.host_of(url), references=True)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = bpe.decode(ids, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("shards")


def op9_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.encode_media(_table(spark, sf_dir, "documents"))
    return media.read_media(stored).select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "n_blocks",
    )


def op10_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op11_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.found_secrets(_table(spark, sf_dir, "documents"), strength=10.0))


def op12_drake_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clustered(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, dim=64, scale=256)


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.word_runs(runs.looped(_table(spark, sf_dir, "documents")), min_length=6, min_power=4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_template_lines": op2_template_lines,
    "op2_lines_by_leaf_share": op2_lines_by_leaf_share,
    "op3_minhash_near": op3_minhash_near,
    "op4_maxent_scores": op4_maxent_scores,
    "op5_toxicity": op5_toxicity,
    "op7_language_id": op7_language_id,
    "op6_byte_bpe": op6_byte_bpe,
    "op8_mix_sources": op8_mix_sources,
    "op9_flac_media": op9_flac_media,
    "op10_block_nearest": op10_block_nearest,
    "op11_guess_cost_secrets": op11_guess_cost_secrets,
    "op12_drake_clusters": op12_drake_clusters,
    "op13_word_runs": op13_word_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": SUBSTRINGS_SQL,
    "op2_template_lines": LINES_SQL,
    "op2_lines_by_leaf_share": LINES_SQL,
    "op3_minhash_near": NEAR_SQL,
    "op8_mix_sources": MIX_SQL,
    "op10_block_nearest": NEAREST_SQL,
    "op12_drake_clusters": CLUSTERS_SQL,
    "op13_word_runs": RUNS_SQL,
}
