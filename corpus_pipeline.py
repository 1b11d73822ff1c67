"""A training corpus from `documents`: known language, no boilerplate, no near copies, mixed sources, token ids."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lahar.llm import bpe, langid, lines, mixing, neardup
from lahar.llm.common import cut, drop, recorded

#: A document goes if no language has this much of the fused posterior, or its text has no letters.
SURE = 0.5


#: What the last stage wrote on its way; its result is written before another stage begins.
_scratch: list[str] = []


def _stage(f):
    """A stage that first drops what the one before it needed until its result was written."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop(spark, _scratch)
        with recorded() as made:
            out = f(spark, docs, sf_dir)
        _scratch[:] = made
        return out

    return run_stage


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; lang counts as declared, source as the host.

    Null and empty texts and those without letters go; null ids, repeated rows and other columns pass as they are.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"))  # in one column, so that no name meets the operator's
    found = langid.identify(rows, langid.text_model(docs), ["_row"], F.col("_row.text"), F.col("_row.lang"), F.col("_row.source"))
    return found.where((F.col("letters") > 0) & (F.col("posterior") >= SURE)).select("_row.*")


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates.

    Null texts stay null; null ids come last, so their lines go first; repeated rows of the smallest id keep theirs.
    """
    rows = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"))
    left = lines.dedup_lines(rows, carry=("_row",), leaf_shares=lines.SHARES)
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return left.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Null and empty texts, and rows with a null id, link with nothing and stay. Rows that share an id are judged each.
    """
    return neardup.one_of_each(docs, width=5, percent=85).select(*docs.columns)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, each output shard in its own order.

    Null and empty texts have size 0 and are drawn with their block; null and repeated ids are rows like others.
    """
    return mixing.mixed_rows(docs, shard_col=None)


@_stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the hash of what they decode to. Null and empty texts have none.

    Ids are written before they are decoded: a task that did both would have two Python workers, and workers stay.
    """
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.decode(cut(bpe.encode(docs, ranks, public_tokenizers.PATTERN), "pipeline-ids"), ranks)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("byte_bpe", byte_bpe)]

#: Shingle links, fitted likelihoods and token merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
