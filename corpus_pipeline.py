"""Documents to a cleaned, deduplicated, decontaminated and encoded corpus.

Each stage works on all that the one before it has kept, which is written and read again in
between, so that a lost executor costs one stage's tasks at most. All stages but the last return
rows of ``documents`` as they are, in all columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.llm import decontamination, near_dedup, rank_bpe, toxicity
from voltlake.llm.common import is_fold, written
from voltlake.llm.exact_dedup import exact_groups
from voltlake.llm.queries import ready

Docs = DataFrame


def drop_toxic(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """Rows whose text the classifier rejects go. It learns as in the query of its operator."""
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, ~is_fold(5, 0))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """Of equal texts the row with the largest doc_id stays; of rows that repeat id and text one.
    A row without id stays only if no row with one has its text."""
    kept = (
        exact_groups(docs)
        .filter("kept")
        .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__kept"))
        .distinct()
    )
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    marked = docs.withColumn("__text", F.sha2(text, 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__kept"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__text"]).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """Of each group of near-duplicates the smallest doc_id stays; rows without id stay."""
    kept = near_dedup.near_groups(docs).filter("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def drop_leaks(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """Documents that hold a benchmark item, as it is or with other parameters, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontamination.contaminated(docs, benchmark).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col("__id"), "left_anti")


def encode(spark: SparkSession, docs: Docs, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document that is left."""
    coded = rank_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

# SQL has no classifier, signatures or tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
