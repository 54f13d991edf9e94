"""The registered queries of this subpackage, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.llm import (
    decontamination,
    interpolated_lm,
    language_id,
    mixing,
    near_dedup,
    prefix_counts,
    prefix_trie,
    quotation,
    rank_bpe,
    token_files,
    toxicity,
    whitening,
)
from voltlake.llm.common import is_fold, work_dir
from voltlake.llm.exact_dedup import exact_groups

Query = Callable[[SparkSession, str], DataFrame]
TOKEN_LIMIT = 1024


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "token-files")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), vocabulary, out)
    return token_files.with_start(
        spark, out, token_files.checksums(token_files.read_tokens(spark, out))
    ).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return interpolated_lm.score_texts(documents, held_out=is_fold(5, 1), deleted=is_fold(5, 3))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = _table(spark, sf_dir, "documents"), is_fold(5, 0)
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"), ~held_out)
    found = toxicity.score(documents, model)
    swaps = F.lit(model.swaps).cast("long").alias("swaps"), F.lit(model.swap_change).alias("swap_change")
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", *swaps)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.contaminated(documents, benchmark)


def op6_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return rank_bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = _table(spark, sf_dir, "documents"), is_fold(4, 2)
    model = language_id.fit(documents, ~held_out)
    found = language_id.identify(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    documents = _table(spark, sf_dir, "documents")
    return prefix_counts.prefix_counts(
        documents, vocabulary, budget=TOKEN_LIMIT, keep_table=False
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.reply_order(_table(spark, sf_dir, "conversations"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = prefix_trie.numbered(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.grafted(ranked))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict[str, Query]:
    found = (
        op1_token_files, op2_interpolated_lm, op3_toxicity, op4_near_dedup, op5_decontamination,
        op6_rank_bpe, op7_language_id, op8_prefix_counts, op9_quotation, op10_exact_dedup,
        op11_prefix_trie, op12_whitening, op13_mixing,
    )
    return {f.__name__: f for f in found}


# crc32 of a conversation's decimal id, bit by bit, as an unsigned number.
CRC32 = """
    xor(list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda sum, byte: list_reduce(
            list_prepend(xor(sum, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda bits, unused: xor(bits >> 1, 3988292384 * (bits & 1)))), 4294967295)
"""

OP11_SQL = f"""
    WITH ranked AS (
        SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_hash,
               row_number() OVER (PARTITION BY conv_id
                                  ORDER BY turn NULLS FIRST, coalesce(role, ''), turn_hash) AS rank
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, conv_id - conv_id % 5 AS donor,
               CASE WHEN conv_id % 5 = 0 THEN 0 ELSE {CRC32} % 9 END AS h
        FROM (SELECT DISTINCT conv_id FROM ranked)
    ), rebuilt AS (
        SELECT c.conv_id, 0 AS own, r.rank, r.turn_hash, r.n_bytes
        FROM convs c JOIN ranked r ON r.conv_id = c.donor AND r.rank <= c.h
        UNION ALL
        SELECT c.conv_id, 1, r.rank, r.turn_hash, r.n_bytes
        FROM convs c JOIN ranked r ON r.conv_id = c.conv_id AND r.rank > c.h
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, rank) AS depth FROM rebuilt
    ), paths AS (
        SELECT conv_id, depth, n_bytes,
               string_agg(turn_hash, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
               depth = count(*) OVER (PARTITION BY conv_id) AS last
        FROM placed
        UNION ALL
        SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM placed) FROM convs
    ), nodes AS (
        SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
        FROM paths GROUP BY path, depth
    ), children AS (
        SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
    ), counted AS (
        SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)
    ), below AS (
        SELECT left(path, 64 * top) AS path, sum((n_children = 0)::INT) AS n_leaves,
               sum((n_convs - 1) * n_bytes) AS saved_tokens
        FROM (SELECT *, unnest(generate_series(0, depth)) AS top FROM counted) GROUP BY 1
    )
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
           b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM counted n JOIN below b USING (path)
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_prefix_trie": OP11_SQL,
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
        """,
    }
