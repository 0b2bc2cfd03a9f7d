"""Registered queries of this package: one per operator, over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfstar.llm import chat, decontaminate, licences, lines, mixing, mtree, quality, simhash, spelling, suffixes, tokens, turns, warc
from halfstar.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(read(spark, sf_dir, "documents")).select("doc_id", "n_removed", "text")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_index(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    return chat.digests(chat.windows(turns.unionByName(more)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(read(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_turns(turns.damage(read(spark, sf_dir, "conversations")))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.start)
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


_ALL = (
    op1_line_dedup,
    op2_simhash,
    op3_top_k,
    op4_warc,
    op5_mixing,
    op6_chat,
    op7_quality,
    op8_decontamination,
    op9_licences,
    op10_token_counts,
    op11_spelling,
    op12_turn_repair,
    op13_suffix_dedup,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": lines.ORACLE_SQL,
        "op3_top_k": mtree.ORACLE_SQL,
        "op4_warc": warc.ORACLE_SQL,
        "op6_chat": chat.ORACLE_SQL,
    }
