"""The registered queries of these operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import (
    audit,
    decontamination,
    html,
    language,
    linededup,
    merkle,
    mixing,
    neardup,
    pii,
    quality,
    secrets,
    sharding,
    tokens,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(_table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op9_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_mix_sources,
        op3_html_text,
        op4_near_duplicates,
        op5_benchmark_items,
        op6_quality_rules,
        op7_secrets,
        op8_shard,
        op9_count_tokens,
        op10_language,
        op11_line_dedup,
        op12_merkle_manifest,
        op13_filter_audit,
    )
}
ORACLES = {
    "op2_mix_sources": mixing.MIX_SQL,
    "op8_shard": sharding.SHARD_SQL,
    "op11_line_dedup": linededup.LINES_SQL,
    "op12_merkle_manifest": merkle.MANIFEST_SQL,
    "op13_filter_audit": audit.AUDIT_SQL,
}
