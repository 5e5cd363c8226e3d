"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (byte_cnn, centroids, decontaminate, license_scan, ngram_join, packing, personal_data, prefix_trie,
               quality_rules, rank_profiles, secret_scan, sentencepiece_codec, token_orc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.codec_report(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(spark, table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_digest(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("notices")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_profiles.identify(table(spark, sf_dir, "documents"))


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.tokens_report(spark, table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(spark, table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(spark, table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_secrets, op3_ngram_join, op4_personal_data, op5_quality_rules, op6_quality_classifier,
    op7_decontamination, op8_licenses, op9_language, op10_token_orc,
    op11_packing, op12_centroids, op13_prefix_trie)}
SQL = {"op3_ngram_join": ngram_join.SQL, "op5_quality_rules": quality_rules.SQL,
       "op12_centroids": centroids.SQL, "op13_prefix_trie": prefix_trie.SQL}
