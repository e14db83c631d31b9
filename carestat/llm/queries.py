"""Registered queries of the corpus operators (name -> (spark, sf_dir) -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from carestat.llm import ann, bottom_k, bpe, html_text, lang_id, licenses, mixing, ngram_jaccard, passages, quality, role_repair, sharding, zone_clusters
from carestat.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(spark, pages, html_text.train(pages))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(spark, table(spark, sf_dir, "documents"))


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.fingerprints(spark, table(spark, sf_dir, "documents"))


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.label_grades(table(spark, sf_dir, "labels")), 3)
    return quality.grade(spark, docs, model, keep_from=2)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.ngram_components(spark, table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(spark, table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents"))


def op11_zone_map_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters.clustered(spark, table(spark, sf_dir, "embeddings"))


def op12_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repaired_conversations(spark, table(spark, sf_dir, "conversations"))


def op13_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_of(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_html_text": op3_html_text,
    "op4_passages": op4_passages,
    "op5_bottom_k": op5_bottom_k,
    "op6_cross_polytope": op6_cross_polytope,
    "op7_quality": op7_quality,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_language_id": op9_language_id,
    "op10_license_scan": op10_license_scan,
    "op11_zone_map_clusters": op11_zone_map_clusters,
    "op12_role_repair": op12_role_repair,
    "op13_external_shuffle": op13_external_shuffle,
}
ORACLE: dict[str, str] = {}
