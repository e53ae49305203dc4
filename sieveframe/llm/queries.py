"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, collocations, divergence, hashing, html, language, lattice, mixing, packing, quality, sharding, simhash, warc
from .common import table


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(spark, archive, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.search(table(spark, sf_dir, "embeddings"))


def op5_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.partition(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence.apply_rules(table(spark, sf_dir, "documents"))
    return judged.drop("char_distance", "word_distance")


def op8_deletion_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op10_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_skyband_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_layout, op2_pairwise_quality, op3_warc_shards, op4_multi_index_hashing, op5_pivotal_mixing, op6_minimax_shards, op7_divergence_rules, op8_deletion_simhash, op9_cross_parsing, op10_cost_packing,
    op11_suffix_collocations, op12_lattice_hashing, op13_skyband_audit,
)}
ORACLE: dict[str, str] = {
    "op3_warc_shards": warc.oracle_sql(),
    "op7_divergence_rules": divergence.oracle_sql(),
    "op11_suffix_collocations": collocations.oracle_sql(),
    "op12_lattice_hashing": lattice.oracle_sql(),
    "op13_skyband_audit": audit.oracle_sql(),
}
