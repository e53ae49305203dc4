"""From documents to packed sequences, each stage one operator of ``sieveframe.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sieveframe.llm import language, mixing, packing, quality, simhash
from sieveframe.llm.common import table
from sieveframe.sources.shared import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose learned score reaches the cut."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language."""
    return language.keep_identified(docs, language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints within three bits link, that with the
    smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.repeat_to_targets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("language identification", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models, XXH64 and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
