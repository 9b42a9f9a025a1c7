"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. Labels for the quality rules
are read from ``sf_dir``; nothing else is. Every stage gives an empty result for an empty input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keyscout.llm import common, decision_list, mixing, packing, secrets, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    labels = common.ship_package(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return decision_list.good_documents(docs, labels).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    common.ship_package(spark)
    return simhash.drop_near_copies(docs).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; ``n_chars`` follows the text."""
    common.ship_package(spark)
    return secrets.redacted(docs.select(*COLUMNS)).withColumn("n_chars", common.text_length("text")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    common.ship_package(spark)
    return mixing.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of at most 2048 tokens."""
    common.ship_package(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("secret scans", redact_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Fingerprints, learned rules and formats, and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
