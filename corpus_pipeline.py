"""From documents to token ids: rules, language, copies, mixture, encoding.

Every stage takes all that the one before it kept, as written to the shared folder.

Defined results: documents that are null or without letters go with the rules or the
language. Near copies are told apart by id and text, so texts of one id that differ
both stay, and of equal rows one does. The order of rows is lost when a table is read
again; the mixture's schedule follows from the documents alone, so the last stage
works it out again and returns each document's slot and its place in that slot. An
empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm import language_id, mixing, ngram_join, quality_rules, sentencepiece_codec
from fleetgauge.llm.ship import ship
from fleetgauge.session import stored

PIECES = "piece_bpe_32k.model"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def identified_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, of which one language has a fair part."""
    return language_id.keep_identified(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one_of_each(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixing.mixed(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, source, slot and place in the mixture, and token ids of each document."""
    coded = sentencepiece_codec.encode(mixing.placed(docs), public_tokenizers.path(PIECES))
    return coded.select("doc_id", "source", "slot", "place", "ids")


STAGES = [
    ("quality rules", good_documents),
    ("language", identified_documents),
    ("near copies", distinct_documents),
    ("mixture", mixed_documents),
    ("encoding", encoded_documents),
]

#: Learned rules and mixtures, components and segmentations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
