"""Corpus pipeline: from raw documents to token ids, one operator a stage.

Every stage takes (spark, docs, folder) and works on all rows it gets; ``run`` writes its result
and reads it again for the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hazecast.llm import byte_bpe, mixing, repeats, simhash, toxicity
from hazecast.llm.common import table
from hazecast.session import new_folder

MULTI = "byte_bpe_multi_50k.tiktoken"


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, doesn't reject."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs, width=3, max_distance=2)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, less the bytes of strings that repeat in them."""
    return repeats.without_repeats(docs, length=400)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mix(docs, weights=(5.0, 2.0, 1.0), most=3.0)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    vocabulary = byte_bpe.Vocabulary.read(public_tokenizers.path(MULTI), public_tokenizers.PATTERN)
    return byte_bpe.encoded_documents(docs, vocabulary)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("source_mixing", mixed),
    ("byte_bpe", encoded),
]
ORACLE_SQL = None  # fitted models, fingerprints and token ids: each stage is tested by brute force


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
