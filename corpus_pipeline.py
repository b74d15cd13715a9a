"""A training corpus from documents: quality, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs; as it begins, what its predecessor
shuffled is let go of.

Edge cases, in every stage: a null text counts as empty and has no words; rows with
a null doc_id are kept by near-dedup; rows alike in all columns are rows of their
own until near-dedup, which goes by doc_id; further columns go through as they are,
whatever their names, but the last stage replaces any named like its own; an empty
table gives an empty one. Documents without words are not taken by the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, mixing, quality, sharding, simhash
from tessera.llm.common import release, shared_folder, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near copies stays."""
    release(spark)
    return simhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark passage go."""
    release(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the mix takes it."""
    release(spark)
    return mixing.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the documents' columns, size, shard, slot and the shard of a grown set."""
    release(spark)
    return sharding.sharded(docs)


STAGES = [("quality_classifier", quality_classifier), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: Classifier and near-dedup have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written in the shared folder that spark.checkpoint.dir names and read again."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}_{name}")
        docs = spark.read.parquet(f"{folder}/{i}_{name}")
    return docs
