"""The queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, divergence, infilling, licenses, mixing, multiset, pii, quality, records, sharding, simhash, substrings, urls
from tessera.llm.common import table

def tokenizer() -> str:
    """Path of the tokenizer whose ids op11 writes."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op2_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.compared(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.found(table(spark, sf_dir, "documents")))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.without_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(table(spark, sf_dir, "documents"), tokenizer())


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.digests(infilling.arranged(table(spark, sf_dir, "documents")))


_ALL = (op1_mix, op2_multiset_fingerprint, op3_license_scan, op4_quality, op5_pii, op6_shards, op7_substring_dedup, op8_url_filter, op9_decontaminate, op10_simhash, op11_token_records, op12_divergence, op13_fill_in_middle)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

ORACLE_SQL: dict[str, str] = {"op12_divergence": divergence.SQL, "op13_fill_in_middle": infilling.SQL}
