"""Shards by weighted rendezvous hashing of record keys.

Each record goes to the shard with the least -ln(u) / weight, u in (0, 1) from a
hash of key and shard. A new shard takes only the records it scores least for,
the others stay; weights share records in proportion. Native columns only.

Slots number a shard's records from 0 without gaps: records are cut into blocks
by hash, blocks are counted, and each block numbers its own from where the ones
before it end. So no task orders a whole shard.

Edge cases: a null key is a key like others; a null text has size OVERHEAD;
records with equal keys share a shard and get slots of their own; an empty table
gives no rows. Other columns are ignored or kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS, OVERHEAD = 40, 16
#: Records of a block, which one task orders.
BLOCK_ROWS = 2_000


def _score(key: list[Column], shard: int, weight: float, seed: int) -> Column:
    h = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard), F.lit(seed)), 11).cast("double")
    return -F.log((h + 0.5) / float(1 << 53)) / float(weight)


def _best(key: list[Column], weights: list[float], seed: int = 0) -> Column:
    """(score, shard) of the least score."""
    scores = [F.struct(_score(key, s, w, seed).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("a shard needs a weight above 0")
    return F.least(*scores) if len(scores) > 1 else scores[0]


def rendezvous(key: list[Column], weights: list[float], seed: int = 0) -> Column:
    """The shard of a key, 0 to len(weights) - 1; shards of weight 0 get nothing."""
    return _best(key, weights, seed)["shard"]


def _grown(best: Column, key: list[Column], shards: int, added: float, seed: int = 0) -> Column:
    """The shard with one more of weight `added`: only the new one's score is to be compared."""
    if added <= 0:
        return best["shard"]
    return F.when(_score(key, shards, added, seed) < best["score"], F.lit(shards)).otherwise(best["shard"])


def _slots(rows: DataFrame, order: list[str], shards: int, n: int, seed: int = 0) -> DataFrame:
    """Adds `slot` to rows that have doc_id and shard."""
    blocks = max(1, n // (shards * BLOCK_ROWS))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*order, F.lit(seed + 1)), F.lit(blocks)))  # of the whole order: rows of one key don't share a block
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("n"))
    first = F.sum("n").over(Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "_block", F.coalesce(first, F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order))
    return rows.join(starts, ["shard", "_block"]).withColumn("slot", (F.col("_first") + place - 1).cast("long")).drop("_block", "_first")


def sharded(docs: DataFrame, weights: list[float] | None = None, added: float = 1.0, seed: int = 0) -> DataFrame:
    """docs with size, shard, slot, grown_shard: the shard with one more of weight `added`. Columns of these names are replaced."""
    weights = list(weights or [1.0] * SHARDS)
    kept = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot", "grown_shard")]
    key = [F.col("doc_id")]
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size")
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), size, _best(key, weights, seed).alias("_best"))
    rows = rows.withColumns({"shard": F.col("_best.shard"), "grown_shard": _grown(F.col("_best"), key, len(weights), added, seed)}).drop("_best")
    return _slots(rows, ["doc_id", "size", "_text"], len(weights), docs.count(), seed).select("row.*", "size", "shard", "slot", "grown_shard")


def placed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard); texts are read once and not shuffled."""
    text, key, weights = F.coalesce(F.col("text"), F.lit("")), [F.col("doc_id")], [1.0] * SHARDS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    rows = rows.withColumn("_best", _best(key, weights))
    rows = rows.withColumns({"shard": F.col("_best.shard"), "grown_shard": _grown(F.col("_best"), key, SHARDS, 1.0)}).drop("_best")
    rows = _slots(rows, ["doc_id", "size", "text_crc32"], SHARDS, docs.count())
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
