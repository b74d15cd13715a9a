"""What several operators share: tables, words, checkpoints, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch: long texts come by few at a time.
BATCH_ROWS = 512

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data or of a store that only Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, so that a worker's memory follows a few texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; on a local master alone, as in tests, one of our own where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named or tempfile.mkdtemp(prefix="checkpoint-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder that spark.checkpoint.dir names; a folder of our own only where it is unset."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are done with.

    Spark deletes them once the driver's JVM has collected the plans, which a driver
    with little to do puts off: rounds of a loop and stages of a pipeline would pile
    up on the executors' disks. Asked for between rounds, where it takes a moment.
    """
    spark.sparkContext._jvm.System.gc()


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text: bytes.split() parts at exactly the six ASCII white-space characters."""
    return text.split() if text else []


def hashes(items: list[bytes], seed: int = 42) -> np.ndarray:
    """XXH64 of each item."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, seed) for x in items), np.uint64, len(items))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a hash's entropy over all of its bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components by alternating large and small stars.

    edges: (a, b), any order. Returns (node, root) for each node of an edge; root
    is the least node of its component. Each round is joins and pre-aggregated
    minima; a round's edges are checkpointed, and only their number and a
    checksum come to the driver. AQE splits the join of a star's hot centre.
    Both directions of an edge, and both edges that the small star makes of one,
    come of one row rather than of a union, which would write the files of twice as
    many tasks.
    """
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("e")).select(F.col("e.a").alias("x"), F.col("e.b").alias("y"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("a"), F.col("m").alias("b")).distinct()  # a hub's rows, alike but for x, would meet in one task
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(pair("a", "m"), pair("b", "m"))).alias("e")).select("e.a", "e.b")
        edges = checkpointed(small.filter("a <> b").distinct())
        release(edges.sparkSession)
        now = state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.explode(F.array(pair("a", "b"), pair("b", "b"))).alias("e")).select(F.col("e.a").alias("node"), F.col("e.b").alias("root")).distinct()
