"""Tables of the engine: written steps, new ids, upserts, marks, probes.

A table is a DataFrame; a change gives the DataFrame that replaces it.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; on a local master alone, as in tests, one of our own where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named or tempfile.mkdtemp(prefix="checkpoint-")


def written(df: DataFrame) -> DataFrame:
    """Rows that several later steps read, written once to the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def truncated(table: DataFrame) -> DataFrame:
    """The table without rows."""
    return table.filter("false")


def largest_id(table: DataFrame) -> DataFrame:
    """(id): the largest, 0 for none."""
    return table.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("id"))


def appended(table: DataFrame, rows: DataFrame, last: int | None = None) -> DataFrame:
    """table with rows that get the next ids (after `last`, if given), without gaps, in no set order: rows are counted by partition, so none orders them all."""
    spark = table.sparkSession
    rows = written(rows.select([c for c in table.columns if c != "id"]))
    placed = rows.withColumn("_part", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted(tuple(r) for r in placed.groupBy("_part").agg(F.count(F.lit(1))).collect())  # a number for each partition
    starts, at = [], (largest_id(table).first()[0] if last is None else last) + 1
    for part, n in sizes:
        starts.append((part, at))
        at += n
    first = spark.createDataFrame(starts, "_part int, _first long")
    numbered = placed.join(F.broadcast(first), "_part").withColumn("id", F.col("_first") + F.col("_n"))
    return table.unionByName(numbered.select(*table.columns))


def appended_shapes(table: DataFrame, shapes: DataFrame) -> DataFrame:
    """table (id, geom, ...) with polygons added; none at all is an error."""
    if shapes.isEmpty():
        raise ValueError("there are no polygons to add")
    missing = [F.lit(None).cast(t).alias(c) for c, t in table.dtypes if c not in shapes.columns and c != "id"]
    return appended(table, shapes.select("*", *missing))


def upserted(table: DataFrame, rows: DataFrame, key: str, order: list, keep: tuple[str, ...] = ()) -> DataFrame:
    """table with rows put in place of those with their key; of a key's rows the last by `order` counts; columns in `keep` stay as the table has them."""
    columns = [c for c in table.columns if c != key]
    have = set(rows.columns)
    last = rows.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in columns if c in have]), F.struct(*order)).alias("_new"))
    both = table.select(key, F.struct(*columns).alias("_old")).join(last, key, "full_outer")

    def value(c: str):
        new = F.col(f"_new.{c}") if c in have else F.lit(None).cast(dict(table.dtypes)[c])
        if c in keep:
            return F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(new)
        return F.when(F.col("_new").isNotNull() & F.lit(c in have), new).otherwise(F.col(f"_old.{c}"))

    return both.select(*[F.col(key) if c == key else value(c).alias(c) for c in table.columns])


def deleted(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key).distinct(), key, "left_anti")


def marked(marks: DataFrame, keys: DataFrame, key: str = "poly_id") -> DataFrame:
    """marks with keys added that aren't among them yet."""
    return marks.select(key).unionByName(keys.select(key)).distinct()


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
