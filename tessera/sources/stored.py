"""Parcels on disk in two layouts: by key, so that a merge rewrites few files, and along a curve, so that a box reads few.

By key: partitions of=<count>/bucket=<number>, a parcel's bucket being a hash of its
poly_id; the folders say how many there are. A merge reads and replaces the buckets
that have changes and leaves the files of all others. Each bucket written has a row
without a poly_id where it has no parcel, as an overwrite by partitions doesn't
replace what gets no rows; `by_key` leaves these rows out.

Along a curve: rows in order of the Z-order curve through their boxes' centres, in
ranges of even size, and beside them (file, xmin, ymin, xmax, ymax) of each file.
A search opens the files whose boxes meet its own; in these, the row groups and pages
that hold no such shape are skipped by their statistics.

Edge cases: a parcel without a poly_id can't be put in a bucket and is an error.
Along the curve shapes without a box come first, in files that no box meets, or
among others; no search finds them, as none does in memory. Many shapes on one point
are parted by poly_id. An empty table has all its buckets, or one empty file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import matching, spatial
from tessera.operators.tables import written

#: Bits of an axis of the curve: cells of some 2 m.
BITS = 24


def _bucket(of: int) -> Column:
    key = F.when(F.col("poly_id").isNull(), F.raise_error(F.lit("a parcel without poly_id has no bucket"))).otherwise(F.col("poly_id"))
    return F.pmod(F.xxhash64(key), F.lit(of)).cast("int").alias("bucket")


def _put(rows: DataFrame, folder: str, of: int, buckets: DataFrame, mode: str) -> None:
    """rows into the folders of `buckets` (bucket), each of which gets a row at least."""
    placed = rows.withColumn("bucket", _bucket(of)).join(buckets, "bucket", "right").withColumn("of", F.lit(of))
    placed.repartition(F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("of", "bucket").parquet(folder)


def write_by_key(parcels: DataFrame, folder: str, of: int = 64) -> None:
    """parcels as a table of `of` buckets, in place of what the folder has."""
    _put(parcels.drop("is_updated"), folder, of, parcels.sparkSession.range(of).select(F.col("id").cast("int").alias("bucket")), "static")


def by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The parcels of a table of buckets."""
    return spark.read.parquet(folder).filter("poly_id is not null").drop("of", "bucket")


def merge(spark: SparkSession, folder: str, rows: DataFrame, gone: DataFrame | None = None) -> list[int]:
    """Take parcels of `gone` (poly_id) out of the table and put accepted rows in; the numbers of the buckets rewritten.

    As matching.without and matching.merged on the whole table. What is put in is
    written to the shared folder before the table is touched, so that lost executors
    don't make a bucket be computed from one half replaced. The same merge again
    changes nothing more.
    """
    table = spark.read.parquet(folder)
    of = table.select("of").first()[0]
    new = rows.filter("accepted")
    keys = new.select("poly_id") if gone is None else new.select("poly_id").unionByName(gone.select("poly_id"))
    buckets = written(keys.filter("poly_id is not null").select(_bucket(of)).distinct())
    numbers = sorted(r[0] for r in buckets.collect())  # as many numbers as there are buckets at most
    if not numbers:
        return numbers
    held = table.filter(F.col("bucket").isin(numbers) & F.col("poly_id").isNotNull()).drop("of", "bucket")
    if gone is not None:
        held = matching.without(held, gone)
    _put(written(matching.merged(held, new).drop("is_updated")), folder, of, buckets, "dynamic")
    return numbers


def _spread(v: Column) -> Column:
    """The bits of a number of BITS bits, a zero before each."""
    for step in (16, 8, 4, 2, 1):
        mask = sum(((1 << step) - 1) << at for at in range(0, 63, 2 * step)) & ((1 << 63) - 1)
        v = v.bitwiseOR(F.shiftleft(v, step)).bitwiseAND(F.lit(mask))
    return v


def curve() -> Column:
    """Place of a box's centre on the Z-order curve over the whole earth; null without a box."""
    cell = lambda a, b, low, width: F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), F.floor(((F.col(a) + F.col(b)) / 2 - low) / width * (1 << BITS)))).cast("long")
    known = F.col("xmin").isNotNull() & F.col("xmax").isNotNull() & F.col("ymin").isNotNull() & F.col("ymax").isNotNull()
    return F.when(known, _spread(cell("xmin", "xmax", -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(cell("ymin", "ymax", -90.0, 180.0)), 1)))


def write_along_curve(parcels: DataFrame, folder: str, files: int, group_bytes: int = 16 << 20) -> None:
    """parcels (poly_id, geom, box columns) in `files` ranges of the curve, with row groups of some group_bytes."""
    spark = parcels.sparkSession
    placed = parcels.withColumn("_z", curve())
    placed.repartitionByRange(files, "_z", "poly_id").sortWithinPartitions("_z", "poly_id").drop("_z").write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(f"{folder}/rows")
    sides = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    spark.read.parquet(f"{folder}/rows").groupBy(F.col("_metadata.file_name").alias("file")).agg(*sides).write.mode("overwrite").parquet(f"{folder}/files")


def near_box(spark: SparkSession, folder: str, sw_lng: float, sw_lat: float, ne_lng: float, ne_lat: float) -> DataFrame:
    """The parcels of those files that have shapes near the box: what the searches of `parcels` take as their table.

    Only these files' names come to the driver, as many as the box meets.
    """
    met = spark.read.parquet(f"{folder}/files").filter((F.col("xmin") <= ne_lng) & (F.col("xmax") >= sw_lng) & (F.col("ymin") <= ne_lat) & (F.col("ymax") >= sw_lat))
    names = [r[0] for r in met.select("file").collect()]
    return spark.read.parquet(*[f"{folder}/rows/{n}" for n in names]) if names else spark.read.parquet(f"{folder}/rows").filter("false")


def in_box(spark: SparkSession, folder: str, sw_lng: float, sw_lat: float, ne_lng: float, ne_lat: float) -> DataFrame:
    """Parcels along the curve whose shape meets the box."""
    return spatial.within_box(near_box(spark, folder, sw_lng, sw_lat, ne_lng, ne_lat), sw_lng, sw_lat, ne_lng, ne_lat)
