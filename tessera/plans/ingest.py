"""Loading a month of pending shapes: older months go, the pending table is emptied unless the run goes on, councils are loaded in order and logged."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry
from tessera.plans import runs
from tessera.sources import files

SCHEMA = f"poly_id long, geom {geometry.POLYGON}, council string"


def purge(downloads: str, month: str) -> list[str]:
    """Delete the folders in `downloads` other than the month's; their names. Files beside them stay."""
    store, root = fs.FileSystem.from_uri(downloads) if "://" in downloads else (fs.LocalFileSystem(), downloads)
    old = [x for x in store.get_file_info(fs.FileSelector(root)) if x.type == fs.FileType.Directory and x.base_name != month]
    for x in old:
        store.delete_dir(x.path)
    return sorted(x.base_name for x in old)


def pending(spark: SparkSession, target: str) -> DataFrame:
    """(poly_id, geom, council) of the table, also of one just emptied."""
    return spark.read.schema(SCHEMA).parquet(target)


def load(spark: SparkSession, downloads: str, work: str, target: str, log: runs.RunLog, key: str, resume: bool = False, after: str | None = None, most: int = 10_000, step: int = 20) -> str | None:
    """Load the latest month's archives at downloads/<month>/<council>.zip into `target`; the month, None where there is none.

    The councils are those behind `after`, `most` at most, in order of name. A run
    that goes on starts behind the last council that the log has of it, and keeps
    what is loaded. `step` councils are loaded as one Spark job, then logged; a
    council loaded again replaces its own rows.
    """
    month = files.latest_month(spark, downloads)
    if month is None:
        return None
    purge(downloads, month)
    folder = f"{downloads}/{month}"
    listed = files.archived(spark, folder).select("council").distinct()
    if resume:
        last = log.current().filter(F.col("unique_key") == key).select("last_council_downloaded").first()
        if last is not None and last[0] is not None:
            listed = listed.filter(F.col("council") > last[0])
    else:
        spark.createDataFrame([], SCHEMA).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
        if after:
            first = listed.filter(F.col("council").contains(after)).agg(F.min("council").alias("_at"))
            listed = listed.join(F.broadcast(first), F.col("council") > F.col("_at")).drop("_at")  # one row
    councils = [r[0] for r in listed.orderBy("council").limit(most).collect()]  # a few hundred names
    for at in range(0, len(councils), step):
        some = councils[at : at + step]
        files.load_councils(spark, folder, f"{work}/{month}/{some[0]}", target, only=some)
        log.put(key, last_council_downloaded=some[-1])
    return month
