"""Ownership titles: change files, upserts and deletes as one set operation.

Applying files in order, deletes before upserts, leaves for each title its last
event; so the latest event by (date, type, file, operation, row) decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the date of the full data set that all changes build on.
BOOTSTRAP = "2017-11-28"


def blank_to_null(df: DataFrame, keep: tuple[str, ...] = ("tenure", "title_no")) -> DataFrame:
    return df.select(*[F.col(c) if c in keep or t != "string" else F.nullif(F.col(c), F.lit("")).alias(c) for c, t in df.dtypes])


def iso_date(text: Column) -> Column:
    """DD-MM-YYYY to a date; null for blanks and bad dates."""
    return F.try_to_date(F.nullif(text, F.lit("")), "dd-MM-yyyy")


def latest(changes: DataFrame, key: str, order: list) -> DataFrame:
    """Each key's last row by `order`; pre-aggregated before the shuffle."""
    columns = [c for c in changes.columns if c != key]
    last = F.max_by(F.struct(*columns), F.struct(*order))
    return changes.groupBy(key).agg(last.alias("x")).select(key, "x.*")


def applied(titles: DataFrame, changes: DataFrame, order: list, op: str = "op") -> DataFrame:
    """titles after changes (op A upserts, D deletes); titles and changes share their other columns.

    A title that no change deletes last keeps its createdAt, if the tables have one;
    deleted and added again, it gets the new row's.
    """
    created = "createdAt" in titles.columns
    last = latest(changes, "title_no", order)
    kept = titles.join(last.select("title_no"), "title_no", "left_anti")
    added = last.filter(F.col(op) == "A")
    if created:
        gone = changes.filter(F.col(op) == "D").select("title_no").distinct()
        before = titles.join(gone, "title_no", "left_anti").select("title_no", F.col("createdAt").alias("_created"))
        # Of a title's rows since its last delete the first one's counts.
        alive = changes.groupBy("title_no").agg(F.max(F.when(F.col(op) == "D", F.struct(*order))).alias("_cut"))
        since = changes.filter(F.col(op) == "A").join(alive, "title_no").filter(F.col("_cut").isNull() | (F.struct(*order) > F.col("_cut")))
        first = since.groupBy("title_no").agg(F.min_by("createdAt", F.struct(*order)).alias("_first"))
        added = added.drop("createdAt").join(before, "title_no", "left").join(first, "title_no", "left").withColumn("createdAt", F.coalesce("_created", "_first"))
    return kept.unionByName(added.select(*titles.columns))


def checked(changes: DataFrame, op: str = "op") -> DataFrame:
    """changes as they are; running into an indicator other than A or D is an error that names the title."""
    wrong = F.raise_error(F.concat(F.lit("No change indicator for ownership title "), F.coalesce(F.col("title_no"), F.lit(""))))
    return changes.withColumn(op, F.when(F.col(op).isin("A", "D"), F.col(op)).otherwise(wrong))


def updated(titles: DataFrame, changes: DataFrame, since: DataFrame, full: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """Titles after all change files later than `since`, and (file_date) up to which they then are.

    since: (file_date), one row with null or none where nothing has run: then `full`
    stands for the titles and its date is BOOTSTRAP. changes: rows of all change
    files with file_date, filename and op; files without _COU_ in their name are left out.
    """
    mark = since.agg(F.max("file_date").alias("_since"))
    started = mark.select(F.col("_since").isNotNull().alias("_started"), F.coalesce("_since", F.lit(BOOTSTRAP).cast("date")).alias("_from"))
    base = titles.join(F.broadcast(started), F.col("_started")).drop("_started", "_from")  # one row
    first = full.join(F.broadcast(started), ~F.col("_started")).drop("_started", "_from")
    new = checked(changes.filter(F.col("filename").contains("_COU_"))).join(F.broadcast(started), F.col("file_date") > F.col("_from")).drop("_started", "_from")
    until = new.agg(F.max("file_date").alias("_last")).join(F.broadcast(started), F.lit(True)).select(F.coalesce("_last", "_from").alias("file_date"))
    return applied(base.unionByName(first.select(*titles.columns)), new, order), until


def change_files(catalogue: DataFrame, after: Column | None = None) -> DataFrame:
    """Change files (_COU_) after a date, in order, with is_last_of_date: when to move the date on.

    The catalogue has a row for each file, a few hundred in all: one task orders them.
    """
    files = catalogue.filter(F.col("filename").contains("_COU_"))
    if after is not None:
        files = files.filter(F.col("file_date") > after)
    later = F.lead("file_date").over(Window.partitionBy(F.lit(0)).orderBy("file_date", "type", "filename"))
    return files.withColumn("is_last_of_date", F.coalesce(later != F.col("file_date"), F.lit(True)))
