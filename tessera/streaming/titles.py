"""The last change of each title, kept as keyed state of a stream.

A micro-batch touches the state of its own titles alone, and only titles whose last
change is a new one come out; these go to a log by batch. Nothing is rewritten. The
last change is the greatest by (file_date, type, added before deleted, event_id) of
all that ever came, so files may come late, twice or in any order.

Edge cases: nulls are the least of their column; changes without a title are left
out; an indicator other than A or D is an error. A title's rows in a batch pass
through in frames, of which one row is kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tessera.operators import ownership

#: What is kept of a change; its order is the order of changes.
KEPT = "file_date date, type string, added boolean, event_id long"
_NAMES = ["file_date", "type", "added", "event_id"]
_OUT = f"title_no string, {KEPT}"
#: Fixed value: the state store that keyed state needs.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(row: tuple) -> tuple:
    """Nulls first, as Spark orders them."""
    return tuple((x is not None, x) for x in row)


def _plain(row: tuple) -> tuple:
    day, kind, added, event = (None if pd.isna(x) else x for x in row)
    day = day.date() if isinstance(day, dt.datetime) else day
    return day, kind, None if added is None else bool(added), None if event is None else int(event)


class LastChange(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", KEPT)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        best = tuple(self.last.get()) if self.last.exists() else None
        before = best
        for frame in rows:
            for row in map(_plain, frame[_NAMES].itertuples(index=False, name=None)):
                if best is None or _rank(row) > _rank(best):
                    best = row
        if best is not None and best != before:
            self.last.update(best)
            yield pd.DataFrame([(key[0], *best)], columns=["title_no", *_NAMES])

    def close(self) -> None:
        pass


def last_changes(changes: DataFrame) -> DataFrame:
    """(title_no, file_date, type, added, event_id) of titles whose last change is a new one; changes are a stream, or a table as one batch."""
    rows = ownership.checked(changes).filter("title_no is not null").select("title_no", "file_date", "type", (F.col("op") == "A").alias("added"), F.col("event_id").cast("long").alias("event_id"))
    return rows.groupBy("title_no").transformWithStateInPandas(LastChange(), _OUT, "update", "none")


def follow(spark: SparkSession, source: str, schema: str | T.StructType, log: str, checkpoint: str, files: int = 100) -> StreamingQuery:
    """Follow change files of `source`: new last changes go to log/batch=<number>, which a batch run again replaces."""

    def put(batch: DataFrame, n: int) -> None:
        batch.withColumn("batch", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(log)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    name = "spark.sql.streaming.stateStore.providerClass"
    held = spark.conf.get(name)
    spark.conf.set(name, ROCKS)  # read as the query starts
    try:
        return last_changes(rows).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, held)


def titles(spark: SparkSession, log: str) -> DataFrame:
    """(title_no, file_date, type, event_id) of the titles that their last change leaves."""
    rows = spark.read.schema(f"{_OUT}, batch int").parquet(log)
    return ownership.latest(rows.drop("batch"), "title_no", _NAMES).filter("added").drop("added")


def compacted(spark: SparkSession, log: str, target: str) -> None:
    """The log's last change of each title, deleted ones too, as a log of one batch at `target`."""
    rows = spark.read.schema(f"{_OUT}, batch int").parquet(log)
    last = rows.agg(F.max("batch").alias("batch"))
    ownership.latest(rows.drop("batch"), "title_no", _NAMES).join(F.broadcast(last), F.lit(True)).write.mode("overwrite").partitionBy("batch").parquet(target)  # one row
