"""Ownership changes as a stream of files: each micro-batch is upserted into versions of the title table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import ownership


def follow(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, files: int = 1) -> StreamingQuery:
    """Apply change files of `source` in order to the table at `target`/v=<batch>; reruns overwrite the same version."""

    def apply(batch: DataFrame, n: int) -> None:
        changes = batch.select("*")
        if n == 0:
            titles = ownership.latest(changes, "title_no", ["file_date", "type", F.expr("op <> 'D'"), "event_id"]).filter("op = 'A'")
        else:
            titles = ownership.applied(spark.read.parquet(f"{target}/v={n - 1}"), changes, ["file_date", "type", F.expr("op <> 'D'"), "event_id"])
        titles.write.mode("overwrite").parquet(f"{target}/v={n}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
