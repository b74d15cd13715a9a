"""Pipeline runs: state queries over the run log, dates and the task driver."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INTERRUPTED, STOPPED, RUNNING = -1, 0, 1
MAX_RETRIES = 1
TASKS = ("ownerships", "downloadInspire", "analyseInspire")


def newest(runs: DataFrame, filled: str | None = None) -> DataFrame:
    """The latest run, or the latest with a value in a column."""
    rows = runs.filter(F.col(filled).isNotNull()) if filled else runs
    return rows.orderBy(F.desc("startedAt"), F.desc("id")).limit(1)


def previous(runs: DataFrame, key: str) -> DataFrame:
    return newest(runs.filter(F.col("unique_key") != key))


def hit_max_retries(runs: DataFrame, key: str | None = None) -> DataFrame:
    """(hit): the last MAX_RETRIES + 1 runs but the current one, `key`, were interrupted at one shape; true for none.

    A position that is not set, or 0, is none.
    """
    last = (runs if key is None else runs.filter(F.col("unique_key") != key)).orderBy(F.desc("startedAt"), F.desc("id")).limit(MAX_RETRIES + 1)
    first = F.first("last_poly_analysed").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("startedAt"), F.desc("id")))
    same = (F.col("status") == INTERRUPTED) & F.col("last_task").eqNullSafe(F.lit("analyseInspire")) & F.coalesce((F.col("last_poly_analysed") == F.col("_first")) & (F.col("_first") != 0), F.lit(False))
    return last.withColumn("_first", first).agg(F.coalesce(F.bool_and(same), F.lit(True)).alias("hit"))


def chain_start(runs: DataFrame) -> DataFrame:
    """(startedAt) of the oldest run of the current chain of interrupted ones; of the newest run if all are.

    Aggregates only: the newest run, the newest other one that wasn't interrupted, the oldest after that.
    """
    at = F.struct("startedAt", "id")
    rows = runs.select(at.alias("at"), "status")
    newest_ = rows.agg(F.max("at").alias("_top"))
    stop = rows.join(F.broadcast(newest_), F.col("at") < F.col("_top")).filter(F.col("status") != INTERRUPTED).agg(F.max("at").alias("_stop"))  # one row
    chain = rows.join(F.broadcast(stop), F.lit(True))  # one row
    start = F.coalesce(F.min(F.when(F.col("at") > F.col("_stop"), F.col("at"))), F.max("at"))
    return chain.agg(start.alias("at")).filter("at is not null").select("at.startedAt")


def publish_date(day: Column) -> Column:
    """First Sunday of the month, or of the month before (by a month's shift) if not yet reached."""
    sunday = F.next_day(F.date_sub(F.trunc(day, "MM"), 1), "Sun")
    return F.when(day < sunday, F.add_months(sunday, -1)).otherwise(sunday)


def resume_position(last_poly: int | None, hit: bool) -> int:
    return 1 if last_poly is None else last_poly + int(hit) + 1


def tasks_between(start: str | None = None, stop: str | None = None) -> tuple[str, ...]:
    """Tasks from start up to before stop; unknown names stand for the ends."""
    a = TASKS.index(start) if start in TASKS else 0
    b = TASKS.index(stop) if stop in TASKS else len(TASKS)
    return TASKS[a:b]


def latest_publish_date(today: dt.date) -> dt.date:
    """As publish_date, on the driver; on a publish day itself it is an error, as files may be changing."""
    first = today.replace(day=1)
    sunday = first + dt.timedelta(days=(6 - first.weekday()) % 7)
    if today == sunday:
        raise ValueError("the data may be changing today")
    if today > sunday:
        return sunday
    before = first - dt.timedelta(days=1)
    return before.replace(day=min(sunday.day, before.day))


SCHEMA = "unique_key string, startedAt timestamp, status int, latest_ownership_data date, latest_inspire_data date, last_task string, last_council_downloaded string, last_poly_analysed long, options string, at timestamp"


class RunLog:
    """An append-only table of what became known of each run; a run's row is the last known value of each column."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)

    def put(self, key: str, **known) -> None:
        row = {"unique_key": key, "at": dt.datetime.now(), **known}
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        self.spark.createDataFrame([tuple(row.get(n) for n in names)], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def current(self) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        last = [F.max_by(c.split()[0], F.when(F.col(c.split()[0]).isNotNull(), F.col("at"))).alias(c.split()[0]) for c in SCHEMA.split(", ")[1:-1]]
        return rows.groupBy("unique_key").agg(*last).withColumn("id", F.col("unique_key"))

    def latest(self, but: str | None = None) -> DataFrame:
        return newest(self.current() if but is None else self.current().filter(F.col("unique_key") != but))


def resume_task(log: RunLog, key: str, published: dt.date) -> str | None:
    """The task to go on with; the run's positions are taken over. A download can't go on once newer data is out."""
    last = log.latest(but=key).first()
    if last is None:
        return None
    if last.last_task == "downloadInspire" and (last.startedAt is None or last.startedAt.date() <= published):
        raise ValueError(f"can't resume a download from before {published}")
    log.put(key, last_council_downloaded=last.last_council_downloaded, last_poly_analysed=last.last_poly_analysed)
    return last.last_task


def run(steps: dict[str, Callable[[], None]], log: RunLog, key: str, start: str | None = None, stop: str | None = None) -> str:
    """Run tasks in order and log each state. An error stops the run and is raised."""
    try:
        for task in tasks_between(start, stop):
            log.put(key, last_task=task)
            steps[task]()
    finally:
        log.put(key, status=STOPPED)
    return key


def triggered(log: RunLog, steps: dict[str, Callable[[], None]], options: dict[str, str] | None = None, published: dt.date | None = None) -> str | None:
    """Start a run and see it through; nothing if one is running. Returns its key."""
    last = log.latest().first()
    if last is not None and last.status == RUNNING:
        return None
    options = dict(options or {})
    key = uuid.uuid4().hex[:10]
    log.put(key, status=RUNNING, startedAt=dt.datetime.now(), options=json.dumps(options))
    start = options.get("startAtTask")
    if options.get("resume"):
        start = resume_task(log, key, published or dt.date.min)
    return run(steps, log, key, start, options.get("stopBeforeTask"))


def resumed(log: RunLog, steps: dict[str, Callable[[], None]], published: dt.date | None = None) -> str | None:
    """Where the latest run still counts as running, it was cut off: mark it interrupted and go on in a new one."""
    last = log.latest().first()
    if last is None or last.status != RUNNING:
        return None
    log.put(last.unique_key, status=INTERRUPTED)
    return triggered(log, steps, {**json.loads(last.options or "{}"), "resume": "true"}, published)


def duration(seconds: float) -> str:
    hours, minutes = int(seconds // 3600), int(seconds % 3600 // 60)
    return f"{hours}h {minutes}min" if hours else f"{minutes}min"
