import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from tessera.functions import geometry
from tessera.operators import matching, ownership, spatial
from tessera.sources import stored
from tessera.streaming import titles

COLUMNS = ["poly_id", "title_no", "xmin", "updatedAt"]


def grid(spark, n, side):
    box = [f"-5e0 + (id % {side}) * 1e-3 AS xmin", f"50e0 + floor(id / {side}) * 1e-3 AS ymin"]
    df = spark.range(n).selectExpr("id AS poly_id", "concat('T', CAST(id AS STRING)) AS title_no", *box, "CAST('2024-01-07' AS DATE) AS updatedAt")
    df = df.withColumns({"xmax": F.col("xmin") + 8e-4, "ymax": F.col("ymin") + 8e-4})
    return df.withColumn("geom", geometry.rect("xmin", "ymin", "xmax", "ymax"))


def names(folder):
    return {str(p) for p in Path(folder).rglob("*.parquet")}


def rows_of(df, columns=COLUMNS):
    return sorted(map(tuple, df.select(columns).collect()))


def test_merge_rewrites_changed_buckets_only(spark, tmp_path):
    folder, base = str(tmp_path / "t"), grid(spark, 300, 20)
    stored.write_by_key(base, folder, 16)
    assert rows_of(stored.by_key(spark, folder)) == rows_of(base)
    new = grid(spark, 400, 20).filter("poly_id IN (7, 8, 350)").withColumns({"accepted": F.col("poly_id") != 8, "createdAt": F.lit(dt.date(2024, 5, 1))})
    new = new.withColumn("geom", geometry.rect(F.col("xmin") + 1.0, F.col("ymin"), F.col("xmax") + 1.0, F.col("ymax")))
    gone = spark.createDataFrame([(9,), (9,), (1000,)], "poly_id long")
    wanted = rows_of(matching.merged(matching.without(base, gone), new))
    before = names(folder)
    touched = stored.merge(spark, folder, new, gone)
    kept = before & names(folder)
    assert 0 < len(touched) <= 4
    assert all(("/bucket=%d/" % b in p) == (p not in kept) for p in before for b in touched if "/bucket=%d/" % b in p)
    assert len(kept) == len([p for p in before if not any(f"/bucket={b}/" in p for b in touched)]) == 16 - len(touched)
    assert rows_of(stored.by_key(spark, folder)) == wanted
    assert stored.merge(spark, folder, new, gone) == touched
    assert rows_of(stored.by_key(spark, folder)) == wanted
    assert stored.merge(spark, folder, new.filter("false")) == []


def test_emptied_buckets(spark, tmp_path):
    folder, base = str(tmp_path / "t"), grid(spark, 40, 20)
    stored.write_by_key(base.filter("false"), folder, 4)
    assert stored.by_key(spark, folder).count() == 0
    stored.merge(spark, folder, base.withColumn("accepted", F.lit(True)))
    assert stored.by_key(spark, folder).count() == 40
    none = base.withColumn("accepted", F.lit(False))
    stored.merge(spark, folder, none, base.select("poly_id"))
    assert stored.by_key(spark, folder).count() == 0
    stored.merge(spark, folder, none.withColumn("accepted", F.col("poly_id") == 3))
    assert [r.poly_id for r in stored.by_key(spark, folder).collect()] == [3]


def test_curve(spark):
    df = spark.createDataFrame([(x / 7, y / 11) for x in range(-3, 4) for y in range(-3, 4)] + [(-180.0, -90.0), (180.0, 90.0), (None, 1.0)], "xmin double, ymin double")
    df = df.withColumns({"xmax": F.col("xmin"), "ymax": F.col("ymin")})

    def plain(x, y):
        if x is None:
            return None
        a, b = (min((1 << 24) - 1, int((v + w / 2) / w * (1 << 24))) for v, w in ((x, 360), (y, 180)))
        return sum((a >> i & 1) << 2 * i | (b >> i & 1) << 2 * i + 1 for i in range(24))

    for x, y, z in df.select("xmin", "ymin", stored.curve()).collect():
        assert z == plain(x, y)


def scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_boxes_read_few_rows(spark, tmp_path):
    df, folder, box = grid(spark, 40_000, 200), str(tmp_path / "z"), (-4.9501, 50.0501, -4.9301, 50.0701)
    odd = df.limit(3).withColumns({"poly_id": F.col("poly_id") + 100_000, "xmin": F.lit(None).cast("double"), "geom": F.lit(None).cast(dict(df.dtypes)["geom"])})
    stored.write_along_curve(df.unionByName(odd), folder, 32)
    wanted = rows_of(spatial.within_box(df, *box))
    assert rows_of(stored.in_box(spark, folder, *box)) == wanted and len(wanted) > 300
    assert spark.read.parquet(f"{folder}/rows").count() == 40_003
    small, large = (scanned(stored.near_box(spark, folder, *b)) for b in (box, (-4.95, 50.05, -4.83, 50.17)))
    assert small <= 5 * 40_000 / 32 and small < large < 40_000
    assert stored.in_box(spark, folder, 0, 0, 1, 1).count() == 0


def test_titles_by_state(spark, tmp_path):
    """Files in any order, one of them twice, over two runs of the stream: the batch result."""
    rng = random.Random(5)
    rows = [(rng.choice(["T0", f"T{rng.randrange(40)}"]), dt.date(2024, 1, rng.randrange(1, 9)), rng.choice(["ccod", "ocod"]), rng.choice("AD"), i) for i in range(400)]
    rows += [("N", None, None, "A", 1), ("N", None, "ccod", "D", None), (None, None, None, "A", 2)]
    schema = "title_no string, file_date date, type string, op string, event_id long"
    folder, log, marks = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "marks")
    order = ["file_date", "type", F.expr("op <> 'D'"), "event_id"]
    rng.shuffle(rows)

    def wanted(upto):
        df = spark.createDataFrame(upto, schema).filter("title_no is not null")
        return {(r.title_no, r.event_id) for r in ownership.applied(df.filter("false"), df, order).collect()}

    def run(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        titles.follow(spark, folder, schema, log, marks, files=1).awaitTermination(180)
        return {(r.title_no, r.event_id) for r in titles.titles(spark, log).collect()}

    held = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert run(rows[:250]) == wanted(rows[:250])
    assert run(rows[200:]) == wanted(rows)
    assert run(rows[:50]) == wanted(rows)
    last = max(int(p.name[6:]) for p in Path(log).glob("batch=*"))
    assert last < 2 and spark.conf.get("spark.sql.streaming.stateStore.providerClass") == held  # nothing new came of the repeated file
    titles.compacted(spark, log, str(tmp_path / "one"))
    assert {(r.title_no, r.event_id) for r in titles.titles(spark, str(tmp_path / "one")).collect()} == wanted(rows)
