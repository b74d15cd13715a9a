"""Parcels, titles, pending shapes, changes and runs derived from the generic test tables.

Expressions are SQL that Spark and DuckDB read alike, over whole tables. Shapes are
rectangles, or with a slant parallelograms whose points (x, y) have x - SLANT * y
and y in a rectangle; so their boxes in those coordinates state them whole and a
plain query can check every result, also of those that go to the overlay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry

X0, Y0 = "(-5e0 + (c_custkey % 100) * 2e-3)", "(50e0 + floor(c_custkey / 100e0) * 2e-3)"
V = "(c_custkey % 10)"
BOX = ["xmin", "ymin", "xmax", "ymax"]
SLANT = 0.5

#: Two parcels share a title; every seventh parcel has none, and the last ones' titles are of no order.
PARCELS = {"poly_id": "c_custkey", "title_no": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('T', CAST(CAST(floor(c_custkey / 2e0) * 23 AS BIGINT) AS STRING)) END", "xmin": X0, "ymin": Y0, "xmax": f"{X0} + 1e-3", "ymax": f"{Y0} + 8e-4", "updatedAt": "CAST('2024-01-07' AS DATE)"}
TITLES = {
    "title_no": "concat('T', CAST(o_orderkey AS STRING))",
    "tenure": "CASE WHEN o_orderkey % 3 = 0 THEN 'Leasehold' ELSE 'Freehold' END",
    "property_address": "CASE WHEN o_orderkey % 9 = 1 THEN NULL ELSE concat(CAST(o_orderkey AS STRING), ' High Street') END",
    "proprietor_category_1": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Local Authority' ELSE 'Limited Company or Public Limited Company' END",
    "proprietor_name_1": "CASE WHEN o_orderkey % 11 = 0 THEN 'THE CHURCH COMMISSIONERS FOR ENGLAND' WHEN o_orderkey % 13 = 0 THEN concat('Diocese of ', CAST(o_custkey AS STRING)) ELSE concat('Customer ', CAST(o_custkey AS STRING)) END",
    "createdAt": "CAST(o_orderdate AS DATE)",
}


def pending_columns(slant: float = 0.0) -> dict[str, str]:
    """New editions by the last digit: 0, 7 the same, 1 moved a little, 2 to 4 changed, 5 moved far, 6 of another kind, 8 and 9 with new numbers."""
    dx, dy = ("3e-5", "2e-5") if slant else ("3.025e-5", "2.025e-5")  # between the edges of a histogram's bins; slanted ones keep to six places
    return {
        "id": "c_custkey + 1",
        "createdAt": "CAST(concat('2024-05-', lpad(CAST(c_nationkey + 1 AS STRING), 2, '0')) AS DATE)",
        "poly_id": f"CASE WHEN {V} >= 8 THEN c_custkey + 100000000 ELSE c_custkey END",
        "council": "concat('council_', lpad(CAST(c_nationkey AS STRING), 2, '0'))",
        "kind": f"CASE WHEN {V} = 6 THEN 'MultiPolygon' ELSE 'Polygon' END",
        "xmin": f"{X0} + CASE {V} WHEN 1 THEN {dx} WHEN 2 THEN {dx} WHEN 5 THEN 5e-1 WHEN 9 THEN -1.8e-2 ELSE 0e0 END",
        "ymin": f"{Y0} + CASE {V} WHEN 1 THEN -{dy} WHEN 2 THEN -{dy} WHEN 8 THEN 1e-3 ELSE 0e0 END",
        "xmax": f"{X0} + 1e-3 + CASE {V} WHEN 1 THEN {dx} WHEN 2 THEN {dx} + 1e-5 WHEN 3 THEN 1e-5 WHEN 4 THEN 1e-4 WHEN 5 THEN 5e-1 WHEN 9 THEN -1.8e-2 ELSE 0e0 END",
        "ymax": f"{Y0} + 8e-4 + CASE {V} WHEN 1 THEN -{dy} WHEN 2 THEN -{dy} WHEN 8 THEN 1e-3 ELSE 0e0 END",
    }


#: Every ninth shape reaches so far up that it is over 1 km2, and over some forty rows of parcels.
TALL = "CASE WHEN s_suppkey % 9 = 4 THEN 1.5e-2 ELSE 0e0 END"
LAND = {"id": "s_suppkey", "xmin": "-5e0 + (s_suppkey % 20) * 1e-2 + 1e-4", "ymin": "50e0 + floor(s_suppkey / 20e0) * 3e-3 - 1.3e-3", "xmax": "-5e0 + (s_suppkey % 20) * 1e-2 + 9.3e-3", "ymax": f"50e0 + floor(s_suppkey / 20e0) * 3e-3 + 1.1e-3 + {TALL}"}
#: Two features on each land shape, which overlap and leave its upper border free.
FEATURES = {"id": "2 * s_suppkey + half", "tile_id": "s_suppkey", "xmin": f"{LAND['xmin']} + half * 4e-3", "ymin": LAND["ymin"], "xmax": f"{LAND['xmin']} + 5e-3 + half * 4.2e-3", "ymax": f"{LAND['ymax']} - 2e-4"}
WIDE = {"id": "s_suppkey", "xmin": "-5e0 + s_suppkey * 1e-1", "ymin": "50e0", "xmax": "-5e0 + s_suppkey * 1e-1 + 1.37e-2 + (s_suppkey % 3) * 1.1e-2", "ymax": "50e0 + 2.15e-2"}
CHANGES = {"title_no": "concat('T', CAST(user_id AS STRING))", "file_date": "CAST(ts AS DATE)", "type": "CASE WHEN event_id % 4 = 0 THEN 'ocod' ELSE 'ccod' END", "op": "CASE WHEN event_type IN ('error', 'click') THEN 'D' ELSE 'A' END", "event_id": "event_id", "filename": "concat(CASE WHEN event_id % 4 = 0 THEN 'OCOD' ELSE 'CCOD' END, '_COU_', CAST(CAST(ts AS DATE) AS STRING), '.zip')"}
RUNS = {"id": "event_id", "startedAt": "ts", "status": "CASE event_type WHEN 'error' THEN -1 WHEN 'click' THEN 1 ELSE 0 END", "last_poly_analysed": "user_id", "last_task": "CASE WHEN event_id % 2 = 0 THEN 'analyseInspire' ELSE 'ownerships' END", "latest_ownership_data": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(ts AS DATE) END", "unique_key": "concat('k', CAST(event_id AS STRING))"}


#: What becomes of parcels: a cell of the grid plays one scene, by the last digit of its number; boxes in ten-thousandths of a degree.
#: (scene, edition, number, xmin, ymin, xmax, ymax)
SCENES = [
    (0, "old", 1, 0, 0, 5, 8), (0, "old", 2, 5, 0, 10, 8), (0, "new", 1, 0, 0, 10, 8),  # merged
    (1, "old", 1, 0, 0, 10, 8), (1, "new", 1, 0, 0, 5, 8), (1, "new", 3, 5, 0, 10, 8),  # segmented
    (2, "old", 1, 0, 0, 5, 8), (2, "old", 2, 5, 4, 7, 8), (2, "new", 1, 0, 4, 7, 8), (2, "new", 3, 0, 0, 5, 4),  # both
    (3, "old", 1, 0, 0, 5, 8), (3, "old", 2, 5, 0, 10, 8), (3, "new", 1, 0, 0, 15, 8),  # merged, and land that was no one's
    (4, "old", 1, 0, 0, 10, 8), (4, "new", 1, 0, 0, 5, 8),  # land given up
    (5, "old", 1, 0, 0, 5, 8), (5, "old", 2, 5, 0, 10, 8), (5, "new", 1, 0, 0, 6, 8), (5, "new", 2, 6, 0, 10, 8),  # a boundary shifted
    (6, "old", 1, 0, 0, 5, 8), (6, "old", 2, 5, 0, 10, 8), (6, "old", 4, 12, 0, 14, 8), (6, "new", 1, 0, 0, 10, 8), (6, "new", 2, 12, 0, 15, 8),  # taken over by a neighbour that moved away
    (7, "old", 1, 0, 0, 5, 8), (7, "new", 3, 0, 0, 5, 8),  # a new number
    (8, "old", 1, 0, 0, 5, 8), (8, "new", 1, 0, 0, 5, 8), (8, "new", 3, 10, 0, 15, 8),  # nothing, and a new parcel
    (9, "old", 1, 0, 0, 5, 8), (9, "new", 3, 3, 0, 8, 8),  # a new number on half of an old parcel
]
#: Every second cell has its rows in reverse order.
EDITION = {"poly_id": "10 * c_custkey + j", "id": "10 * c_custkey + CASE WHEN c_custkey % 20 < 10 THEN j ELSE 9 - j END", "council": "concat('council_', lpad(CAST(c_nationkey AS STRING), 2, '0'))"} | {c: f"{o} + {c[0]}{i} * 1e-4" for c, o, i in (("xmin", X0, 0), ("ymin", Y0, 0), ("xmax", X0, 1), ("ymax", Y0, 1))}


def _derived(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str], halves: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    df = df.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("half")) if halves else df
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def _shaped(df: DataFrame, kind: str = "'Polygon'", slant: float = 0.0) -> DataFrame:
    box = [F.col(c) for c in BOX]
    g = geometry.sheared(*box, slant) if slant else geometry.rect(*box)
    df = df.withColumn("geom", F.struct(F.expr(kind).alias("type"), g["coordinates"].alias("coordinates")))
    return df.withColumns({"xmin": F.col("xmin") + slant * F.col("ymin"), "xmax": F.col("xmax") + slant * F.col("ymax")}) if slant else df


def parcels(spark: SparkSession, sf_dir: str, slant: float = 0.0) -> DataFrame:
    return _shaped(_derived(spark, sf_dir, "customer", PARCELS), slant=slant)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "orders", TITLES)


def pending(spark: SparkSession, sf_dir: str, slant: float = 0.0) -> DataFrame:
    """One row a customer, and another with a further id in another council for every fiftieth: a duplicate at a border."""
    rows = _derived(spark, sf_dir, "customer", pending_columns(slant))
    again = F.when(F.col("poly_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_again", F.explode(again))
    rows = rows.withColumn("id", F.col("id") + F.col("_again") * 1_000_000).withColumn("council", F.when(F.col("_again") == 1, "council_99").otherwise(F.col("council"))).drop("_again")
    return _shaped(rows, "kind", slant).drop("kind").withColumn("accepted", F.lit(False)).withColumn("match_type", F.lit(None).cast("string"))


def deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(poly_id) marked for deletion: those with a duplicate."""
    return pending(spark, sf_dir).filter("council = 'council_99'").select("poly_id")


def edition(spark: SparkSession, sf_dir: str, which: str, slant: float = 0.0) -> DataFrame:
    """Old parcels, or pending shapes, of the scenes. New numbers have their rings from another point on, the other way round."""
    scenes = spark.createDataFrame(SCENES, "v long, edition string, j long, x0 long, y0 long, x1 long, y1 long")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").join(F.broadcast(scenes), F.col("v") == F.expr(V)).filter(F.col("edition") == which)
    df = _shaped(rows.selectExpr(*[f"{e} AS {n}" for n, e in EDITION.items()], "j"), slant=slant)
    if which == "old":
        return df.select("poly_id", F.lit(None).cast("string").alias("title_no"), "geom", *BOX)
    turned = F.reverse(F.concat(F.slice(F.col("geom.coordinates")[0], 3, 3), F.slice(F.col("geom.coordinates")[0], 2, 2)))
    df = df.withColumn("geom", F.struct(F.lit("Polygon").alias("type"), F.array(F.when(F.col("j") == 3, turned).otherwise(F.col("geom.coordinates")[0])).alias("coordinates")))
    return df.drop("j").withColumn("accepted", F.lit(False)).withColumn("match_type", F.lit(None).cast("string"))


def land(spark: SparkSession, sf_dir: str, slant: float = 0.0) -> DataFrame:
    return _shaped(_derived(spark, sf_dir, "supplier", LAND), slant=slant)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(_derived(spark, sf_dir, "supplier", FEATURES, halves=True))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(_derived(spark, sf_dir, "supplier", WIDE))


def places(spark: SparkSession, sf_dir: str, slant: float = 0.0) -> DataFrame:
    """What addresses resolve to: the new centre for every second moved parcel's title."""
    own = parcels(spark, sf_dir, slant).filter("poly_id % 20 = 5").join(titles(spark, sf_dir).filter("property_address is not null"), "title_no")
    point = F.struct(((F.col("xmin") + F.col("xmax")) / 2 + 0.5).alias("lng"), ((F.col("ymin") + F.col("ymax")) / 2).alias("lat"))
    return own.groupBy("property_address").agg(F.collect_set(point).alias("places"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "events", CHANGES)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "events", RUNS)


def _cte(name: str, table: str, columns: dict[str, str]) -> str:
    return f"{name} AS (SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {table})"


def ctes(slant: float = 0.0) -> str:
    """The same tables in SQL; boxes are those before slanting."""
    return ",\n".join(
        [
            _cte("p", "customer", PARCELS),
            _cte("o", "orders", TITLES),
            _cte("n0", "customer", pending_columns(slant)),
            "n AS (SELECT * FROM n0 UNION ALL SELECT * REPLACE (id + 1000000 AS id, 'council_99' AS council) FROM n0 WHERE poly_id % 50 = 0)",
            _cte("u", "supplier", LAND),
            _cte("fe", "supplier, range(0, 2) h(half)", FEATURES),
            _cte("wi", "supplier", WIDE),
            _cte("ch", "events", CHANGES),
            _cte("r", "events", RUNS),
            "sc(v, edition, j, x0, y0, x1, y1) AS (VALUES " + ", ".join(str(s) for s in SCENES) + ")",
            "ed AS (SELECT edition, " + ", ".join(f"{e} AS {n}" for n, e in EDITION.items()) + f" FROM customer JOIN sc ON sc.v = {V})",
            "lo AS (SELECT * FROM ed WHERE edition = 'old')",
            "ln AS (SELECT * FROM ed WHERE edition = 'new')",
            "po AS (SELECT p.*, o.tenure, o.property_address, o.proprietor_category_1, o.proprietor_name_1 FROM p LEFT JOIN o ON p.title_no = o.title_no)",
            "x AS (SELECT * FROM po WHERE tenure = 'Freehold' OR tenure IS NULL)",
            "d AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY poly_id ORDER BY id) = 1)",
        ]
    )
