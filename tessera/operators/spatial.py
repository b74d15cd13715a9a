"""Spatial joins and searches: equal grid cells, then bounding boxes, then the exact test.

Cells have levels, each four times as wide as the one below: a shape is listed at
the level whose cells are as wide as its box, so in four of them at most, however
large it is. A pair meets at the level of its larger shape, in the cell of its
boxes' common lower corner, so none occurs twice. A crowded cell is one join key,
which AQE splits. Boxes alone decide pairs of axis-parallel rectangles; the exact
test sees the shapes of the others only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry, kernel

#: Degrees of a cell's side at the lowest level: some 1 km.
CELL = 0.01
STEP, LEVELS = 4, 9
BOX = ("xmin", "ymin", "xmax", "ymax")

meets = F.pandas_udf(kernel.meets, T.BooleanType())
common_areas = F.pandas_udf(kernel.common_areas, T.DoubleType())
_rings = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
clipped = F.pandas_udf(kernel.clipped, T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", _rings)])))


def with_box(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumns({n: b for n, b in zip(BOX, geometry.bbox(geometry.ring(geom)), strict=True)})


def _level(cell: float) -> Column:
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(1e-12))
    return F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), F.ceil(F.log(side / cell) / F.log(F.lit(float(STEP))))).cast("int"))


def _levels(df: DataFrame, cell: float) -> DataFrame:
    """One row: the levels of the shapes, at most LEVELS numbers."""
    return df.select(_level(cell).alias("k")).agg(F.collect_set("k").alias("_further"))


def _listed(df: DataFrame, name: str, further: DataFrame, cell: float, shapes: bool) -> DataFrame:
    """(name struct, its plainness, level and odd rings, c) of each cell: those of the shape's own level, and of the wider ones that the other side has."""
    wide = lambda k: F.pow(F.lit(float(STEP)), k) * cell
    span = lambda a, b, k: F.sequence(F.floor(F.col(a) / wide(k)), F.floor(F.col(b) / wide(k)))
    of = lambda k: F.flatten(F.transform(span("xmin", "xmax", k), lambda x: F.transform(span("ymin", "ymax", k), lambda y: F.struct(k.alias("k"), x.alias("x"), y.alias("y")))))
    carried = F.struct(*[c for c in df.columns if shapes or c not in ("geom", *BOX)]).alias(name)
    box = F.struct(*BOX).alias(f"{name}_box")
    rings = F.col("geom.coordinates") if "geom" in df.columns else F.lit(None).cast(_rings)
    plain = F.coalesce(_plain(rings), F.lit(False))
    df = df.select(carried, box, plain.alias(f"{name}_plain"), F.when(~plain, rings).alias(f"{name}_rings"), *BOX, _level(cell).alias(f"{name}_level")).crossJoin(F.broadcast(further))  # one row
    own = F.col(f"{name}_level")
    at = F.concat(F.array(own), F.filter("_further", lambda k: k > own))
    return df.select(name, f"{name}_box", f"{name}_plain", f"{name}_rings", f"{name}_level", F.explode(F.flatten(F.transform(at, of))).alias("c"))


def join(left: DataFrame, right: DataFrame, how: str = "meets", cell: float = CELL, exact: bool = True, shapes: bool = True) -> DataFrame:
    """Pairs (l struct, r struct) of rows whose shapes meet; how="overlaps" leaves out pairs that only touch.

    Both sides have xmin, ymin, xmax, ymax and geom. Rows without a box meet nothing.
    shapes=False leaves geom and box out of l and r: rectangles then travel as their
    boxes, and only other shapes take their rings along to the exact test.
    """
    pairs = _listed(left, "l", _levels(right, cell), cell, shapes).join(_listed(right, "r", _levels(left, cell), cell, shapes), "c")
    wide = F.pow(F.lit(float(STEP)), F.col("c.k")) * cell
    of = {f"{s}.{n}": F.col(f"{s}_box.{n}") for s in "lr" for n in BOX}
    corner = (F.col("c.k") == F.greatest("l_level", "r_level")) & (F.col("c.x") == F.floor(F.greatest(of["l.xmin"], of["r.xmin"]) / wide)) & (F.col("c.y") == F.floor(F.greatest(of["l.ymin"], of["r.ymin"]) / wide))
    below = (lambda a, b: of[a] <= of[b]) if how == "meets" else (lambda a, b: of[a] < of[b])
    box = below("l.xmin", "r.xmax") & below("r.xmin", "l.xmax") & below("l.ymin", "r.ymax") & below("r.ymin", "l.ymax")
    pairs = pairs.filter(corner & box)
    if not exact:
        return pairs.select("l", "r")
    rings = [F.when(F.col(f"{s}_plain"), geometry.rect(*[of[f"{s}.{n}"] for n in BOX])["coordinates"]).otherwise(F.col(f"{s}_rings")) for s in "lr"]
    return _judged(pairs, F.col("l_plain") & F.col("r_plain"), *rings, how).select("l", "r")


def _plain(rings: Column) -> Column:
    return (F.size(rings) == 1) & geometry.is_rect(rings[0])


def _none() -> Column:
    """What stands for a shape that needs no test: one point, and not null, as columns of nested nulls alone crash Arrow's reader."""
    return F.array(F.array(F.array(F.lit(0.0), F.lit(0.0))))


def _judged(rows: DataFrame, sure: Column, a: Column, b: Column, how: str = "meets") -> DataFrame:
    """Rows that are sure, or whose shapes a and b meet: the test gets no shapes of sure rows."""
    rows = rows.withColumn("_sure", F.coalesce(sure, F.lit(False)))
    a, b = (F.when(~F.col("_sure") & x.isNotNull(), x).otherwise(_none()) for x in (a, b))
    found = meets(a, b) if how == "meets" else common_areas(a, b) > 0
    return rows.withColumn("_met", found).filter("_sure or _met").drop("_sure", "_met")


def within_box(df: DataFrame, sw_lng: float, sw_lat: float, ne_lng: float, ne_lat: float) -> DataFrame:
    """Rows whose shape meets the box, borders included. Box columns reach the scan as range filters."""
    near = df.filter((F.col("xmin") <= ne_lng) & (F.col("xmax") >= sw_lng) & (F.col("ymin") <= ne_lat) & (F.col("ymax") >= sw_lat))
    inside = (F.col("xmin") >= sw_lng) & (F.col("xmax") <= ne_lng) & (F.col("ymin") >= sw_lat) & (F.col("ymax") <= ne_lat)
    box = geometry.rect(*[F.lit(float(x)) for x in (sw_lng, sw_lat, ne_lng, ne_lat)])
    return _judged(near, inside | _plain(F.col("geom.coordinates")), F.col("geom.coordinates"), box["coordinates"])


def in_area(df: DataFrame, rings: list[list[list[float]]]) -> DataFrame:
    """Rows whose shape meets a polygon given by its rings."""
    xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
    near = df.filter((F.col("xmin") <= max(xs)) & (F.col("xmax") >= min(xs)) & (F.col("ymin") <= max(ys)) & (F.col("ymax") >= min(ys)))
    area = F.array(*[F.array(*[F.array(F.lit(float(p[0])), F.lit(float(p[1]))) for p in ring]) for ring in rings])
    return near.filter(meets(F.col("geom.coordinates"), area))


def overlap(rows: DataFrame, a: Column, b: Column, when: Column | None = None) -> DataFrame:
    """Adds area_diff (union less common part, m2) and pct (common part of the union, %) of two rings truncated to 6 places; null where `when` isn't true.

    Rectangles are computed by columns; only other pairs go to the overlay.
    """
    cond = F.coalesce(when, F.lit(False)) if when is not None else F.lit(True)
    rows = rows.withColumns({"_a": F.when(cond, geometry.truncated(a)), "_b": F.when(cond, geometry.truncated(b))})
    rows = rows.withColumn("_p", geometry.is_rect(F.col("_a")) & geometry.is_rect(F.col("_b")) & F.col("_a").isNotNull())
    x, y = F.struct(*[c.alias(n) for c, n in zip(geometry.bbox(F.col("_a")), BOX, strict=True)]), F.struct(*[c.alias(n) for c, n in zip(geometry.bbox(F.col("_b")), BOX, strict=True)])
    rows = rows.withColumns({"_x": F.when(F.col("_p"), x), "_y": F.when(F.col("_p"), y)})
    both = geometry.rect_area(F.greatest("_x.xmin", "_y.xmin"), F.greatest("_x.ymin", "_y.ymin"), F.least("_x.xmax", "_y.xmax"), F.least("_x.ymax", "_y.ymax"))
    odd = F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_p")
    rows = rows.withColumn("_odd", common_areas(F.when(odd, F.array("_a")).otherwise(_none()), F.when(odd, F.array("_b")).otherwise(_none())))
    sizes = F.struct(geometry.ring_area(F.col("_a")).alias("a"), geometry.ring_area(F.col("_b")).alias("b"), F.when(F.col("_p"), both).otherwise(F.col("_odd")).alias("both"))
    rows = rows.withColumn("_m", F.when(F.col("_a").isNotNull(), sizes)).withColumn("_u", F.col("_m.a") + F.col("_m.b") - F.col("_m.both"))
    share = F.when(F.col("_u") > 0, 100 * F.col("_m.both") / F.col("_u")).when(F.col("_u").isNotNull(), 0.0)
    return rows.withColumns({"area_diff": F.col("_u") - F.col("_m.both"), "pct": share}).drop("_a", "_b", "_p", "_x", "_y", "_odd", "_m", "_u")


def tiles(df: DataFrame, kept: list[str], side: float = CELL, most: float = 1e6) -> DataFrame:
    """Shapes over `most` m2 cut to a grid of whole cells centred on the box extended by a cell each way; others stay."""
    df = df.withColumn("_size", geometry.area(F.col("geom")))
    small = df.filter(F.col("_size") <= most).select(*kept, F.lit(0).alias("ix"), F.lit(0).alias("iy"), "geom")
    count = lambda a, b: F.floor((F.col(b) - F.col(a) + 2 * side) / side)
    start = lambda a, b, n: (F.col(a) + F.col(b) - F.col(n) * side) / 2
    large = df.filter(F.col("_size") > most).withColumns({"nx": count("xmin", "xmax"), "ny": count("ymin", "ymax")}).withColumns({"gx": start("xmin", "xmax", "nx"), "gy": start("ymin", "ymax", "ny")})
    cut = large.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nx") - 1)).alias("ix")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ny") - 1)).alias("iy"))
    x0, y0 = F.col("gx") + F.col("ix") * side, F.col("gy") + F.col("iy") * side
    lo = [F.greatest(x0, F.col("xmin")), F.greatest(y0, F.col("ymin"))]
    hi = [F.least(x0 + side, F.col("xmax")), F.least(y0 + side, F.col("ymax"))]
    cut = cut.withColumn("t", F.struct(*[c.alias(n) for c, n in zip((*lo, *hi), ("x0", "y0", "x1", "y1"), strict=True)])).filter("t.x1 > t.x0 and t.y1 > t.y0")
    box = geometry.rect(*[F.col(f"t.{n}") for n in ("x0", "y0", "x1", "y1")])
    cut = cut.withColumn("_plain", _plain(F.col("geom.coordinates")))
    at = [F.col("ix").cast("int").alias("ix"), F.col("iy").cast("int").alias("iy")]
    straight = cut.filter("_plain").select(*kept, *at, box.alias("geom"))
    odd = cut.filter("not _plain").select(*kept, *at, F.explode(clipped(F.col("geom.coordinates"), box["coordinates"])).alias("geom"))
    return small.unionByName(straight).unionByName(odd)
