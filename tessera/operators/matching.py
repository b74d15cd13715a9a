"""Old against new editions of parcels: each pending shape gets one match type.

Set at a time: the offset that a shape may be shifted by is the mean offset of the
last exactly shifted shape before it in its council, and exact matches are decided
without it, so one window over decided rows supplies it to the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import geometry
from tessera.operators import parcels as parcel_queries
from tessera.operators import spatial
from tessera.operators.tables import written

#: The match types, in order of report.
MATCHES = ("exact", "exactOffset", "highOverlap", "boundariesShifted", "merged", "mergedIncomplete", "segmented", "segmentedIncomplete", "mergedAndSegmented", "moved", "newBoundary", "newSegment", "fail")
#: The types that are accepted.
ACCEPTED = ("exact", "exactOffset", "highOverlap", "boundariesShifted", "merged", "mergedIncomplete", "segmented", "segmentedIncomplete", "mergedAndSegmented", "moved", "newBoundary", "newSegment")
#: Thresholds, all of them exclusive.
OFFSET_MEAN, OFFSET_STD, DIFFERENCE_M2, OVERLAP_PCT, MOVED_M = 1e-4, 5e-8, 100.0, 95.0, 50.0


#: Ids of a range that one task puts in order.
SPAN = 50_000


def first_of_each(pending: DataFrame) -> DataFrame:
    """Each poly_id once, with its least id."""
    w = Window.partitionBy("poly_id").orderBy("id")
    return pending.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def existing(parcels: DataFrame, titles: DataFrame) -> DataFrame:
    """Parcels that are freehold or of unknown tenure."""
    return parcel_queries.with_ownership(parcels, titles, no_leasehold=True)


def compared(pending: DataFrame, parcels: DataFrame, titles: DataFrame) -> DataFrame:
    """Deduplicated pending rows with their old shape, is_exact, offset statistics and is_offset."""
    old = existing(parcels, titles).select("poly_id", F.col("geom").alias("old_geom"), "property_address", F.lit(True).alias("is_known"), F.struct("title_no", *spatial.BOX).alias("_order"))
    rows = first_of_each(pending).join(old, "poly_id", "left")
    # A number with several shapes: the first counts. Rows are dealt by poly_id already.
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("poly_id").orderBy("_order"))).filter("_n = 1").drop("_n", "_order")
    a, b = geometry.ring("old_geom"), geometry.ring("geom")
    plain = F.coalesce(F.col("is_known"), F.lit(False)) & (F.col("geom.type") == "Polygon")
    rows = rows.withColumn("is_exact", plain & F.coalesce(geometry.same_ring(a, b), F.lit(False))).withColumn("stats", F.when(plain, geometry.offset_stats(a, b)))
    s = F.col("stats")
    small = (F.abs(s["lng_mean"]) < OFFSET_MEAN) & (F.abs(s["lat_mean"]) < OFFSET_MEAN) & (s["lng_std"] < OFFSET_STD) & (s["lat_std"] < OFFSET_STD)
    return rows.withColumn("is_offset", ~F.col("is_exact") & F.coalesce(small, F.lit(False)))


def carried_offset(rows: DataFrame) -> DataFrame:
    """Adds lng_offset and lat_offset: those of the council's last exact offset before, else 0.

    A scan in two levels, so that no task holds a council: within ranges of SPAN ids,
    and over what each range ends with, one row a range. Windows order numbers alone,
    no shapes; their result is joined back by poly_id, which is unique in rows.
    """
    offset = F.when(F.col("is_offset"), F.struct(F.col("stats.lng_mean").alias("x"), F.col("stats.lat_mean").alias("y")))
    slim = rows.select("poly_id", "council", "id", F.floor(F.col("id") / SPAN).alias("_range"), offset.alias("_at"))
    ends = slim.filter("_at is not null").groupBy("council", "_range").agg(F.max_by("_at", "id").alias("_end"))
    ranges = slim.select("council", "_range").distinct().join(ends, ["council", "_range"], "left")
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("council", "_range", F.last("_end", ignorenulls=True).over(before("council").orderBy("_range")).alias("_start"))
    slim = slim.withColumn("_last", F.last("_at", ignorenulls=True).over(before("council", "_range").orderBy("id"))).join(ranges, ["council", "_range"])
    last = F.coalesce("_last", "_start")
    return rows.join(slim.select("poly_id", F.coalesce(last["x"], F.lit(0.0)).alias("lng_offset"), F.coalesce(last["y"], F.lit(0.0)).alias("lat_offset")), "poly_id")


def new_shapes_in_conflict(rows: DataFrame, parcels: DataFrame, titles: DataFrame) -> DataFrame:
    """(poly_id) of new shapes that meet an existing parcel when shifted back by their council's offset."""
    new = rows.filter("is_known is null and geom.type = 'Polygon'")
    ring = geometry.shifted(geometry.ring("geom"), -F.col("lng_offset"), -F.col("lat_offset"))
    shifted = new.select("poly_id", F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geom"))
    pairs = spatial.join(spatial.with_box(shifted), parcels.select("title_no", "geom", *spatial.BOX), shapes=False)
    # Tenure is looked up for what is met alone.
    return existing(pairs.select("l.poly_id", "r.title_no").distinct(), titles).select("poly_id").distinct()


def classified(pending: DataFrame, parcels: DataFrame, titles: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Deduplicated pending rows with match_type, accepted, pct, area_diff, stats and the offset used.

    places: (property_address, places: array of {lng, lat}), what an address resolves to.
    Rows marked fail before stay so, and new shapes keep the type they have. The
    rows with their old shapes, and the result, are written to the folder of
    spark.checkpoint.dir: several steps read them, and a filter on the result would
    otherwise have the overlaps computed once more for each of its columns.
    """
    rows = carried_offset(written(compared(pending, parcels, titles)))
    clash = new_shapes_in_conflict(rows, parcels, titles).withColumn("_clash", F.lit(True))
    open_ = F.col("is_known") & (F.col("geom.type") == "Polygon") & ~F.col("is_exact") & ~F.col("is_offset")
    rows = spatial.overlap(rows, geometry.shifted(geometry.ring("old_geom"), F.col("lng_offset"), F.col("lat_offset")), geometry.ring("geom"), open_)
    rows = rows.join(clash, "poly_id", "left")
    near = F.lit(False)
    if places is not None:
        rows = rows.join(places, "property_address", "left")
        x, y = geometry.center(geometry.ring("geom"))
        near = F.coalesce(F.array_min(F.transform("places", lambda p: geometry.distance(x, y, p.lng, p.lat))) < MOVED_M, F.lit(False)) & F.col("property_address").isNotNull()
    match = (
        F.when((F.col("geom.type") != "Polygon") | F.col("match_type").eqNullSafe(F.lit("fail")), "fail")
        .when(F.col("is_exact"), "exact")
        .when(F.col("is_offset"), "exactOffset")
        .when(F.col("is_known") & (F.col("area_diff") < DIFFERENCE_M2) & (F.col("pct") > OVERLAP_PCT), "highOverlap")
        .when(F.col("is_known") & (F.col("pct") == 0) & near, "moved")
        .when(F.col("is_known").isNull() & F.col("match_type").isNotNull(), F.col("match_type"))
        .when(F.col("is_known").isNull() & F.col("_clash").isNull(), "newBoundary")
        .otherwise("fail")
    )
    pct = F.when(F.col("is_exact") | F.col("is_offset"), 100.0).otherwise(F.col("pct"))
    rows = rows.withColumn("match_type", match).withColumn("accepted", F.col("match_type").isin(*ACCEPTED)).withColumn("pct", pct)
    start = lambda g: geometry.ring(g)[0]
    known = [F.coalesce("is_known", F.lit(False)).alias("is_known"), F.when(F.col("is_known"), start("old_geom")).alias("old_start"), start("geom").alias("new_start"), "old_geom"]
    dated = [c for c in ("createdAt",) if c in rows.columns]
    return written(rows.select("id", "poly_id", "council", "geom", "accepted", "match_type", "pct", "area_diff", "stats", "is_exact", "lng_offset", "lat_offset", *dated, *known))


def summary(rows: DataFrame) -> DataFrame:
    """(match_type, n, pct): every match type, null and Total, also those without rows."""
    spark = rows.sparkSession
    domain = spark.createDataFrame([(m,) for m in (*MATCHES, None)], "match_type string")
    counts = rows.groupBy("match_type").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("Total").alias("match_type"), "n")
    listed = domain.join(counts, domain.match_type.eqNullSafe(counts.match_type), "left").select(domain.match_type, F.coalesce("n", F.lit(0)).alias("n")).unionByName(total)
    whole = total.select(F.col("n").alias("_all"))
    share = F.when(F.col("_all") > 0, geometry.rounded(100 * F.col("n") / F.col("_all"), 3)).otherwise(0.0)
    return listed.crossJoin(F.broadcast(whole)).select("match_type", F.col("n").cast("long").alias("n"), share.alias("pct"))  # one row


def statistics(rows: DataFrame) -> DataFrame:
    """(council, stat, value): overlaps of known shapes, and the larger of each shape's offset means and deviations, which exact ones have none of."""
    s = F.when(~F.col("is_exact"), F.col("stats"))
    values = F.array(
        F.struct(F.lit("percentageIntersects").alias("stat"), F.col("pct").alias("value")),
        F.struct(F.lit("offsetMeans").alias("stat"), F.greatest(F.abs(s["lng_mean"]), F.abs(s["lat_mean"])).alias("value")),
        F.struct(F.lit("offsetStds").alias("stat"), F.greatest(s["lng_std"], s["lat_std"]).alias("value")),
    )
    return rows.select("council", F.explode(values).alias("x")).select("council", "x.stat", "x.value").filter("value is not null")


#: Start, end and width of each statistic's bins.
BINS = {"percentageIntersects": (0.0, 99.5, 1.0), "offsetMeans": (0.0, 4e-5, 1e-7), "offsetStds": (0.0, 2e-8, 2e-10)}


def histogram(stats: DataFrame, stat: str, start: float, end: float, size: float) -> DataFrame:
    """(council, bin, n) of a statistic's values in [start, end)."""
    inside = stats.filter((F.col("stat") == stat) & (F.col("value") >= start) & (F.col("value") < end))
    return inside.groupBy("council", F.floor((F.col("value") - start) / size).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histograms(stats: DataFrame) -> DataFrame:
    """(council, stat, bin, n) of each statistic by its bins, in one pass."""
    of = F.lit(None).cast("long")
    for name, (start, end, size) in BINS.items():
        of = F.when((F.col("stat") == name) & (F.col("value") >= start) & (F.col("value") < end), F.floor((F.col("value") - start) / size)).otherwise(of)
    return stats.withColumn("bin", of).filter("bin is not null").groupBy("council", "stat", "bin").agg(F.count(F.lit(1)).alias("n"))


def merged(parcels: DataFrame, rows: DataFrame) -> DataFrame:
    """parcels with accepted shapes put in their place or added, and is_updated.

    Of a parcel that changes its shape, its box and updatedAt (the row's createdAt)
    are the new ones, and all other columns stay, so that the result is parcels again.
    """
    dated = "updatedAt" in parcels.columns and "createdAt" in rows.columns
    new = rows.filter("accepted").select(F.col("poly_id").alias("_poly"), F.col("geom").alias("_geom"), *([F.col("createdAt").alias("_at")] if dated else []))
    new = new.withColumn("_box", F.struct(*[b.alias(n) for n, b in zip(spatial.BOX, geometry.bbox(geometry.ring("_geom")), strict=True)]))
    out = parcels.drop("is_updated").join(new, F.col("poly_id") == F.col("_poly"), "full_outer")
    is_new = F.col("_poly").isNotNull()
    value = {"poly_id": F.coalesce("poly_id", "_poly"), "geom": F.coalesce("_geom", "geom")} | {c: F.when(is_new, F.col(f"_box.{c}")).otherwise(F.col(c)) for c in spatial.BOX if c in parcels.columns}
    if dated:
        value["updatedAt"] = F.when(is_new, F.col("_at")).otherwise(F.col("updatedAt"))
    return out.select(*[value.get(c, F.col(c)).alias(c) for c in parcels.columns if c != "is_updated"], is_new.alias("is_updated"))


def without(parcels: DataFrame, gone: DataFrame) -> DataFrame:
    return parcels.join(gone.select("poly_id").distinct(), "poly_id", "left_anti")


def counted(pending: DataFrame, before: int | None = None, match_type: str | None = "any", by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n) of pending rows with an id below `before` and a match type (None: those without)."""
    if before is not None:
        pending = pending.filter(F.col("id") < before)
    if match_type != "any":
        pending = pending.filter(F.col("match_type").eqNullSafe(F.lit(match_type)))
    return pending.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def reset(pending: DataFrame) -> DataFrame:
    return pending.withColumn("accepted", F.lit(False)).withColumn("match_type", F.lit(None).cast("string"))
