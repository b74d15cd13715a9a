"""What became of parcels between editions: adjacency, merges, segments, containment, new numbers.

For shapes that the plain classifier fails. Shapes of the two editions are joined
by their boxes, everything after that is pairs, pieces and aggregates over them:

* `covered` is the weighted graph of old and new shapes (what each covers of the
  other), `families` its components;
* `gains` and `losses` take a row's gained and lost land apart into pieces, join these
  (shrunk, so that seams don't count) with the old and the new edition, and settle
  what is left over; losses go on in rounds, as a frontier of pieces that gets
  smaller, each round for all rows at once;
* `decided` names the kind of change, `resolved` lets decisions act on other rows by
  precedence of id;
* `containing` and `renamed` find old shapes behind new numbers.

The overlay works on single pairs and pieces only. Sizes: a row has as many pairs as
neighbours in its box.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry, kernel
from tessera.operators import spatial
from tessera.operators.tables import written

#: Metres within which shapes are adjacent, m2 that are no area, share (%) that counts as contained.
ADJACENT_M, ZERO_M2, CONTAINED_PCT = 5.0, 2.0, 95.0
#: Metres by which gained and lost pieces are shrunk at least; else a tenth of the root of their area.
GAIN_M, LOSS_M = 1.0, 0.5

_RINGS = "array<array<array<double>>>"
_PIECES = f"array<struct<rings:{_RINGS},area:double,shrunk:array<{_RINGS}>>>"
_M = 180 / (np.pi * geometry.R)


# --- distances ---------------------------------------------------------------


def _gap(a: list, b: list) -> float:
    """Metres between two polygons' borders, on a plane at their latitude; 0 if they meet."""
    x, y = [kernel.polygons_of({"coordinates": s}) for s in (a, b)]
    if kernel.touches_or_meets(x, y):
        return 0.0
    lat = np.radians(a[0][0][1])
    scale = np.array([np.cos(lat) / _M, 1 / _M])
    p, q = [np.concatenate([np.concatenate([r[:-1], r[1:]], axis=1) for r in (np.array(ring, float) for ring in s)]) for s in (a, b)]

    def least(points: np.ndarray, edges: np.ndarray) -> float:
        s, d = points[:, None, :] * scale, (edges[:, 2:] - edges[:, :2]) * scale
        o = edges[:, :2] * scale
        t = np.clip(((s - o) * d).sum(-1) / np.maximum((d * d).sum(-1), 1e-18), 0, 1)
        return float(np.sqrt(((s - o - t[..., None] * d) ** 2).sum(-1)).min())

    return min(least(p[:, :2], q), least(q[:, :2], p))


def _gaps(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in frames:
        yield pd.Series([_gap([[list(p) for p in r] for r in x], [[list(p) for p in r] for r in y]) if len(x) and len(x[0]) > 1 else 0.0 for x, y in zip(a, b, strict=True)], dtype=float)


gaps = F.pandas_udf(_gaps, T.DoubleType())


def _odd(plain: Column, a: Column, b: Column) -> list[Column]:
    """Both shapes of a pair that isn't plain, for an overlay or a distance; a point stands for the others."""
    asked = ~plain & a.isNotNull() & b.isNotNull()
    return [F.when(asked, x).otherwise(spatial._none()) for x in (a, b)]


def metres_apart(a: Column, b: Column) -> Column:
    """Least distance of two shapes' rings: of plain rectangles by columns, of others by their edges."""
    plain = F.coalesce(spatial._plain(a) & spatial._plain(b), F.lit(False))
    x, y = geometry.bbox(a[0]), geometry.bbox(b[0])
    dx, dy = (F.greatest(F.lit(0.0), x[i] - y[i + 2], y[i] - x[i + 2]) / _M for i in (0, 1))
    flat = F.hypot(dx * F.cos(F.radians(x[1])), dy)
    return F.when(plain, flat).when(a.isNotNull() & b.isNotNull(), gaps(*_odd(plain, a, b)))


def widened(df: DataFrame, metres: float) -> DataFrame:
    """Boxes grown by some metres on all sides."""
    lng = metres * _M / F.cos(F.radians(F.greatest(F.abs("ymin"), F.abs("ymax"))))
    return df.withColumns({"xmin": F.col("xmin") - lng, "xmax": F.col("xmax") + lng, "ymin": F.col("ymin") - metres * _M, "ymax": F.col("ymax") + metres * _M})


def adjacent(shapes: DataFrame, others: DataFrame, metres: float = ADJACENT_M) -> DataFrame:
    """(poly_id, other_id, metres) of shapes and others at most `metres` apart: widened boxes meet on the levelled cells, the distance decides."""
    slim = lambda df: df.select("poly_id", "geom", *spatial.BOX)
    pairs = spatial.join(widened(slim(shapes), metres), slim(others), exact=False).filter("l.poly_id <> r.poly_id")
    found = pairs.select("l.poly_id", F.col("r.poly_id").alias("other_id"), metres_apart(F.col("l.geom.coordinates"), F.col("r.geom.coordinates")).alias("metres"))
    return found.filter(F.col("metres") <= metres)


# --- the graph of old and new shapes -------------------------------------------


def _common(a: Column, b: Column) -> Column:
    """Square metres that two shapes' rings share: rectangles by columns."""
    plain = F.coalesce(spatial._plain(a) & spatial._plain(b), F.lit(False))
    x, y = geometry.bbox(a[0]), geometry.bbox(b[0])
    flat = geometry.rect_area(F.greatest(x[0], y[0]), F.greatest(x[1], y[1]), F.least(x[2], y[2]), F.least(x[3], y[3]))
    return F.when(plain, flat).when(a.isNotNull() & b.isNotNull(), spatial.common_areas(*_odd(plain, a, b)))


def covered(old: DataFrame, new: DataFrame, least: float = ZERO_M2) -> DataFrame:
    """(old_id, new_id, common, old_share, new_share): pairs that share more than `least` m2, and percentages of either."""
    cut = lambda df: spatial.with_box(df.select("poly_id", geometry.truncated_shape(F.col("geom")).alias("geom")))
    pairs = spatial.join(cut(old), cut(new), "overlaps", exact=False)
    # Sizes come from the shapes after the join: carried through it as a number, Spark's planner loses the column.
    size = lambda side: geometry.area(F.struct(F.lit("Polygon").alias("type"), F.col(f"{side}.geom.coordinates").alias("coordinates")))
    pairs = pairs.select(F.col("l.poly_id").alias("old_id"), F.col("r.poly_id").alias("new_id"), _common(F.col("l.geom.coordinates"), F.col("r.geom.coordinates")).alias("common"), size("l").alias("a"), size("r").alias("b"))
    return pairs.filter(F.col("common") > least).select("old_id", "new_id", "common", (100 * F.col("common") / F.col("a")).alias("old_share"), (100 * F.col("common") / F.col("b")).alias("new_share"))


def components(edges: DataFrame, most: int = 40) -> DataFrame:
    """(node, root) of edges (a, b): the least node that each is linked to, by large and small stars in turn."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most):
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), "b")).distinct().toDF("node", "root")
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = written(small.filter("a <> b").distinct())
    raise RuntimeError("the components did not settle")


def families(pairs: DataFrame) -> DataFrame:
    """(family, old_ids, new_ids, kind) of covered pairs: shapes that land went between, as one group each."""
    node = lambda c, kind: F.concat(F.lit(kind), F.lpad(F.col(c).cast("string"), 19, "0"))
    roots = components(pairs.select(node("old_id", "n").alias("a"), node("new_id", "o").alias("b")))
    ids = lambda kind: F.sort_array(F.collect_list(F.when(F.col("node").startswith(kind), F.substring("node", 2, 19).cast("long"))))
    out = roots.groupBy("root").agg(ids("n").alias("old_ids"), ids("o").alias("new_ids"))
    a, b = F.size("old_ids"), F.size("new_ids")
    kind = F.when((a == 1) & (b == 1), "one").when(b == 1, "merged").when(a == 1, "segmented").otherwise("mixed")
    return out.select(F.element_at("old_ids", 1).alias("family"), "old_ids", "new_ids", kind.alias("kind"))


# --- pieces --------------------------------------------------------------------


def _sized(rows: list[list], least: float) -> list[list]:
    """Each row's pieces of an overlay with their area and themselves shrunk; those too small, or with nothing left, are no pieces."""
    pieces = [(i, p, area) for i, polygons in enumerate(rows) for p in polygons if (area := kernel.area([p])) >= ZERO_M2]
    shrunk = kernel.all_buffered([[p] for _, p, _ in pieces], [-max(least, area**0.5 / 10) for _, _, area in pieces])
    out: list[list] = [[] for _ in rows]
    for (i, p, area), rest_ in zip(pieces, shrunk, strict=True):
        if rest_:
            out[i].append({"rings": p, "area": area, "shrunk": rest_})
    return out


def _differences(a: pd.Series, cuts: pd.Series) -> list[list]:
    """Of each row the polygons of a less the cuts; none for null."""
    of = lambda rings: kernel.polygons_of({"coordinates": rings})
    return kernel.differences([(of(x), [of(c) for c in cs] if x is not None else []) for x, cs in zip(a, cuts, strict=True)])


def _less(least: float):
    def pieces(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, cuts in frames:
            yield pd.Series(_sized(_differences(a, cuts), least), dtype=object)

    return F.pandas_udf(pieces, _PIECES)


def _rest(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, cuts in frames:
        yield pd.Series([kernel.area(p) for p in _differences(a, cuts)], dtype=float)


rest = F.pandas_udf(_rest, T.DoubleType())


def _pieces(rows: DataFrame, keys: list[str], rings: Column, cuts: Column, least: float) -> DataFrame:
    """(*keys, piece, rings, area, shrunk): a row for each piece that rings less cuts leaves."""
    found = rows.select(*keys, F.posexplode(_less(least)(rings, cuts)).alias("at", "p"))
    return found.select(*keys, F.xxhash64("at", F.to_json("p.rings")).alias("piece"), "p.rings", "p.area", "p.shrunk")


def _met(pieces: DataFrame, edition: DataFrame) -> DataFrame:
    """(poly_id, piece, other, other_geom): shapes of an edition, but the row's own, that a shrunk piece meets."""
    parts = pieces.select("poly_id", "piece", F.explode("shrunk").alias("rings"))
    parts = spatial.with_box(parts.select("poly_id", "piece", F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates")).alias("geom")))
    pairs = spatial.join(parts, edition.select(F.col("poly_id").alias("other"), "geom", *spatial.BOX))
    pairs = pairs.select("l.poly_id", "l.piece", "r.other", F.col("r.geom").alias("other_geom")).filter("poly_id <> other")
    return pairs.dropDuplicates(["poly_id", "piece", "other"])


def _shapes(rows: DataFrame) -> DataFrame:
    """Open rows with their shapes, truncated: old, old shifted by the offset, new, new shifted back."""
    polygon = lambda ring: F.array(geometry.truncated(ring))
    old, new = geometry.ring("old_geom"), geometry.ring("geom")
    x, y = F.col("lng_offset"), F.col("lat_offset")
    shifted = {"_old": polygon(old), "_old_there": polygon(geometry.shifted(old, x, y)), "_new": polygon(new), "_new_back": polygon(geometry.shifted(new, -x, -y))}
    return rows.select("id", "poly_id", *[v.alias(k) for k, v in shifted.items()])


def _share(inner: Column, outer: Column) -> Column:
    """Percentage of a shape that lies in another."""
    inner = F.transform(inner, lambda r: geometry.truncated(r))
    size = geometry.area(F.struct(F.lit("Polygon").alias("type"), inner.alias("coordinates")))
    return 100 * _common(inner, outer) / size


def gains(shapes: DataFrame, old: DataFrame, pending: DataFrame) -> DataFrame:
    """(poly_id, merged, strange, failed, incomplete): old shapes on gained land that are gone, those that moved elsewhere, and whether land is left over.

    A shape still there next to the row is a shifted boundary; one gone but not
    contained in the row, and one that is elsewhere now, fail the row.
    """
    pieces = written(_pieces(shapes, ["poly_id"], F.col("_new_back"), F.array("_old"), GAIN_M))
    met = _met(pieces, old).join(shapes.select("poly_id", "_new", "_new_back"), "poly_id")
    now = pending.select(F.col("poly_id").alias("other"), F.col("geom.coordinates").alias("now"))
    met = met.join(now, "other", "left")
    near = F.coalesce(metres_apart(F.col("_new"), F.col("now")) <= ADJACENT_M, F.lit(False)) & F.col("now").isNotNull()
    met = written(met.select("poly_id", "piece", "other", "other_geom", F.col("now").isNull().alias("gone"), near.alias("near"), (_share(F.col("other_geom.coordinates"), F.col("_new_back")) > CONTAINED_PCT).alias("inside")))
    bad = ~F.col("near") & ~(F.col("gone") & F.col("inside"))
    found = met.groupBy("poly_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("gone"), F.col("other")))).alias("merged"),
        F.sort_array(F.collect_set(F.when(~F.col("gone") & ~F.col("near"), F.col("other")))).alias("strange"),
        F.bool_or(bad).alias("failed"),
        F.collect_set("other_geom.coordinates").alias("cuts"),
    )
    none = F.array().cast(f"array<{_RINGS}>")
    left = pieces.join(found.select("poly_id", "cuts"), "poly_id", "left").select("poly_id", rest(F.col("rings"), F.coalesce("cuts", none)).alias("area"))
    left = left.groupBy("poly_id").agg((F.sum("area") > ZERO_M2).alias("incomplete"))
    return _settled(shapes, found.drop("cuts"), left)


def losses(shapes: DataFrame, old: DataFrame, pending: DataFrame) -> DataFrame:
    """(poly_id, segments, failed, incomplete): new shapes on lost land, and whether some of it is no one's.

    Round by round: pieces that new shapes meet lose these and what remains is looked
    at again; a round ends rows that fail or hold a piece that nothing meets. Each
    round takes a further neighbour off, so there are no more rounds than a row has.
    A piece that is met and stays as it was (by shapes that have no inside there) is
    no one's either: its row ends with the round after.
    """
    before = old.select(F.col("poly_id").alias("other"), F.col("geom.coordinates").alias("was")).dropDuplicates(["other"])
    frontier = written(_pieces(shapes, ["poly_id"], F.col("_old_there"), F.array("_new"), LOSS_M).withColumn("stuck", F.lit(False)))
    events = []
    while not frontier.isEmpty():
        met = _met(frontier, pending).join(before, "other", "left").join(shapes.select("poly_id", "_old", "_old_there"), "poly_id")
        near = F.coalesce(metres_apart(F.col("_old"), F.col("was")) <= ADJACENT_M, F.lit(False)) & F.col("was").isNotNull()
        met = written(met.select("poly_id", "piece", "other", F.col("other_geom.coordinates").alias("cut"), F.col("was").isNull().alias("fresh"), near.alias("near"), (_share(F.col("other_geom.coordinates"), F.col("_old_there")) > CONTAINED_PCT).alias("inside")))
        bad = ~F.col("near") & ~(F.col("fresh") & F.col("inside"))
        alone = frontier.join(met.select("poly_id", "piece", F.lit(True).alias("_met")).distinct(), ["poly_id", "piece"], "left").filter("stuck or _met is null").select("poly_id").distinct()
        events.append(met.select("poly_id", F.when(~F.col("near"), F.col("other")).alias("segment"), bad.alias("failed"), F.lit(False).alias("incomplete")))
        events.append(alone.select("poly_id", F.lit(None).cast("long").alias("segment"), F.lit(False).alias("failed"), F.lit(True).alias("incomplete")))
        over = met.filter(bad).select("poly_id").unionByName(alone).distinct()
        cuts = met.groupBy("poly_id").agg(F.collect_set("cut").alias("cuts"))
        open_ = frontier.join(over, "poly_id", "left_anti").join(cuts, "poly_id")
        frontier = written(_pieces(open_.withColumnRenamed("area", "was"), ["poly_id", "was"], F.col("rings"), F.col("cuts"), LOSS_M).withColumn("stuck", F.col("area") > F.col("was") - 1e-6).drop("was"))
    if not events:
        return _settled(shapes, shapes.select("poly_id", F.array().cast("array<long>").alias("segments"), F.lit(False).alias("failed")), shapes.select("poly_id", F.lit(False).alias("incomplete")))
    all_ = events[0]
    for e in events[1:]:
        all_ = all_.unionByName(e)
    found = all_.groupBy("poly_id").agg(F.sort_array(F.collect_set("segment")).alias("segments"), F.bool_or("failed").alias("failed"), F.bool_or("incomplete").alias("incomplete"))
    return _settled(shapes, found.drop("incomplete"), found.select("poly_id", "incomplete"))


def _settled(shapes: DataFrame, found: DataFrame, left: DataFrame) -> DataFrame:
    """A row for each shape: nothing found is nothing gained or lost."""
    out = shapes.select("poly_id").join(found, "poly_id", "left").join(left, "poly_id", "left")
    none = F.array().cast("array<long>")
    return out.select("poly_id", *[F.coalesce(c, none if t.startswith("array") else F.lit(False)).alias(c) for c, t in out.dtypes if c != "poly_id"])


# --- decisions -------------------------------------------------------------------


def unmatched(rows: DataFrame) -> DataFrame:
    """Classified rows of known polygons that no plain match fits."""
    return rows.filter("match_type = 'fail' and is_known and geom.type = 'Polygon'")


def decided(rows: DataFrame, old: DataFrame, pending: DataFrame) -> DataFrame:
    """(id, poly_id, decision, merged_ids, segment_ids) of open rows: known polygons that no plain match fits.

    rows: id, poly_id, geom, old_geom, lng_offset, lat_offset; old, pending: the
    editions (poly_id, geom and box). old holds freehold or unknown tenure only.
    """
    shapes = written(_shapes(rows))
    a, b = gains(shapes, old, pending).withColumnRenamed("failed", "_fa").withColumnRenamed("incomplete", "_ia"), losses(shapes, old, pending).withColumnRenamed("failed", "_fb").withColumnRenamed("incomplete", "_ib")
    out = shapes.select("id", "poly_id").join(a, "poly_id").join(b, "poly_id")
    some = lambda c: F.size(c) > 0
    decision = (
        F.when(F.col("_fa") | F.col("_fb"), "fail")
        .when((F.col("_ia") | some("merged")) & (F.col("_ib") | some("segments")), "mergedAndSegmented")
        .when(F.col("_ia"), "mergedIncomplete")
        .when(F.col("_ib"), "segmentedIncomplete")
        .when(some("merged"), "merged")
        .when(some("segments"), "segmented")
        .otherwise("boundariesShifted")
    )
    # A row that its gains fail is not looked at further.
    others = F.when(F.col("_fa"), F.col("strange")).otherwise(F.col("segments"))
    return out.select("id", "poly_id", decision.alias("decision"), F.col("merged").alias("merged_ids"), F.array_sort(others).alias("segment_ids"))


#: Decisions that take old shapes away and accept segments.
CHANGES = ("merged", "mergedIncomplete", "segmented", "segmentedIncomplete", "mergedAndSegmented")


def resolved(rows: DataFrame, decisions: DataFrame, most: int = 1_000) -> tuple[DataFrame, DataFrame]:
    """(rows with match_type after all decisions have acted, (poly_id) marked for deletion), as if rows were taken in order of id.

    rows: id, poly_id, match_type (what the plain classifier says); decisions as of
    `decided`. A decision that fails fails its segments too, and one that changes
    parcels accepts them as new segments; a row that has failed by then is not looked
    at and decides nothing. So it is settled in rounds which decisions stand: one does
    if all that could have failed it before do not stand, and does not if one that
    stands failed it. The last decision that acts on a row counts, over its own.
    """
    acts = F.col("decision").isin("fail", *CHANGES)
    edges = written(decisions.filter(acts).select(F.col("id").alias("by"), F.when(F.col("decision") == "fail", "fail").otherwise("newSegment").alias("as"), F.explode("segment_ids").alias("poly_id")))
    ids = rows.select("id", "poly_id")
    blocks = written(edges.filter("as = 'fail'").join(ids, "poly_id").join(decisions.select("id"), "id", "left_semi").filter("by < id").select("by", "id"))
    state = written(decisions.select("id", F.lit(None).cast("boolean").alias("stands")))
    for _ in range(most):
        held = blocks.join(state.select(F.col("id").alias("by"), F.col("stands").alias("_by")), "by").groupBy("id").agg(F.bool_or(F.coalesce("_by", F.lit(False))).alias("_hit"), F.bool_or(F.col("_by").isNull()).alias("_open"))
        now = state.join(held, "id", "left")
        stands = F.when(F.col("stands").isNotNull(), F.col("stands")).when(F.coalesce("_hit", F.lit(False)), False).when(F.coalesce("_open", F.lit(False)), None).otherwise(True)
        state = written(now.select("id", stands.alias("stands")))
        if state.filter("stands is null").isEmpty():
            break
    else:
        raise RuntimeError("the decisions did not settle")
    standing = decisions.join(state.filter("stands").select("id"), "id", "left_semi")
    own = standing.select("id", "decision")
    last = edges.join(standing.select(F.col("id").alias("by")), "by", "left_semi").groupBy("poly_id").agg(F.max_by("as", "by").alias("_as"), F.max("by").alias("_by"))
    out = rows.join(own, "id", "left").join(last, "poly_id", "left")
    # A row's own decision comes after what acted on it before, unless that stopped it; a new number that is a segment already stays one.
    earlier = F.col("_as").isNotNull() & (F.col("_by") < F.col("id")) & F.col("decision").isNotNull()
    match = F.when(earlier, F.col("decision")).when(F.col("_as").isNotNull(), F.col("_as")).otherwise(F.coalesce("decision", "match_type"))
    out = out.withColumn("match_type", match).select(*rows.columns)
    marks = standing.filter(F.col("decision").isin(*CHANGES)).select(F.explode("merged_ids").alias("poly_id")).distinct()
    return out, marks


# --- new numbers -------------------------------------------------------------------


def containing(new: DataFrame, old: DataFrame, pending: DataFrame) -> DataFrame:
    """(poly_id, old_id, old_share, new_share): of each new number the old shape, no longer pending, that contains it or that it contains.

    Of several the one with the larger share, then the least number.
    """
    gone = old.join(pending.select("poly_id"), "poly_id", "left_anti")
    pairs = covered(gone, new).filter((F.col("old_share") > CONTAINED_PCT) | (F.col("new_share") > CONTAINED_PCT))
    best = F.struct(F.greatest("old_share", "new_share"), (-F.col("old_id")).alias("least"))
    out = pairs.groupBy("new_id").agg(F.max_by(F.struct("old_id", "old_share", "new_share"), best).alias("x"))
    return out.select(F.col("new_id").alias("poly_id"), "x.*")


def ring_key(ring: Column, steps: float = 1e6) -> Column:
    """A key of a closed ring that its start, its direction and a shift of all of it don't change: its points in steps from its box's corner, from the least one, the lesser way round."""
    x0, y0, _, _ = geometry.bbox(ring)
    points = F.transform(F.slice(ring, 1, F.size(ring) - 1), lambda p: F.struct(F.round((p[0] - x0) * steps).cast("long").alias("x"), F.round((p[1] - y0) * steps).cast("long").alias("y")))

    def turned(p: Column) -> Column:
        at = F.array_position(p, F.array_min(p)).cast("int")
        return F.concat(F.slice(p, at, F.size(p) - at + 1), F.slice(p, F.lit(1), at - 1))

    return F.sha2(F.to_json(F.least(turned(points), turned(F.reverse(points)))), 256)


def renamed(new: DataFrame, old: DataFrame, pending: DataFrame, most: float = 1e-4) -> DataFrame:
    """(old_id, new_id, old_title_no, lng_lat): old shapes, no longer pending, that a new number has, up to start, direction and a shift of less than `most` degrees.

    Keys alone would pair all shapes that are alike, wherever they lie; so pairs also
    meet in cells of `most` degrees, old shapes being listed in the cells next to theirs.
    """
    keyed = lambda df, side: df.filter("geom.type = 'Polygon' and size(geom.coordinates) = 1").select(F.col("poly_id").alias(f"{side}_id"), ring_key(geometry.ring("geom")).alias("key"), F.col("xmin").alias(f"{side}_x"), F.col("ymin").alias(f"{side}_y"), *([F.col("title_no").alias("old_title_no")] if side == "old" else [geometry.ring("geom")[0].alias("lng_lat")]))
    cell = lambda c: F.floor(F.col(c) / most)
    beside = lambda c: F.explode(F.array(*[cell(c) + i for i in (-1, 0, 1)]))
    gone = keyed(old.join(pending.select("poly_id"), "poly_id", "left_anti"), "old").select("*", beside("old_x").alias("_cx")).select("*", beside("old_y").alias("_cy"))
    at = keyed(new, "new").withColumns({"_cx": cell("new_x"), "_cy": cell("new_y")})
    pairs = gone.join(at, ["key", "_cx", "_cy"]).filter((F.abs(F.col("old_x") - F.col("new_x")) < most) & (F.abs(F.col("old_y") - F.col("new_y")) < most))
    nearest = Window.partitionBy("new_id").orderBy(F.abs(F.col("old_x") - F.col("new_x")) + F.abs(F.col("old_y") - F.col("new_y")), "old_id")
    return pairs.withColumn("_n", F.row_number().over(nearest)).filter("_n = 1").select("old_id", "new_id", "old_title_no", "lng_lat")
