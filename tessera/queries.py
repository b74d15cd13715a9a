"""Registered queries of the spatial engine and the same in SQL for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import geometry
from tessera.operators import lineage, matching, ownership, parcels, spatial, tables, unregistered
from tessera.plans import analysis, runs
from tessera.plans import fixtures as fx
from tessera.sources import stored
from tessera.streaming import titles as title_stream

BOX = (-4.99, 50.0, -4.9, 50.01)
_BOX = "xmin <= -4.9e0 AND xmax >= -4.99e0 AND ymin <= 50.01e0 AND ymax >= 50e0"
R = "6371008.8e0"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, slant: float = 0.0):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = f"WITH {fx.ctes(slant)}\n{sql}"
        return f

    return add


def _r(c: str, places: int = 9):
    return F.round(c, places).alias(c)


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{tables.shared_folder(spark)}/{uuid.uuid4()}"


def _area(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"(CASE WHEN ({x1}) > ({x0}) AND ({y1}) > ({y0}) THEN (radians({x1}) - radians({x0})) * (sin(radians({y1})) - sin(radians({y0}))) * {R} * {R} ELSE 0e0 END)"


_OWNED = ["poly_id", "title_no", "tenure", "proprietor_name_1"]
_SELECT = "SELECT poly_id, title_no, tenure, proprietor_name_1, round(xmin, 9) AS xmin FROM po WHERE"


def _box(spark, d, **kw):
    return parcels.in_box(fx.parcels(spark, d), fx.titles(spark, d), BOX, **kw).select(*_OWNED, _r("xmin"))


@query(f"{_SELECT} {_BOX} ORDER BY poly_id LIMIT 5000")
def boundaries_all(spark, d):
    return _box(spark, d)


@query(f"{_SELECT} {_BOX} ORDER BY poly_id LIMIT 5000")
def boundaries_along_curve(spark, d):
    """The search by box on parcels stored along the curve."""
    folder = _folder(spark)
    stored.write_along_curve(fx.parcels(spark, d), folder, 16)
    return parcels.in_box(stored.near_box(spark, folder, *BOX), fx.titles(spark, d), BOX).select(*_OWNED, _r("xmin"))


@query(f"{_SELECT} {_BOX} AND (tenure = 'Freehold' OR tenure IS NULL) ORDER BY poly_id LIMIT 5000")
def boundaries_no_leasehold(spark, d):
    return _box(spark, d, include_leaseholds=False)


@query(f"{_SELECT} {_BOX} AND proprietor_category_1 = 'Local Authority' ORDER BY poly_id LIMIT 5000")
def boundaries_local_authority(spark, d):
    return _box(spark, d, kind="localAuthority")


@query(f"{_SELECT} {_BOX} AND (proprietor_name_1 ILIKE '%diocese%' OR proprietor_name_1 ILIKE '%church commissioners%') ORDER BY poly_id LIMIT 5000")
def boundaries_church(spark, d):
    return _box(spark, d, kind="churchOfEngland")


@query(f"SELECT id AS poly_id FROM u WHERE {_BOX} ORDER BY id LIMIT 5000")
def boundaries_unregistered(spark, d):
    return parcels.unregistered_in_box(fx.land(spark, d), BOX).select("poly_id")


@query(f"SELECT id, poly_id, council, '' AS tenure FROM n WHERE {_BOX} ORDER BY poly_id, id LIMIT 5000")
def boundaries_pending(spark, d):
    return parcels.pending_in_box(fx.pending(spark, d), BOX).select("id", "poly_id", "council", "tenure")


def _by_area_sql(where: str) -> str:
    return f"SELECT poly_id, title_no, tenure FROM po WHERE {where}"


@query(_by_area_sql("poly_id IN (3, 5, 17, 21, 42, 77, 100, 104)"))
def polygons_by_ids(spark, d):
    return parcels.by_ids(fx.parcels(spark, d), fx.titles(spark, d), [3, 5, 17, 21, 21, 42, 77, 100, 104]).select("poly_id", "title_no", "tenure")


@query(_by_area_sql(f"poly_id IN (3, 5, 17, 21, 42, 77, 100, 104) AND {_BOX}"))
def polygons_by_ids_in_area(spark, d):
    return parcels.by_ids(fx.parcels(spark, d), fx.titles(spark, d), [3, 5, 17, 21, 42, 77, 100, 104], box=BOX).select("poly_id", "title_no", "tenure")


@query("SELECT o.title_no, proprietor_name_1, p.poly_id FROM o LEFT JOIN p ON o.title_no = p.title_no WHERE lower(proprietor_name_1) = 'the church commissioners for england'")
def search_proprietor(spark, d):
    return parcels.by_proprietor(fx.parcels(spark, d), fx.titles(spark, d), "The Church Commissioners for England").select("title_no", "proprietor_name_1", "poly_id")


@query("SELECT title_no, tenure, property_address FROM o WHERE title_no = 'T42'")
def ownership_by_title(spark, d):
    return parcels.by_title(fx.titles(spark, d), "T42").select("title_no", "tenure", "property_address")


@query("SELECT poly_id FROM p WHERE EXISTS (SELECT 1 FROM n WHERE n.poly_id = p.poly_id)")
def pending_exists(spark, d):
    return fx.parcels(spark, d).join(fx.pending(spark, d).select("poly_id"), "poly_id", "left_semi").select("poly_id")


@query("SELECT id, poly_id FROM n WHERE id >= 40 ORDER BY id LIMIT 1")
def pending_next(spark, d):
    return parcels.next_row(fx.pending(spark, d), 40).select("id", "poly_id")


@query("SELECT id, poly_id, council FROM d")
def pending_dedup(spark, d):
    return matching.first_of_each(fx.pending(spark, d)).select("id", "poly_id", "council")


@query("SELECT council, count(*) AS n, count(*) FILTER (WHERE id < 1000) AS n_before FROM n GROUP BY council")
def pending_counts(spark, d):
    counts = matching.counted(fx.pending(spark, d), by=("council",)).join(matching.counted(fx.pending(spark, d), before=1000, by=("council",)).withColumnRenamed("n", "n_before"), "council", "left")
    return counts.select("council", "n", F.coalesce("n_before", F.lit(0)).alias("n_before"))


@query(f"SELECT poly_id, round({_area('xmin', 'ymin', 'xmax', 'ymax')}, 4) AS area FROM p")
def ring_area(spark, d):
    return fx.parcels(spark, d).select("poly_id", F.round(geometry.ring_area(geometry.ring("geom")), 4).alias("area"))


@query("SELECT poly_id, round(floor((xmin + 4.3e-7) * 1e6 + 5e-1) / 1e6, 9) AS x, round(floor((ymax + 4.3e-7) * 1e6 + 5e-1) / 1e6, 9) AS y FROM p")
def ring_truncate(spark, d):
    ring = geometry.truncated(geometry.shifted(geometry.ring("geom"), F.lit(4.3e-7), F.lit(4.3e-7)))
    return fx.parcels(spark, d).select("poly_id", F.round(ring[0][0], 9).alias("x"), F.round(ring[2][1], 9).alias("y"))


@query("SELECT poly_id, round((xmin + xmax) / 2e0, 9) AS lng, round((ymin + ymax) / 2e0, 9) AS lat FROM p")
def ring_center(spark, d):
    x, y = geometry.center(geometry.ring("geom"))
    return fx.parcels(spark, d).select("poly_id", F.round(x, 9).alias("lng"), F.round(y, 9).alias("lat"))


@query(f"SELECT poly_id, round(2e0 * {R} * asin(sqrt(pow(sin(radians(ymax - ymin) / 2e0), 2e0) + pow(sin(radians(xmax - xmin) / 2e0), 2e0) * cos(radians(ymin)) * cos(radians(ymax)))), 4) AS metres FROM p")
def point_distance(spark, d):
    return fx.parcels(spark, d).select("poly_id", F.round(geometry.distance(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")), 4).alias("metres"))


_PAIR = "d JOIN x ON d.poly_id = x.poly_id"


def _all(parts) -> str:
    return " AND ".join(parts)


def _offsets(slant: float) -> dict[str, str]:
    """SQL of a pair's vertex differences (old x to new d): exactness, means and deviations; vertices are slanted boxes' corners."""
    dy = {a: f"(d.{a} - x.{a})" for a in ("ymin", "ymax")}
    dx = [f"(d.{a} - x.{a} + {slant} * {dy[b]})" for a, b in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))]
    dys = [dy["ymin"], dy["ymin"], dy["ymax"], dy["ymax"]]
    mean = lambda v: f"(({' + '.join(v)}) / 4e0)"
    dev = lambda v: f"sqrt(({' + '.join(f'pow({e} - {mean(v)}, 2e0)' for e in v)}) / 4e0)"
    out = {"exact": _all(f"abs({e}) < 1e-6" for e in (*dx, *dys)), "mx": mean(dx), "my": mean(dys), "sx": dev(dx), "sy": dev(dys)}
    out["offset"] = f"NOT ({out['exact']}) AND abs({out['mx']}) < 1e-4 AND abs({out['my']}) < 1e-4 AND {out['sx']} < 5e-8 AND {out['sy']} < 5e-8"
    return out


_O = _offsets(0.0)
_EXACT, _MX, _MY, _SX, _SY = (_O[k] for k in ("exact", "mx", "my", "sx", "sy"))


def _compared(spark, d):
    return matching.compared(fx.pending(spark, d), fx.parcels(spark, d), fx.titles(spark, d))


@query(f"SELECT d.poly_id, d.kind = 'Polygon' AND {_EXACT} AS is_exact FROM {_PAIR}")
def exact_match(spark, d):
    return _compared(spark, d).filter("is_known").select("poly_id", "is_exact")


@query(f"SELECT d.poly_id, round({_MX}, 9) + 0e0 AS lng_mean, round({_MY}, 9) + 0e0 AS lat_mean, round({_SX}, 9) + 0e0 AS lng_std, round({_SY}, 9) + 0e0 AS lat_std FROM {_PAIR} WHERE d.kind = 'Polygon'")
def offset_stats(spark, d):
    rows = _compared(spark, d).filter("stats is not null")
    return rows.select("poly_id", *[(F.round(F.col(f"stats.{c}"), 9) + F.lit(0.0)).alias(c) for c in ("lng_mean", "lat_mean", "lng_std", "lat_std")])


def _cascade(slant: float = 0.0) -> str:
    """SQL of the classifier; coordinates are boxes before slanting, truncated as the vertices are."""
    o = _offsets(slant)
    low, high = (f"floor(({{x}} + {slant} * {{y}}{{dx}}) * 1e6 + 5e-1) / 1e6 - {slant} * (floor(({{y}}{{dy}}) * 1e6 + 5e-1) / 1e6)", "floor(({y}{dy}) * 1e6 + 5e-1) / 1e6")
    old = lambda t, x, y: t.format(x=x, y=y, dx=" + lng_offset", dy=" + lat_offset")
    new = lambda t, x, y: t.format(x=x, y=y, dx="", dy="")
    cut = [f"{f(t, f'{p}{x}', f'{p}{y}')} AS {q}{i}" for f, p, q in ((old, "o", "a"), (new, "", "b")) for i, (t, x, y) in enumerate(((low, "xmin", "ymin"), (high, "xmin", "ymin"), (low, "xmax", "ymin"), (high, "xmax", "ymax")))]
    return f"""
, c AS (SELECT d.*, x.poly_id IS NOT NULL AS known, x.property_address, x.xmin AS oxmin, x.ymin AS oymin, x.xmax AS oxmax, x.ymax AS oymax,
  coalesce(d.kind = 'Polygon' AND {o["exact"]}, false) AS is_exact, coalesce(d.kind = 'Polygon' AND {o["offset"]}, false) AS is_offset, {o["mx"]} AS mx, {o["my"]} AS my, {o["sx"]} AS sx, {o["sy"]} AS sy
  FROM d LEFT JOIN x ON d.poly_id = x.poly_id)
, w AS (SELECT *, coalesce(last_value(CASE WHEN is_offset THEN mx END IGNORE NULLS) OVER z, 0e0) AS lng_offset, coalesce(last_value(CASE WHEN is_offset THEN my END IGNORE NULLS) OVER z, 0e0) AS lat_offset
  FROM c WINDOW z AS (PARTITION BY council ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
, t AS (SELECT *, {", ".join(cut)} FROM w)
, s AS (SELECT *, lng_offset - {slant} * lat_offset AS u_offset, {_area("a0", "a1", "a2", "a3")} AS area_a, {_area("b0", "b1", "b2", "b3")} AS area_b, {_area("greatest(a0, b0)", "greatest(a1, b1)", "least(a2, b2)", "least(a3, b3)")} AS both_ FROM t)
, k AS (SELECT DISTINCT s.poly_id FROM s JOIN x ON s.xmin - s.u_offset <= x.xmax AND s.xmax - s.u_offset >= x.xmin AND s.ymin - s.lat_offset <= x.ymax AND s.ymax - s.lat_offset >= x.ymin WHERE NOT known)
, m AS (SELECT *, area_a + area_b - 2e0 * both_ AS area_diff, 100e0 * both_ / (area_a + area_b - both_) AS pct, poly_id IN (SELECT poly_id FROM k) AS clash FROM s)
, f AS (SELECT *, CASE WHEN kind <> 'Polygon' THEN 'fail' WHEN is_exact THEN 'exact' WHEN is_offset THEN 'exactOffset' WHEN known AND area_diff < 100e0 AND pct > 95e0 THEN 'highOverlap'
  WHEN known AND pct = 0e0 AND poly_id % 20 = 5 AND property_address IS NOT NULL THEN 'moved' WHEN NOT known AND NOT clash THEN 'newBoundary' ELSE 'fail' END AS match_type FROM m)
"""


_CASCADE = _cascade()


@query(f"{_CASCADE} SELECT id, poly_id, round(lng_offset, 9) + 0e0 AS lng_offset, round(lat_offset, 9) + 0e0 AS lat_offset FROM w")
def offset_carry_forward(spark, d):
    return matching.carried_offset(_compared(spark, d)).select("id", "poly_id", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in ("lng_offset", "lat_offset")])


def _classified(spark, d, slant=0.0):
    return matching.classified(fx.pending(spark, d, slant), fx.parcels(spark, d, slant), fx.titles(spark, d), fx.places(spark, d, slant))


_OVERLAPS = "SELECT poly_id, round(area_diff, {0}) AS area_diff, round(pct, {1}) AS pct FROM m WHERE known AND kind = 'Polygon' AND NOT is_exact AND NOT is_offset"


def _overlaps(rows, metres, percent):
    return rows.filter("area_diff is not null").select("poly_id", F.round("area_diff", metres).alias("area_diff"), F.round("pct", percent).alias("pct"))


@query(_CASCADE + _OVERLAPS.format(3, 6))
def overlap_stats(spark, d):
    return _overlaps(_classified(spark, d), 3, 6)


@query(_cascade(fx.SLANT) + _OVERLAPS.format(1, 3), fx.SLANT)
def overlap_stats_slanted(spark, d):
    """Parallelograms: the overlay judges them."""
    return _overlaps(_classified(spark, d, fx.SLANT), 1, 3)


@query(f"{_CASCADE} SELECT poly_id FROM m WHERE NOT known AND kind = 'Polygon' AND clash")
def new_boundary_check(spark, d):
    rows = matching.carried_offset(_compared(spark, d))
    return matching.new_shapes_in_conflict(rows, fx.parcels(spark, d), fx.titles(spark, d))


_MATCHES = " SELECT id, poly_id, council, match_type, match_type <> 'fail' AS accepted FROM f"


@query(_CASCADE + _MATCHES)
def match_classify(spark, d):
    return _classified(spark, d).select("id", "poly_id", "council", "match_type", "accepted")


@query(_cascade(fx.SLANT) + _MATCHES, fx.SLANT)
def match_classify_slanted(spark, d):
    return _classified(spark, d, fx.SLANT).select("id", "poly_id", "council", "match_type", "accepted")


_DOMAIN = ", ".join(f"('{m}')" for m in matching.MATCHES)


@query(
    f"""{_CASCADE}, g AS (SELECT match_type, count(*) AS n FROM f GROUP BY match_type), a AS (SELECT count(*) AS n FROM f)
SELECT v.match_type, CAST(coalesce(g.n, 0) AS BIGINT) AS n, round(floor(100e0 * coalesce(g.n, 0) / a.n * 1e3 + 5e-1) / 1e3, 6) AS pct FROM (VALUES {_DOMAIN}, (NULL)) v(match_type) LEFT JOIN g ON v.match_type IS NOT DISTINCT FROM g.match_type, a
UNION ALL SELECT 'Total', n, 100e0 FROM a"""
)
def match_summary(spark, d):
    return matching.summary(_classified(spark, d)).select("match_type", "n", F.round("pct", 6).alias("pct"))


_STATS = f"""{_CASCADE}, st AS (
SELECT council, 'percentageIntersects' AS stat, CASE WHEN is_exact OR is_offset THEN 100e0 ELSE pct END AS value FROM f WHERE known AND kind = 'Polygon'
UNION ALL SELECT council, 'offsetMeans', greatest(abs(mx), abs(my)) FROM f WHERE known AND kind = 'Polygon' AND NOT is_exact
UNION ALL SELECT council, 'offsetStds', greatest(sx, sy) FROM f WHERE known AND kind = 'Polygon' AND NOT is_exact)"""


@query(f"{_STATS} SELECT council, stat, count(*) AS n, round(avg(value), 6) AS mean FROM st GROUP BY council, stat")
def match_stats(spark, d):
    rows = matching.statistics(_classified(spark, d))
    return rows.groupBy("council", "stat").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


_BIN = "CASE stat WHEN 'percentageIntersects' THEN (CASE WHEN value < 99.5e0 THEN floor(value) END) WHEN 'offsetMeans' THEN (CASE WHEN value < 4e-5 THEN floor(value / 1e-7) END) ELSE (CASE WHEN value < 2e-8 THEN floor(value / 2e-10) END) END"


@query(f"{_STATS} SELECT council, stat, CAST(bin AS BIGINT) AS bin, count(*) AS n FROM (SELECT *, {_BIN} AS bin FROM st WHERE value >= 0) WHERE bin IS NOT NULL GROUP BY council, stat, bin")
def match_histograms(spark, d):
    return matching.histograms(matching.statistics(_classified(spark, d)))


@query(f"{_STATS} SELECT council, CAST(floor(value) AS BIGINT) AS bin, count(*) AS n FROM st WHERE stat = 'percentageIntersects' AND value >= 0 AND value < 99.5e0 GROUP BY ALL")
def match_histogram(spark, d):
    return matching.histogram(matching.statistics(_classified(spark, d)), "percentageIntersects", 0, 99.5, 1)


@query(f"{_CASCADE} SELECT coalesce(p.poly_id, k.poly_id) AS poly_id, p.title_no, round(coalesce(k.xmin, p.xmin), 9) AS xmin, coalesce(k.createdAt, p.updatedAt) AS updatedAt, k.poly_id IS NOT NULL AS is_updated FROM p FULL OUTER JOIN (SELECT * FROM f WHERE match_type <> 'fail') k ON p.poly_id = k.poly_id")
def merge_accepted(spark, d):
    out = matching.merged(fx.parcels(spark, d), _classified(spark, d))
    return out.select("poly_id", "title_no", F.round("xmin", 9).alias("xmin"), "updatedAt", "is_updated")


@query(f"{_CASCADE} SELECT coalesce(q.poly_id, k.poly_id) AS poly_id, q.title_no, round(coalesce(k.xmin, q.xmin), 9) AS xmin, coalesce(k.createdAt, q.updatedAt) AS updatedAt FROM (SELECT * FROM p WHERE poly_id NOT IN (SELECT poly_id FROM n WHERE council = 'council_99')) q FULL OUTER JOIN (SELECT * FROM f WHERE match_type <> 'fail') k ON q.poly_id = k.poly_id")
def merge_stored(spark, d):
    """Marked parcels taken out of a table of buckets and accepted shapes put in."""
    folder = _folder(spark)
    stored.write_by_key(fx.parcels(spark, d), folder, 16)
    stored.merge(spark, folder, _classified(spark, d), fx.deletions(spark, d))
    return stored.by_key(spark, folder).select("poly_id", "title_no", _r("xmin"), "updatedAt")


@query(f"{_CASCADE} SELECT f.id, f.poly_id, f.council, 'Accepted' AS tenure FROM f WHERE match_type <> 'fail' AND {_BOX} ORDER BY poly_id, id LIMIT 5000")
def boundaries_pending_accepted(spark, d):
    rows = spatial.with_box(_classified(spark, d))
    return parcels.pending_in_box(rows, BOX, accepted_only=True).select("id", "poly_id", "council", "tenure")


@query("SELECT poly_id, title_no FROM p WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.poly_id = p.poly_id AND n.council = 'council_99')")
def delete_pending_deletions(spark, d):
    return matching.without(fx.parcels(spark, d), fx.deletions(spark, d)).select("poly_id", "title_no")


@query("SELECT DISTINCT poly_id FROM n WHERE council IN ('council_99', 'council_07')")
def mark_deletions(spark, d):
    """Marks on top of marks: each number once."""
    return tables.marked(fx.deletions(spark, d), fx.pending(spark, d).filter("council = 'council_07'"))


_ANALYSED = "SELECT coalesce(q.poly_id, k.poly_id) AS poly_id, q.title_no, round(coalesce(k.xmin, q.xmin), 9) AS xmin FROM {0} q FULL OUTER JOIN (SELECT * FROM f WHERE match_type <> 'fail') k ON q.poly_id = k.poly_id"
_KEPT = "(SELECT * FROM p WHERE poly_id NOT IN (SELECT poly_id FROM n WHERE council = 'council_99'))"


@query(f"{_CASCADE} {_ANALYSED.format('p')}")
def analysis_parcels(spark, d):
    """The whole analysis of pending shapes, old deletion marks dropped: the parcels that it leaves."""
    out = _analysis(spark, d)["parcels"]
    return out.select("poly_id", "title_no", _r("xmin"))


@query(f"{_CASCADE} {_ANALYSED.format(_KEPT)}")
def analysis_resumed_parcels(spark, d):
    """A run that goes on: marks made before it count."""
    out = _analysis(spark, d, resume=True)["parcels"]
    return out.select("poly_id", "title_no", _r("xmin"))


@query(f"{_CASCADE} SELECT council, poly_id, round(pct, 6) AS pct, round(mx, 9) + 0e0 AS lng_mean, round(sy, 9) + 0e0 AS lat_std, round(oxmin, 9) AS old_lng, round(ymin, 9) AS new_lat FROM f WHERE match_type = 'fail' AND known AND kind = 'Polygon'")
def analysis_failed(spark, d):
    """Failed known polygons only."""
    rows = _analysis(spark, d)["failed"]
    return rows.select("council", "poly_id", F.round("pct", 6).alias("pct"), *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in ("lng_mean", "lat_std")], F.round(F.col("old_lng_lat")[0], 9).alias("old_lng"), F.round(F.col("new_lng_lat")[1], 9).alias("new_lat"))


def _analysis(spark, d, **kw):
    return analysis.analysed(fx.pending(spark, d), fx.parcels(spark, d), fx.titles(spark, d), fx.deletions(spark, d), fx.land(spark, d), fx.places(spark, d), **kw)


_MEET = "a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax"


@query(f"SELECT a.id AS land_id, b.id AS pending_id FROM u a JOIN n b ON {_MEET}")
def spatial_join_tiles(spark, d):
    return spatial.join(fx.land(spark, d), fx.pending(spark, d), shapes=False).select(F.col("l.id").alias("land_id"), F.col("r.id").alias("pending_id"))


@query(f"SELECT a.id AS land_id, b.id AS pending_id FROM u a JOIN n b ON {_MEET.replace('<=', '<')}")
def spatial_join_overlap(spark, d):
    return spatial.join(fx.land(spark, d), fx.pending(spark, d), "overlaps", shapes=False).select(F.col("l.id").alias("land_id"), F.col("r.id").alias("pending_id"))


@query(f"SELECT a.id AS land_id, b.id AS pending_id FROM u a JOIN n b ON {_MEET}", fx.SLANT)
def spatial_join_slanted(spark, d):
    """Parallelograms: the exact test judges those whose boxes meet."""
    return spatial.join(fx.land(spark, d, fx.SLANT), fx.pending(spark, d, fx.SLANT), shapes=False).select(F.col("l.id").alias("land_id"), F.col("r.id").alias("pending_id"))


@query(f"SELECT a.id AS land_id, b.id AS pending_id FROM u a JOIN n b ON {_MEET.replace('<=', '<')}", fx.SLANT)
def spatial_join_slanted_overlap(spark, d):
    return spatial.join(fx.land(spark, d, fx.SLANT), fx.pending(spark, d, fx.SLANT), "overlaps", shapes=False).select(F.col("l.id").alias("land_id"), F.col("r.id").alias("pending_id"))


@query("SELECT title_no, file_date, type = 'ccod' AS proprietor_uk_based, event_id FROM (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY title_no ORDER BY file_date DESC, type DESC, op <> 'D' DESC, event_id DESC) = 1) WHERE op = 'A'")
def ownership_cdc(spark, d):
    order = ["file_date", "type", F.expr("op <> 'D'"), "event_id"]
    changes = fx.changes(spark, d)
    out = ownership.applied(changes.filter("false"), changes, order)
    return out.select("title_no", "file_date", (F.col("type") == "ccod").alias("proprietor_uk_based"), "event_id")


@query("SELECT title_no, file_date, type, event_id FROM (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY title_no ORDER BY file_date DESC, type DESC, op <> 'D' DESC, event_id DESC) = 1) WHERE op = 'A'")
def ownership_stream(spark, d):
    """The same from a stream that keeps each title's last change, in two batches of files."""
    folder, changes = _folder(spark), fx.changes(spark, d)
    changes.repartition(8).write.parquet(f"{folder}/in")
    title_stream.follow(spark, f"{folder}/in", changes.schema, f"{folder}/log", f"{folder}/marks", files=4).awaitTermination()
    return title_stream.titles(spark, f"{folder}/log")


_FILES = "SELECT DISTINCT file_date, type, concat(upper(type), '_COU_', CAST(file_date AS STRING), '.zip') AS filename FROM ch"


@query(f"SELECT file_date, type, filename, coalesce(lead(file_date) OVER (ORDER BY file_date, type, filename) <> file_date, true) AS is_last_of_date FROM ({_FILES})")
def ownership_change_files(spark, d):
    files = fx.changes(spark, d).select("file_date", "type", F.concat(F.upper("type"), F.lit("_COU_"), F.col("file_date").cast("string"), F.lit(".zip")).alias("filename")).distinct()
    return ownership.change_files(files).select("file_date", "type", "filename", "is_last_of_date")


@query("SELECT title_no, tenure FROM o WHERE title_no NOT IN (SELECT title_no FROM ch WHERE op = 'D') UNION ALL SELECT DISTINCT title_no, 'Freehold' FROM ch WHERE op = 'A' AND title_no NOT IN (SELECT title_no FROM ch WHERE op = 'D') AND title_no NOT IN (SELECT title_no FROM o)")
def ownership_bulk(spark, d):
    """Bulk delete of titles with a D row, then upsert of titles that only have A rows."""
    own, changes = fx.titles(spark, d).select("title_no", "tenure"), fx.changes(spark, d)
    gone = changes.filter("op = 'D'")
    kept = tables.deleted(own, gone, "title_no")
    new = tables.deleted(changes.filter("op = 'A'").select("title_no").distinct(), gone, "title_no").join(own.select("title_no"), "title_no", "left_anti")
    return tables.upserted(kept, new.select("title_no", F.lit("Freehold").alias("tenure")), "title_no", ["tenure"])


@query("""SELECT coalesce(o.title_no, l.title_no) AS title_no, coalesce(l.type, o.tenure) AS tenure, coalesce(o.createdAt, l.file_date) AS createdAt
FROM o FULL OUTER JOIN (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY title_no ORDER BY event_id DESC) = 1) l ON o.title_no = l.title_no""")
def ownership_upsert(spark, d):
    """A batch with titles several times: the last row counts, createdAt stays."""
    rows = fx.changes(spark, d).select("title_no", F.col("type").alias("tenure"), F.col("file_date").alias("createdAt"), "event_id")
    return tables.upserted(fx.titles(spark, d).select("title_no", "tenure", "createdAt"), rows, "title_no", ["event_id"], keep=("createdAt",))


_SINCE = "(SELECT min(file_date) + 5 FROM ch)"
_UPDATED = """, e AS (SELECT * FROM ch {where}), l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY title_no ORDER BY file_date DESC, type DESC, op <> 'D' DESC, event_id DESC) = 1)
SELECT title_no, tenure FROM o WHERE title_no NOT IN (SELECT title_no FROM e) UNION ALL SELECT title_no, type FROM l WHERE op = 'A'"""


def _updated(spark, d, since):
    changes = fx.changes(spark, d).withColumn("tenure", F.col("type"))
    own = fx.titles(spark, d).select("title_no", "tenure")
    return ownership.updated(own if since is not None else own.filter("false"), changes, fx.changes(spark, d).agg(F.date_add(F.min("file_date"), 5).alias("file_date")) if since is not None else changes.select("file_date").filter("false"), own, ["file_date", "type", F.expr("op <> 'D'"), "event_id"])


@query(_UPDATED.format(where=f"WHERE file_date > {_SINCE}"))
def ownership_update(spark, d):
    """Change files after the date up to which the titles are."""
    return _updated(spark, d, 5)[0].select("title_no", "tenure")


@query(_UPDATED.format(where=""))
def ownership_bootstrap(spark, d):
    """Nothing ran before: the full set, then all change files since."""
    return _updated(spark, d, None)[0].select("title_no", "tenure")


@query(f"SELECT greatest({_SINCE}, max(file_date)) AS file_date FROM ch WHERE file_date > {_SINCE}")
def ownership_watermark(spark, d):
    return _updated(spark, d, 5)[1]


@query("SELECT max(id) AS id FROM n")
def largest_id(spark, d):
    return tables.largest_id(fx.pending(spark, d))


@query("SELECT count(*) AS n, count(*) AS n_ids, max(id) + (SELECT count(*) FROM fe) AS last_id, min(id) AS first_id FROM u HAVING false UNION ALL SELECT (SELECT count(*) FROM u) + (SELECT count(*) FROM fe), (SELECT count(*) FROM u) + (SELECT count(*) FROM fe), (SELECT max(id) FROM u) + (SELECT count(*) FROM fe), (SELECT min(id) FROM u)")
def land_appended(spark, d):
    """Shapes added to the land layer get the next ids without gaps."""
    out = tables.appended_shapes(fx.land(spark, d).select("id", "geom"), fx.features(spark, d).select("geom"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.max("id").alias("last_id"), F.min("id").alias("first_id"))


@query("SELECT id, tile_id FROM fe WHERE tile_id = 7")
def tile_features(spark, d):
    return parcels.features_of(fx.features(spark, d), 7).select("id", "tile_id")


@query(f"SELECT DISTINCT f.id, t.id AS tile_id FROM u t JOIN fe f ON t.id % 2 = 1 AND f.xmin <= t.xmax AND f.xmax >= t.xmin AND f.ymin <= t.ymax AND f.ymax >= t.ymin UNION ALL SELECT id, tile_id FROM fe WHERE tile_id % 2 = 0")
def tile_feature_cache(spark, d):
    """Features of even tiles are stored; those of the others come from the source."""
    land, features = fx.land(spark, d), fx.features(spark, d)
    return unregistered.with_features(land, features.filter("tile_id % 2 = 0"), features).select("id", "tile_id")


@query(f"SELECT poly_id, title_no, tenure FROM po WHERE {_BOX}")
def parcels_in_wkt(spark, d):
    x0, y0, x1, y1 = BOX
    wkt = f"POLYGON(({y0} {x0}, {y0} {x1}, {y1} {x1}, {y1} {x0}, {y0} {x0}))"
    return parcels.in_wkt(fx.parcels(spark, d), fx.titles(spark, d), wkt).select("poly_id", "title_no", "tenure")


@query(f"SELECT poly_id, proprietor_name_1 FROM po WHERE {_BOX} AND proprietor_category_1 = 'Local Authority' ORDER BY poly_id LIMIT 5000")
def boundaries_by_type(spark, d):
    """The search that a type names."""
    return parcels.boundaries(fx.parcels(spark, d), fx.titles(spark, d), fx.pending(spark, d), fx.land(spark, d), BOX, "localAuthority").select("poly_id", "proprietor_name_1")


@query("SELECT latest_ownership_data FROM r WHERE latest_ownership_data IS NOT NULL ORDER BY startedAt DESC, id DESC LIMIT 1")
def latest_ownership_date(spark, d):
    return runs.newest(fx.runs(spark, d), "latest_ownership_data").select("latest_ownership_data")


@query("SELECT id, unique_key, CAST(status AS INTEGER) AS status FROM r WHERE unique_key <> (SELECT unique_key FROM r ORDER BY startedAt DESC, id DESC LIMIT 1) ORDER BY startedAt DESC, id DESC LIMIT 1")
def last_run(spark, d):
    log = fx.runs(spark, d)
    now = runs.newest(log).select(F.col("unique_key").alias("_now"))
    rest = log.join(F.broadcast(now), F.col("unique_key") != F.col("_now"))  # one row
    return runs.newest(rest).select("id", "unique_key", F.col("status").cast("int").alias("status"))


@query("SELECT coalesce(bool_and(coalesce(status = -1 AND last_task = 'analyseInspire' AND last_poly_analysed = first_poly AND first_poly <> 0, false)), true) AS hit FROM (SELECT *, first_value(last_poly_analysed) OVER (ORDER BY startedAt DESC, id DESC) AS first_poly FROM r WHERE unique_key <> (SELECT unique_key FROM r ORDER BY startedAt DESC, id DESC LIMIT 1) ORDER BY startedAt DESC, id DESC LIMIT 2)")
def hit_max_retries(spark, d):
    log = fx.runs(spark, d)
    return runs.hit_max_retries(log, runs.newest(log).first()["unique_key"])


@query("SELECT startedAt FROM (SELECT startedAt, row_number() OVER (ORDER BY startedAt DESC, id DESC) AS n FROM r) WHERE n = (SELECT coalesce(min(n) - 1, 1) FROM (SELECT status, row_number() OVER (ORDER BY startedAt DESC, id DESC) AS n FROM r) WHERE n > 1 AND status <> -1)")
def run_chain_start(spark, d):
    return runs.chain_start(fx.runs(spark, d))


_SUNDAY = "(CAST(date_trunc('month', day) AS DATE) + CAST((7 - dayofweek(CAST(date_trunc('month', day) AS DATE))) % 7 AS INTEGER))"


@query(f"SELECT day, CAST(CASE WHEN day < {_SUNDAY} THEN {_SUNDAY} - INTERVAL 1 MONTH ELSE {_SUNDAY} END AS DATE) AS publish, strftime(day, '%Y-%m') AS month FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)")
def inspire_publish_date(spark, d):
    days = spark.read.parquet(f"{d}/orders.parquet").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", runs.publish_date(F.col("day")).alias("publish"), F.date_format("day", "yyyy-MM").alias("month"))


def _tiled(source: str) -> str:
    return f""", b AS (SELECT *, floor((xmax - xmin + 2e-2) / 1e-2) AS nx, floor((ymax - ymin + 2e-2) / 1e-2) AS ny FROM ({source})), g AS (
SELECT *, (xmin + xmax - nx * 1e-2) / 2e0 + ix * 1e-2 AS x0, (ymin + ymax - ny * 1e-2) / 2e0 + iy * 1e-2 AS y0 FROM b, range(0, 10) i(ix), range(0, 10) j(iy) WHERE ix < nx AND iy < ny), c AS (
SELECT id, CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy, greatest(x0, xmin) AS x0, greatest(y0, ymin) AS y0, least(x0 + 1e-2, xmax) AS x1, least(y0 + 1e-2, ymax) AS y1 FROM g)"""


@query(f"{_tiled('SELECT * FROM wi')} SELECT id, ix, iy, round({_area('x0', 'y0', 'x1', 'y1')}, 2) AS area FROM c WHERE x1 > x0 AND y1 > y0")
def polygon_tiling(spark, d):
    return spatial.tiles(fx.wide(spark, d), ["id"]).select("id", "ix", "iy", F.round(geometry.area(F.col("geom")), 2).alias("area"))


_DEGREE = f"(180e0 / (pi() * {R}))"
_WIDER = f"({_DEGREE} / cos(radians((ymin + ymax) / 2e0)))"


def _grown(metres: str, places: str) -> str:
    """SQL of a box grown on all sides, on a grid of 1 / places degrees."""
    grow = {"xmin": f"xmin - {metres} * {_WIDER}", "ymin": f"ymin - {metres} * {_DEGREE}", "xmax": f"xmax + {metres} * {_WIDER}", "ymax": f"ymax + {metres} * {_DEGREE}"}
    return ", ".join(f"floor(({e}) * {places} + 5e-1) / {places} AS {c}" for c, e in grow.items())


@query(f"{_tiled('SELECT id, ' + _grown('-50e0', '1e9') + ' FROM wi')} SELECT id AS country_id, ix, iy, round({_area('x0', 'y0', 'x1', 'y1')}, 0) AS area FROM c WHERE x1 > x0 AND y1 > y0 AND {_area('x0', 'y0', 'x1', 'y1')} > 2000e0")
def country_tiles(spark, d):
    """Countries shrunk by 50 m, in tiles."""
    out = unregistered.country_tiles(fx.wide(spark, d))
    return out.select("country_id", "ix", "iy", F.round(geometry.area(F.col("geom")), 0).alias("area"))


def _free(lands: str, cuts: str) -> str:
    """SQL of (id, area) of lands less cuts (id of the land, box): the cells between all their edges that no cut covers."""
    return f"""
, la AS ({lands}), cu AS ({cuts})
, xs AS (SELECT DISTINCT id, unnest([xmin, xmax]) AS x FROM (SELECT id, xmin, xmax FROM la UNION ALL SELECT id, xmin, xmax FROM cu))
, ys AS (SELECT DISTINCT id, unnest([ymin, ymax]) AS y FROM (SELECT id, ymin, ymax FROM la UNION ALL SELECT id, ymin, ymax FROM cu))
, xi AS (SELECT id, x AS x0, lead(x) OVER (PARTITION BY id ORDER BY x) AS x1 FROM xs)
, yi AS (SELECT id, y AS y0, lead(y) OVER (PARTITION BY id ORDER BY y) AS y1 FROM ys)
, ce AS (SELECT xi.id, x0, x1, y0, y1 FROM xi JOIN yi ON xi.id = yi.id WHERE x1 IS NOT NULL AND y1 IS NOT NULL)
, fr AS (SELECT id, sum({_area("x0", "y0", "x1", "y1")}) AS area FROM ce WHERE NOT EXISTS (SELECT 1 FROM cu WHERE cu.id = ce.id AND cu.xmin <= ce.x0 AND cu.xmax >= ce.x1 AND cu.ymin <= ce.y0 AND cu.ymax >= ce.y1) GROUP BY id)
"""


def _clean(c: str) -> str:
    return f"floor({c} * 1e7 + 5e-1) / 1e7"


_LAND = f"SELECT id, {', '.join(f'{_clean(c)} AS {c}' for c in fx.BOX)} FROM u"


def _cuts(source: str, box: str) -> str:
    """SQL of the boxes of `source` (which has the columns box names) on each land shape, within it."""
    return f"SELECT l.id, greatest(l.xmin, k.xmin) AS xmin, greatest(l.ymin, k.ymin) AS ymin, least(l.xmax, k.xmax) AS xmax, least(l.ymax, k.ymax) AS ymax FROM la l JOIN (SELECT {box} FROM {source}) k ON l.xmin < k.xmax AND k.xmin < l.xmax AND l.ymin < k.ymax AND k.ymin < l.ymax"


_CLEAN_BOX = ", ".join(f"{_clean(c)} AS {c}" for c in fx.BOX)
_TRUNCATED = ", ".join(f"floor({c} * 1e6 + 5e-1) / 1e6 AS {c}" for c in fx.BOX)


@query(f"{_CASCADE} {_free(_LAND, _cuts('f WHERE match_type <> ' + chr(39) + 'exact' + chr(39), _TRUNCATED))} SELECT id AS land_id, round(area, 1) AS area FROM fr WHERE area > 1e0")
def clip_unregistered(spark, d):
    """What each land shape has left once the pending shapes are off; these leave no slivers here."""
    out = unregistered.clipped(fx.land(spark, d), _classified(spark, d).transform(spatial.with_box))
    return out.groupBy("land_id").agg(F.round(F.sum(geometry.area(F.col("geom"))), 1).alias("area"))


@query(f"{_cascade(fx.SLANT)} {_free(_LAND, _cuts('f WHERE match_type <> ' + chr(39) + 'exact' + chr(39), _CLEAN_BOX))} SELECT id AS land_id, round(area / 10) * 10 AS area FROM fr WHERE area > 1e0", fx.SLANT)
def clip_unregistered_slanted(spark, d):
    """Areas are those of the shapes set upright again, as the area of long slanted edges depends a little on where these have vertices."""
    out = unregistered.clipped(fx.land(spark, d, fx.SLANT), _classified(spark, d, fx.SLANT).transform(spatial.with_box))
    upright = F.struct(F.lit("Polygon").alias("type"), F.transform(F.col("geom.coordinates"), lambda r: F.transform(r, lambda p: F.array(p[0] - fx.SLANT * p[1], p[1]))).alias("coordinates"))
    return out.groupBy("land_id").agg((F.round(F.sum(geometry.area(upright)) / 10) * 10).alias("area"))


@query(f"{_free('SELECT id, xmin, ymin, xmax, ymax - 2e-4 AS ymax FROM u', _cuts('n', _grown('0.2e0', '1e6')))} SELECT id AS tile_id, round(area / 1e4, 1) AS hectares FROM fr WHERE area > 1e0")
def unregistered_init(spark, d):
    """Each tile's land less its parcels; in tenths of a hectare, as rounded corners take a metre or two off."""
    out = unregistered.built(fx.land(spark, d), fx.pending(spark, d), fx.features(spark, d))
    return out.groupBy("tile_id").agg(F.round(F.sum(geometry.area(F.col("geom"))) / 1e4, 1).alias("hectares"))


def _gap(a: str, b: str) -> str:
    """SQL of the metres between two boxes."""
    dx, dy = (f"greatest(0e0, {a}.{c}min - {b}.{c}max, {b}.{c}min - {a}.{c}max) / {_DEGREE}" for c in "xy")
    return f"sqrt(pow(({dx}) * cos(radians({a}.ymin)), 2) + pow({dy}, 2))"


@query(f"SELECT a.poly_id, b.poly_id AS other_id, round({_gap('a', 'b')}, 3) + 0e0 AS metres FROM ln a JOIN ln b ON a.poly_id <> b.poly_id AND abs(a.xmin - b.xmin) < 1e-2 AND abs(a.ymin - b.ymin) < 1e-2 WHERE {_gap('a', 'b')} <= 5e0 ")
def parcels_adjacent(spark, d):
    """New parcels within 5 m of each other."""
    new = fx.edition(spark, d, "new")
    return lineage.adjacent(new, new).select("poly_id", "other_id", (F.round("metres", 3) + F.lit(0.0)).alias("metres"))


def _common_box(a: str, b: str) -> str:
    return _area(*[f"{f}({a}.{c}, {b}.{c})" for f, c in (("greatest", "xmin"), ("greatest", "ymin"), ("least", "xmax"), ("least", "ymax"))])


def _of(a: str) -> str:
    return _area(*[f"{a}.{c}" for c in fx.BOX])


_COVERED = f", cv AS (SELECT o.poly_id AS old_id, n.poly_id AS new_id, {_common_box('o', 'n')} AS common, {_of('o')} AS a, {_of('n')} AS b FROM lo o JOIN ln n ON o.xmin < n.xmax AND n.xmin < o.xmax AND o.ymin < n.ymax AND n.ymin < o.ymax WHERE {_common_box('o', 'n')} > 2e0)"


@query(f"{_COVERED} SELECT old_id, new_id, round(common, 2) AS common, round(100e0 * common / a, 4) AS old_share, round(100e0 * common / b, 4) AS new_share FROM cv")
def parcels_covered(spark, d):
    """What old and new parcels cover of each other."""
    out = lineage.covered(fx.edition(spark, d, "old"), fx.edition(spark, d, "new"))
    return out.select("old_id", "new_id", F.round("common", 2).alias("common"), F.round("old_share", 4).alias("old_share"), F.round("new_share", 4).alias("new_share"))


@query(f"""{_COVERED}, e AS (SELECT old_id AS a, -new_id AS b FROM cv UNION SELECT -new_id, old_id FROM cv), reach AS (
SELECT a, a AS z FROM e UNION SELECT a, b FROM e UNION SELECT x.a, y.b FROM e x JOIN e y ON x.b = y.a UNION SELECT x.a, z.b FROM e x JOIN e y ON x.b = y.a JOIN e z ON y.b = z.a UNION SELECT x.a, w.b FROM e x JOIN e y ON x.b = y.a JOIN e z ON y.b = z.a JOIN e w ON z.b = w.a),
fam AS (SELECT a, min(z) FILTER (WHERE z > 0) AS family FROM reach GROUP BY a), g AS (SELECT family, list(a ORDER BY a) FILTER (WHERE a > 0) AS o, list(-a ORDER BY -a) FILTER (WHERE a < 0) AS n FROM fam GROUP BY family)
SELECT family, array_to_string(o, ',') AS old_ids, array_to_string(n, ',') AS new_ids, CASE WHEN len(o) = 1 AND len(n) = 1 THEN 'one' WHEN len(n) = 1 THEN 'merged' WHEN len(o) = 1 THEN 'segmented' ELSE 'mixed' END AS kind FROM g""")  # fmt: skip
def parcel_families(spark, d):
    """Groups of old and new parcels that land went between."""
    out = lineage.families(lineage.covered(fx.edition(spark, d, "old"), fx.edition(spark, d, "new")))
    return out.select("family", _joined("old_ids"), _joined("new_ids"), "kind")


def _joined(ids: str):
    return F.array_join(F.col(ids).cast("array<string>"), ",").alias(ids)


def _strips(a: str, b: str) -> str:
    """SQL of the boxes that a box a has outside of b: here there is one at most."""
    sides = [
        (f"{a}.xmin", f"{a}.ymin", f"least({a}.xmax, {b}.xmin)", f"{a}.ymax"),
        (f"greatest({a}.xmin, {b}.xmax)", f"{a}.ymin", f"{a}.xmax", f"{a}.ymax"),
        (f"greatest({a}.xmin, {b}.xmin)", f"{a}.ymin", f"least({a}.xmax, {b}.xmax)", f"least({a}.ymax, {b}.ymin)"),
        (f"greatest({a}.xmin, {b}.xmin)", f"greatest({a}.ymin, {b}.ymax)", f"least({a}.xmax, {b}.xmax)", f"{a}.ymax"),
    ]
    return " UNION ALL ".join(f"SELECT n.id, n.poly_id, {x0} AS xmin, {y0} AS ymin, {x1} AS xmax, {y1} AS ymax FROM op n JOIN lo o USING (poly_id) WHERE {_area(x0, y0, x1, y1)} > 2e0" for x0, y0, x1, y1 in sides)


_HIT = "s.xmin < m.xmax AND m.xmin < s.xmax AND s.ymin < m.ymax AND m.ymin < s.ymax AND m.poly_id <> s.poly_id"
_DECIDED = f"""
, op AS (SELECT n.* FROM ln n JOIN lo o ON n.poly_id = o.poly_id WHERE {_common_box("n", "o")} / ({_of("n")} + {_of("o")} - {_common_box("n", "o")}) <= 0.95e0)
, gs AS ({_strips("n", "o")}), ls AS ({_strips("o", "n")})
, gm AS (SELECT s.id, s.poly_id, m.poly_id AS other, {_common_box("s", "m")} AS common, w.poly_id IS NULL AS gone, w.poly_id IS NOT NULL AND {_gap("n", "w")} <= 5e0 AS near, {_common_box("m", "n")} / {_of("m")} > 0.95e0 AS inside
  FROM gs s JOIN lo m ON {_HIT} JOIN op n ON n.id = s.id LEFT JOIN ln w ON w.poly_id = m.poly_id WHERE {_common_box("s", "m")} > 2e0)
, lm AS (SELECT s.id, s.poly_id, m.poly_id AS other, {_common_box("s", "m")} AS common, w.poly_id IS NULL AS fresh, w.poly_id IS NOT NULL AND {_gap("o", "w")} <= 5e0 AS near, {_common_box("m", "o")} / {_of("m")} > 0.95e0 AS inside
  FROM ls s JOIN ln m ON {_HIT} JOIN lo o ON o.poly_id = s.poly_id LEFT JOIN lo w ON w.poly_id = m.poly_id WHERE {_common_box("s", "m")} > 2e0)
, ga AS (SELECT id, list_sort(coalesce(list(DISTINCT other) FILTER (WHERE gone), [])) AS merged, list_sort(coalesce(list(DISTINCT other) FILTER (WHERE NOT gone AND NOT near), [])) AS strange, bool_or(NOT near AND NOT (gone AND inside)) AS bad FROM gm GROUP BY id)
, la AS (SELECT id, list_sort(coalesce(list(DISTINCT other) FILTER (WHERE NOT near), [])) AS segments, bool_or(NOT near AND NOT (fresh AND inside)) AS bad FROM lm GROUP BY id)
, gi AS (SELECT id, sum({_of("gs")}) - coalesce((SELECT sum(common) FROM gm WHERE gm.id = gs.id), 0e0) > 2e0 AS open FROM gs GROUP BY id)
, li AS (SELECT id, sum({_of("ls")}) - coalesce((SELECT sum(common) FROM lm WHERE lm.id = ls.id), 0e0) > 2e0 AS open FROM ls GROUP BY id)
, dv AS (SELECT op.id, op.poly_id, coalesce(ga.merged, []) AS merged, coalesce(ga.strange, []) AS strange, coalesce(la.segments, []) AS segments, coalesce(ga.bad, false) AS fa, coalesce(la.bad, false) AS fb, coalesce(gi.open, false) AS ia, coalesce(li.open, false) AS ib
  FROM op LEFT JOIN ga USING (id) LEFT JOIN la USING (id) LEFT JOIN gi USING (id) LEFT JOIN li USING (id))
, de AS (SELECT id, poly_id, CASE WHEN fa OR fb THEN 'fail' WHEN (ia OR len(merged) > 0) AND (ib OR len(segments) > 0) THEN 'mergedAndSegmented' WHEN ia THEN 'mergedIncomplete' WHEN ib THEN 'segmentedIncomplete' WHEN len(merged) > 0 THEN 'merged' WHEN len(segments) > 0 THEN 'segmented' ELSE 'boundariesShifted' END AS decision,
  merged AS merged_ids, CASE WHEN fa THEN strange ELSE segments END AS segment_ids FROM dv)
"""
_DECISIONS = " SELECT id, poly_id, decision, array_to_string(merged_ids, ',') AS merged_ids, array_to_string(segment_ids, ',') AS segment_ids FROM de"


def _editions(spark, d, slant=0.0):
    return fx.edition(spark, d, "old", slant), fx.edition(spark, d, "new", slant)


def _open(spark, d, slant=0.0):
    """The classifier's rows on the scenes, those it has no match for, and the editions."""
    old, new = _editions(spark, d, slant)
    rows = matching.classified(new, old, fx.titles(spark, d))
    return rows, lineage.unmatched(rows), old, new


def _decided(spark, d, slant=0.0):
    _, open_, old, new = _open(spark, d, slant)
    return lineage.decided(open_, old, new).select("id", "poly_id", "decision", _joined("merged_ids"), _joined("segment_ids"))


@query(_DECIDED + _DECISIONS)
def lineage_decisions(spark, d):
    """Merged, segmented, shifted: what became of known parcels that no plain match fits."""
    return _decided(spark, d)


@query(_DECIDED + _DECISIONS, fx.SLANT)
def lineage_decisions_slanted(spark, d):
    return _decided(spark, d, fx.SLANT)


#: No decision here is failed by one that has itself been failed.
_RESOLVED = f"""{_DECIDED}
, ev AS (SELECT id AS by_id, decision = 'fail' AS bad, unnest(segment_ids) AS poly_id FROM de WHERE decision <> 'boundariesShifted')
, st AS (SELECT * FROM de WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.poly_id = de.poly_id AND ev.bad AND ev.by_id < de.id))
, la2 AS (SELECT poly_id, arg_max(bad, by_id) AS bad FROM ev WHERE by_id IN (SELECT id FROM st) GROUP BY poly_id)
, own AS (SELECT n.id, n.poly_id, CASE WHEN o.poly_id IS NULL THEN (CASE WHEN EXISTS (SELECT 1 FROM lo z WHERE n.xmin <= z.xmax AND z.xmin <= n.xmax AND n.ymin <= z.ymax AND z.ymin <= n.ymax) THEN 'fail' ELSE 'newBoundary' END) WHEN st.id IS NOT NULL THEN st.decision WHEN de.id IS NOT NULL THEN 'fail' ELSE 'exact' END AS match_type
  FROM ln n LEFT JOIN lo o ON n.poly_id = o.poly_id LEFT JOIN de ON de.id = n.id LEFT JOIN st ON st.id = n.id)"""


@query(f"{_RESOLVED} SELECT own.id, own.poly_id, CASE WHEN la2.bad THEN 'fail' WHEN NOT la2.bad THEN 'newSegment' ELSE match_type END AS match_type FROM own LEFT JOIN la2 ON own.poly_id = la2.poly_id")
def lineage_resolved(spark, d):
    """Match types once decisions have acted on other rows, in order of id."""
    rows, open_, old, new = _open(spark, d)
    return lineage.resolved(rows.select("id", "poly_id", "match_type"), lineage.decided(open_, old, new))[0]


@query(f"{_RESOLVED} SELECT DISTINCT unnest(merged_ids) AS poly_id FROM st WHERE decision <> 'fail'")
def lineage_deletions(spark, d):
    """Old parcels that merges take away."""
    rows, open_, old, new = _open(spark, d)
    return lineage.resolved(rows.select("id", "poly_id", "match_type"), lineage.decided(open_, old, new))[1]


@query(f"{_COVERED} SELECT new_id AS poly_id, old_id, round(100e0 * common / a, 4) AS old_share, round(100e0 * common / b, 4) AS new_share FROM cv WHERE old_id NOT IN (SELECT poly_id FROM ln) AND new_id NOT IN (SELECT poly_id FROM lo) AND common > 0.95e0 * least(a, b) QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY greatest(common / a, common / b) DESC, old_id) = 1")
def new_in_old(spark, d):
    """Old parcels, gone since, that contain a new number's or lie in it."""
    old, new = _editions(spark, d)
    out = lineage.containing(new.join(old.select("poly_id"), "poly_id", "left_anti"), old, new)
    return out.select("poly_id", "old_id", F.round("old_share", 4).alias("old_share"), F.round("new_share", 4).alias("new_share"))


@query("SELECT o.poly_id AS old_id, n.poly_id AS new_id, CAST(NULL AS VARCHAR) AS old_title_no FROM lo o JOIN ln n ON o.xmin = n.xmin AND o.ymin = n.ymin AND o.xmax = n.xmax AND o.ymax = n.ymax WHERE o.poly_id NOT IN (SELECT poly_id FROM ln) AND n.poly_id NOT IN (SELECT poly_id FROM lo)")
def parcels_renumbered(spark, d):
    """Rings that go on under a new number, wherever they start and whichever way they turn."""
    old, new = _editions(spark, d)
    return lineage.renamed(new.join(old.select("poly_id"), "poly_id", "left_anti"), old, new).select("old_id", "new_id", "old_title_no")


@query(f"""{_RESOLVED}, fin AS (SELECT own.id, own.poly_id, CASE WHEN la2.bad THEN 'fail' WHEN NOT la2.bad THEN 'newSegment' ELSE match_type END AS match_type FROM own LEFT JOIN la2 ON own.poly_id = la2.poly_id)
, rn AS (SELECT o.poly_id AS old_id, n.poly_id AS new_id FROM lo o JOIN ln n ON o.xmin = n.xmin AND o.ymin = n.ymin AND o.xmax = n.xmax AND o.ymax = n.ymax JOIN fin ON fin.id = n.id AND fin.match_type = 'fail' WHERE o.poly_id NOT IN (SELECT poly_id FROM ln) AND n.poly_id NOT IN (SELECT poly_id FROM lo))
, dl AS (SELECT unnest(merged_ids) AS poly_id FROM st WHERE decision <> 'fail' UNION SELECT old_id FROM rn)
, ok AS (SELECT n.* FROM ln n JOIN fin USING (id) WHERE fin.match_type <> 'fail' OR n.poly_id IN (SELECT new_id FROM rn))
SELECT coalesce(o.poly_id, n.poly_id) AS poly_id, round(coalesce(n.xmax, o.xmax), 9) AS xmax, n.poly_id IS NOT NULL AS is_updated FROM (SELECT * FROM lo WHERE poly_id NOT IN (SELECT poly_id FROM dl)) o FULL OUTER JOIN ok n ON o.poly_id = n.poly_id""")
def analysis_with_relations(spark, d):
    """The analysis with merges, segments and new numbers: the parcels that it leaves."""
    old, new = _editions(spark, d)
    gone, land = fx.deletions(spark, d).filter("false"), fx.land(spark, d)
    return analysis.analysed(new, old, fx.titles(spark, d), gone, land, relations=True)["parcels"].select("poly_id", F.round("xmax", 9).alias("xmax"), "is_updated")
