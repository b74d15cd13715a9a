"""Kernel, classifier cases, sources, runs and the change stream."""

import datetime as dt
import json
import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import geometry, kernel
from tessera.operators import lineage, matching, ownership, parcels, spatial, tables, unregistered
from tessera.plans import analysis, runs
from tessera.sources import files, gridshift
from tessera.streaming import changes

#: Triangles on a parallel: their area is half of R^2 * width * (sin(top) - sin(base)).
SMALL = [[-1.5, 51.2], [-1.4998, 51.2], [-1.49993, 51.2002], [-1.5, 51.2]]
FAR = [[-1.45, 51.17], [-1.442, 51.17], [-1.447, 51.176], [-1.45, 51.17]]
SMALL_M2 = 6371008.8**2 / 2 * math.radians(2e-4) * (math.sin(math.radians(51.2002)) - math.sin(math.radians(51.2)))


def shapes(spark, rows, columns):
    df = spark.createDataFrame([(*r[:-1], {"type": "Polygon", "coordinates": [r[-1]]}) for r in rows], f"{columns}, geom {geometry.POLYGON}")
    return spatial.with_box(df)


def classify(spark, old, new, address=None, place=None):
    p = shapes(spark, [(1, "T1", old)], "poly_id long, title_no string")
    o = spark.createDataFrame([("T1", "Freehold", address)], "title_no string, tenure string, property_address string")
    n = shapes(spark, [(1, 1, "c", False, None, new)], "id long, poly_id long, council string, accepted boolean, match_type string")
    places = spark.createDataFrame([(address, [place])], "property_address string, places array<struct<lng:double,lat:double>>") if place else None
    return matching.classified(n, p, o, places).first()


def moved(ring, dx, dy):
    return [[x + dx, y + dy] for x, y in ring]


def test_exact(spark):
    r = classify(spark, SMALL, SMALL)
    assert (r.match_type, r.pct, r.accepted) == ("exact", 100, True)


@pytest.mark.parametrize("dx, dy", [(9e-5, -3e-5), (-2e-6, 5e-5)])
def test_offset(spark, dx, dy):
    r = classify(spark, SMALL, moved(SMALL, dx, dy))
    assert r.match_type == "exactOffset" and abs(r.stats.lng_mean - dx) < 1e-9


def test_large_offset_fails(spark):
    r = classify(spark, SMALL, moved(SMALL, 5e-4, -2e-4))
    assert r.match_type == "fail" and r.pct < 100


def test_jitter_overlaps(spark):
    rng = random.Random(5)
    ring = [[x + rng.uniform(0, 2e-6), y - rng.uniform(0, 2e-6)] for x, y in SMALL[:3]]
    r = classify(spark, SMALL, [*ring, ring[0]])
    assert r.match_type in ("highOverlap", "exact") and r.pct > 95


def test_moved(spark):
    x, y = (min(p[0] for p in FAR) + max(p[0] for p in FAR)) / 2, (min(p[1] for p in FAR) + max(p[1] for p in FAR)) / 2
    near, off = (x + 3e-4, y), (x + 5e-3, y)
    assert classify(spark, SMALL, FAR, "123 Fake St", near).match_type == "moved"
    assert classify(spark, SMALL, FAR, "123 Fake St", off).match_type == "fail"
    assert classify(spark, SMALL, FAR).match_type == "fail"
    assert classify(spark, SMALL, FAR, "123 Fake St").match_type == "fail"


def test_areas(spark):
    df = shapes(spark, [(1, SMALL)], "id long")
    assert abs(df.select(geometry.area(F.col("geom"))).first()[0] - SMALL_M2) < 1e-3
    assert abs(kernel.area([[SMALL]]) - SMALL_M2) < 1e-3


def box(x0, y0, x1, y1):
    return [[[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]]


coordinate = st.integers(0, 12).map(lambda i: i / 1000)


@settings(max_examples=60, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(*[st.lists(st.tuples(coordinate, coordinate), min_size=3, max_size=6, unique=True)] * 2)
def test_overlay_laws(a, b):
    def hull(points):
        points = sorted(points)
        out = []
        for half in (points, points[::-1]):
            part = []
            for p in half:
                while len(part) > 1 and (part[-1][0] - part[-2][0]) * (p[1] - part[-2][1]) - (part[-1][1] - part[-2][1]) * (p[0] - part[-2][0]) <= 0:
                    part.pop()
                part.append(p)
            out += part[:-1]
        return [[[list(p) for p in [*out, out[0]]]]] if len(out) > 2 else []

    p, q = hull(a), hull(b)
    if not p or not q:
        return
    both, either = kernel.area(kernel.intersection(p, q)), kernel.area(kernel.union(p, q))
    assert abs(kernel.area(p) + kernel.area(q) - both - either) < 1 + 1e-6 * either
    rest = kernel.difference(p, q)
    assert abs(kernel.area(p) - kernel.area(rest) - both) < 1 + 1e-6 * either
    assert kernel.area(kernel.intersection(rest, q)) < 1
    if both > 1:
        assert kernel.touches_or_meets(p, q)


def test_overlay_hole_and_buffer():
    ring = kernel.difference(box(0, 0, 0.01, 0.01), box(0.003, 0.003, 0.006, 0.006))
    assert len(ring) == 1 and len(ring[0]) == 2
    square = box(0, 51, 0.001, 51.001)
    side, height = 0.001 * math.cos(math.radians(51.0005)) * 111194.93, 0.001 * 111194.93
    grown = kernel.area(kernel.buffered(square, 5.0))
    assert abs(grown - (side * height + 2 * 5 * (side + height) + math.pi * 25)) < 0.01 * grown
    assert kernel.buffered(square, -60.0) == []
    assert unregistered.is_sliver(box(0, 51, 0.001, 51.00002)[0]) and not unregistered.is_sliver(square[0])


def test_touch_is_meeting_but_no_overlap(spark):
    a = shapes(spark, [(1, box(0.0, 0.0, 0.001, 0.001)[0][0]), (2, SMALL)], "id long")
    b = shapes(spark, [(7, box(0.001, 0.0, 0.002, 0.001)[0][0]), (8, moved(SMALL, 1e-5, 0))], "id long")
    pairs = lambda how: {(r.a, r.b) for r in spatial.join(a, b, how).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).collect()}
    assert pairs("meets") == {(1, 7), (2, 8)} and pairs("overlaps") == {(2, 8)}


def test_areas_of_search(spark):
    p = shapes(spark, [(1, "T1", SMALL), (2, None, FAR)], "poly_id long, title_no string")
    o = spark.createDataFrame([("T1", "Leasehold", "Café Diocese")], "title_no string, tenure string, proprietor_name_1 string")
    area = [[[-1.501, 51.2], [-1.499, 51.2], [-1.5, 51.202], [-1.501, 51.2]]]
    assert [r.poly_id for r in parcels.in_polygon(p, o, area).collect()] == [1]
    assert parcels.in_polygon(p, o, area, include_leaseholds=False).collect() == []
    assert parcels.by_proprietor(p, o, "cafe diocese").count() == 1
    with pytest.raises(ValueError):
        parcels.by_ids(p, o)
    wkt = spark.createDataFrame([("POLYGON((51.2 -1.501, 51.2 -1.499, 51.202 -1.5, 51.2 -1.501))",)], "t string")
    assert wkt.select(geometry.from_wkt(F.col("t"))["coordinates"].alias("c")).first().c == area


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Title Number,Tenure,Property Address,Proprietor Name (1),Company Registration No. (1),Proprietorship Category (1),Proprietor (1) Address (1),Date Proprietor Added,Change Indicator\nT1,,"1, High St",X,,Local Authority,,03-02-2020,A\nT2,Freehold,,Y,9,,A,bad,D\nRow Count:,2,,,,,,,\n')
    out = {r.title_no: r for r in files.named(files.ownership_csv(spark, str(tmp_path / "a.csv")), overseas=True).collect()}
    assert set(out) == {"T1", "T2"} and out["T1"].date_proprietor_added == dt.date(2020, 2, 3) and out["T2"].date_proprietor_added is None
    assert out["T1"].proprietor_name_1 == "X" and out["T1"].proprietor_category_1 == "Local Authority" and out["T2"].property_address is None and not out["T1"].proprietor_uk_based
    feature = lambda g: {"type": "Feature", "properties": {"CTRY24NM": "Wales"}, "geometry": g}
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature({"type": "Polygon", "coordinates": [SMALL]}), feature({"type": "MultiPolygon", "coordinates": [[SMALL], [FAR]]})]}))
    assert [r.geom.coordinates for r in files.geojson(spark, str(tmp_path / "g.json")).collect()] == [[SMALL], [SMALL], [FAR]]
    p = files.to_wgs84(pd.Series([651409.903]), pd.Series([313177.270])).iloc[0]
    assert abs(p.lat - 52.65798) < 2e-4 and abs(p.lng - 1.71605) < 2e-4
    (tmp_path / "x.gml").write_text('<?xml version="1.0"?><c xmlns:LR="lr" xmlns:gml="gml"><m><LR:PREDEFINED><LR:INSPIREID>77</LR:INSPIREID><LR:GEOMETRY><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>651409.9 313177.2 651420 313177 651415 313190 651409.9 313177.2</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></LR:GEOMETRY></LR:PREDEFINED></m></c>')
    rows = files.gml(spark, str(tmp_path / "x.gml"), "Anywhere").collect()
    assert len(rows) == 1 and rows[0].poly_id == 77 and len(rows[0].geom.coordinates[0]) == 4
    for names in (["a", "b"], ["b"]):
        files.write_councils(spark.createDataFrame([(i, c) for i, c in enumerate(names)], "i long, council string"), str(tmp_path / "n"))
    assert sorted(r.council for r in spark.read.parquet(str(tmp_path / "n")).collect()) == ["a", "b"]
    councils = spark.createDataFrame([(1, "Adur"), (2, "Bath"), (3, "York")], "ordinal int, council string")
    assert [r.council for r in files.councils_after(councils, "Bath").collect()] == ["York"]


def test_changes_equal_one_by_one(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"T{rng.randrange(30)}", dt.date(2024, 1, rng.randrange(1, 9)), rng.choice(["ccod", "ocod"]), rng.choice("AD"), i) for i in range(300)]
    state = {}
    for t, day, kind, op, i in sorted(rows, key=lambda r: (r[1], r[2], r[3] != "D", r[4])):
        state.pop(t, None) if op == "D" else state.__setitem__(t, i)
    schema = "title_no string, file_date date, type string, op string, event_id long"
    df = spark.createDataFrame(rows, schema)
    order = ["file_date", "type", F.expr("op <> 'D'"), "event_id"]
    assert {r.title_no: r.event_id for r in ownership.applied(df.filter("false"), df, order).collect()} == state
    for day in sorted({r[1] for r in rows}):
        df.filter(F.col("file_date") == day).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = changes.follow(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    last = max(int(p.name[2:]) for p in (tmp_path / "out").glob("v=*"))
    assert {r.title_no: r.event_id for r in spark.read.parquet(str(tmp_path / f"out/v={last}")).collect()} == state


def test_runs(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, unique_key string, startedAt timestamp, status int, last_task string, last_poly_analysed long")
    assert runs.hit_max_retries(empty).first().hit is True and runs.chain_start(empty).collect() == []
    at = [dt.datetime(2024, 1, i) for i in range(1, 6)]
    log = spark.createDataFrame([(i, f"k{i}", t, s, "analyseInspire", 9) for i, (t, s) in enumerate(zip(at, (0, 0, -1, -1, 1), strict=True))], empty.schema)
    assert runs.chain_start(log).first().startedAt == at[2]
    for positions, key, hit in (([9, 9], None, True), ([9, 8], None, False), ([None, None], None, False), ([0, 0], None, False), ([9, 9, 4], "k2", True), ([9, 9, 4], None, False)):
        rows = [(i, f"k{i}", at[i], -1 if i < 2 else 1, "analyseInspire", x) for i, x in enumerate(positions)]
        assert runs.hit_max_retries(spark.createDataFrame(rows, empty.schema), key).first().hit is hit, positions
    assert runs.tasks_between("nope", "analyseInspire") == runs.TASKS[:2] and runs.resume_position(None, True) == 1 and runs.resume_position(4, True) == 6
    log = runs.RunLog(spark, str(tmp_path / "log"))
    with pytest.raises(ZeroDivisionError):
        runs.triggered(log, {t: (lambda: 1 / 0) for t in runs.TASKS})
    assert (log.latest().first().status, log.latest().first().last_task) == (runs.STOPPED, "ownerships")
    assert runs.duration(3720) == "1h 2min"


@pytest.mark.parametrize("shape, sliver", [([(0, 0), (40, 0), (40, 30), (0, 30)], False), ([(0, 0), (100, 0), (100, 3), (0, 3)], True), ([(0, 0), (50, 0), (50, 3), (20, 3), (20, 23), (0, 23)], False), ([(0, 0), (60, 0), (0, 5)], False), ([(0, 0), (4, 0), (4, 4), (0, 4)], True)])
def test_slivers(shape, sliver):
    k = 180 / (math.pi * 6371008.8)
    ring = [[-5 + x * k / 0.6427876, 50 + y * k] for x, y in [*shape, shape[0]]]
    assert unregistered.is_sliver([ring]) is sliver


def test_buffers_of_odd_shapes():
    """An L and a ring grow and shrink by their outlines; a hole smaller than the distance closes."""
    k = 180 / (math.pi * 6371008.8)
    at = lambda points: [[x * k, y * k] for x, y in [*points, points[0]]]
    ell = [[at([(0, 0), (100, 0), (100, 40), (40, 40), (40, 100), (0, 100)])]]
    size = 100 * 40 + 40 * 60
    arc = lambda d, n: n * d * d * 8 * math.sin(math.pi / 16) / 2
    assert abs(kernel.area(kernel.buffered(ell, 5)) - (size + 400 * 5 + arc(5, 5) - 25)) < 0.05 * 5
    assert abs(kernel.area(kernel.buffered(ell, -5)) - (size - 400 * 5 + 5 * 25 - arc(5, 1))) < 0.05 * 5
    ring = [[at([(0, 0), (100, 0), (100, 100), (0, 100)]), at([(40, 40), (60, 40), (60, 60), (40, 60)])]]
    grown, shrunk = kernel.buffered(ring, 5), kernel.buffered(ring, -5)
    assert [len(p) for p in grown] == [2] and abs(kernel.area(grown) - (10000 + 400 * 5 + arc(5, 4) - 100)) < 1
    assert [len(p) for p in shrunk] == [2] and abs(kernel.area(shrunk) - (90 * 90 - 400 - 80 * 5 - arc(5, 4))) < 1
    assert [len(p) for p in kernel.buffered(ring, 11)] == [1]


def test_overlay_of_parallelograms_and_shared_borders():
    a = [[[[0, 0], [0.004, 0], [0.006, 0.004], [0.002, 0.004], [0, 0]]]]
    b = [[[[0.002, 0], [0.006, 0], [0.008, 0.004], [0.004, 0.004], [0.002, 0]]]]
    side = kernel.area(a)
    assert abs(kernel.area(kernel.intersection(a, b)) - side / 2) < 1 and abs(kernel.area(kernel.union(a, b)) - 1.5 * side) < 1
    touching = [[[[x + 0.004, y] for x, y in a[0][0]]]]
    assert kernel.intersection(a, touching) == [] and len(kernel.union(a, touching)) == 1 and kernel.touches_or_meets(a, touching)
    assert kernel.difference(a, a) == [] and abs(kernel.area(kernel.union(a, a)) - side) < 1


def test_joins_of_shapes_of_all_sizes(spark):
    """A county and a garden meet once, whatever the levels of their cells."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        x, y, w = rng.uniform(-3, -2), rng.uniform(50, 51), 10 ** rng.uniform(-4, -0.2)
        rows.append((i, box(x, y, x + w, y + w * rng.uniform(0.1, 1))[0][0]))
    df = shapes(spark, rows, "id long")
    want = sorted((i, j) for i, a in rows for j, b in rows if max(a[0][0], b[0][0]) <= min(a[2][0], b[2][0]) and max(a[0][1], b[0][1]) <= min(a[2][1], b[2][1]))
    assert sorted((r.a, r.b) for r in spatial.join(df, df).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).collect()) == want


def box_ring(x0, y0, x1, y1):
    return [[float(x), float(y)] for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]


def test_clip_of_land_in_parts(spark):
    """Land over 1 km2: the parts it is worked on in don't show."""
    land = shapes(spark, [(1, box_ring(0, 50, 0.03, 50.03)), (2, box_ring(1, 50, 1.03, 50.03)), (3, box_ring(2, 50, 2.03, 50.03))], "id long")
    cuts = [(1, None, box_ring(-0.001, 49.99, 0.015 - 4e-5, 50.04)), (2, None, box_ring(0.015 + 4e-5, 49.99, 0.031, 50.04)), (3, None, box_ring(2.01, 50.01, 2.011, 50.011)), (4, "exact", box_ring(1.01, 50.01, 1.02, 50.02))]
    pending = shapes(spark, cuts, "id long, match_type string")
    out = unregistered.clipped(land, pending).select("land_id", "is_whole", "geom", F.round(geometry.area(F.col("geom"))).alias("area")).collect()
    assert sorted((r.land_id, r.is_whole, len(r.geom.coordinates)) for r in out) == [(1, False, 1), (2, True, 1), (3, False, 2)]
    assert next(r.area for r in out if r.land_id == 1) == 19068  # a strip of 5.7 m along a border of parts stays, whole
    table = unregistered.renumbered(land, unregistered.clipped(land, pending))
    assert table.columns == land.columns and sorted(r.id for r in table.collect()) == [2, 4, 5]
    assert unregistered.clipped(land, pending, new_or_changed_only=False).filter("is_whole").count() == 0


def test_offsets_carried_over_ranges(spark):
    """The scan in two levels equals a fold over each council."""
    r = random.Random(3)
    rows = [(i, i, r.choice("ab"), r.random() < 0.2, (float(i), -float(i))) for i in r.sample(range(1, 4000), 600)]
    df = spark.createDataFrame(rows, "id long, poly_id long, council string, is_offset boolean, stats struct<lng_mean:double,lat_mean:double>")
    old, matching.SPAN = matching.SPAN, 7
    try:
        got = {x.id: (x.lng_offset, x.lat_offset) for x in matching.carried_offset(df).collect()}
    finally:
        matching.SPAN = old
    state, want = {}, {}
    for i, _, council, hit, stats in sorted(rows):
        want[i] = state.get(council, (0.0, 0.0))
        if hit:
            state[council] = stats
    assert got == want


def test_tables(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, v string, n int")
    new = spark.createDataFrame([(2, "x", 5), (2, "y", 6), (3, "z", 7)], "id long, v string, n int")
    assert sorted(map(tuple, tables.upserted(t, new, "id", ["n"]).collect())) == [(1, "a", 1), (2, "y", 6), (3, "z", 7)]
    assert sorted(map(tuple, tables.upserted(t, new, "id", ["n"], keep=("n",)).collect())) == [(1, "a", 1), (2, "y", 2), (3, "z", 7)]
    added = tables.appended(t, spark.range(5).selectExpr("'k' AS v", "9 AS n").repartition(3)).collect()
    assert sorted(r.id for r in added) == list(range(1, 8))
    assert tables.truncated(t).count() == 0 and tables.largest_id(tables.truncated(t)).first().id == 0 and not tables.exists(spark, "no_such_table")
    with pytest.raises(ValueError):
        tables.appended_shapes(t, new.filter("false"))


def test_ownership_updates(spark):
    schema = "title_no string, tenure string, createdAt date, file_date date, filename string, type string, op string, event_id long"
    day = lambda n: dt.date(2018, 1, n)
    rows = [("T1", "new", day(3), day(3), "x_COU_1", "ccod", "A", 1), ("T2", "", day(3), day(3), "x_COU_1", "ccod", "D", 2), ("T2", "again", day(4), day(4), "x_COU_2", "ccod", "A", 3), ("T3", "kept out", day(4), day(4), "x_FULL_", "ccod", "A", 4)]
    order = ["file_date", "type", F.expr("op <> 'D'"), "event_id"]
    changes = spark.createDataFrame(rows, schema)
    own = spark.createDataFrame([("T1", "old", day(1)), ("T2", "old", day(1)), ("T9", "old", day(1))], "title_no string, tenure string, createdAt date")
    nothing = changes.select("file_date").filter("false")
    for since, base in ((nothing, own.filter("false")), (changes.select(F.lit(day(2)).alias("file_date")), own)):
        out, until = ownership.updated(base, changes, since, own, order)
        assert {tuple(r) for r in out.collect()} == {("T1", "new", day(1)), ("T2", "again", day(4)), ("T9", "old", day(1))}
        assert until.first().file_date == day(4)
    bad = spark.createDataFrame([("T7", "x", day(5), day(5), "x_COU_3", "ccod", "", 9)], schema)
    with pytest.raises(Exception, match="No change indicator for ownership title T7"):
        ownership.updated(own, bad, nothing, own, order)[0].collect()


def test_analysis_and_reports(spark, tmp_path):
    p = shapes(spark, [(1, "T1", SMALL), (2, "T1", FAR), (3, None, moved(FAR, 0.1, 0))], "poly_id long, title_no string")
    o = spark.createDataFrame([("T1", "Freehold", "x")], "title_no string, tenure string, property_address string")
    n = shapes(spark, [(1, 1, "c", True, "moved", SMALL), (2, 2, "c", False, None, moved(FAR, 0.001, 0.003)), (3, 9, "d", False, "merged", moved(SMALL, 1, 0))], "id long, poly_id long, council string, accepted boolean, match_type string")
    gone, land = spark.createDataFrame([(3,)], "poly_id long"), shapes(spark, [(5, moved(FAR, 0.001, 0.003)), (6, moved(FAR, 5, 0))], "id long")
    out = analysis.analysed(n, p, o, gone, land)
    assert {r.poly_id: r.match_type for r in out["pending"].collect()} == {1: "exact", 2: "fail", 9: "newBoundary"}
    assert {r.poly_id for r in out["parcels"].collect()} == {1, 2, 3, 9} and [r.id for r in out["land"].collect()] == [6] and out["deletions"].count() == 0  # old marks don't count
    report = out["failed"].collect()
    assert [r.poly_id for r in report] == [2] and report[0].old_lng_lat == FAR[0] and report[0].new_lng_lat == moved(FAR, 0.001, 0.003)[0] and abs(report[0].lng_mean - 0.001) < 1e-9
    again = analysis.analysed(shapes(spark, [(1, 1, "c", False, None, SMALL), (2, 9, "c", False, None, moved(SMALL, 1, 0))], "id long, poly_id long, council string, accepted boolean, match_type string"), out["parcels"], o, out["deletions"], out["land"])
    assert {r.poly_id: r.match_type for r in again["pending"].collect()} == {1: "exact", 9: "exact"} and again["parcels"].count() == 4 and [r.id for r in again["land"].collect()] == [6]
    marked = analysis.analysed(n, p, o, gone, land, resume=True)
    assert {r.poly_id for r in marked["parcels"].collect()} == {1, 2, 9}
    later = analysis.analysed(n, p, o, gone, land, resume=True, first_id=2, update_boundaries=False)
    assert {r.poly_id: r.match_type for r in later["pending"].collect()} == {1: "moved", 2: "fail", 9: "merged"} and later["parcels"].count() == 3
    some = analysis.analysed(n, p, o, gone, land, max_polygons=2, update_boundaries=False)
    assert {r.poly_id: r.match_type for r in some["pending"].collect()} == {1: "exact", 2: "fail", 9: None}
    assert analysis.is_complete() and not analysis.is_complete(max_polygons=2)
    analysis.write_reports(out, str(tmp_path / "r"))
    total = [r for r in spark.read.json(str(tmp_path / "r/summary")).collect() if r.match_type == "Total"]
    assert total[0]["count"] == "3" and spark.read.json(str(tmp_path / "r/failed-matches")).first().poly_id == 2
    assert {r.stat for r in spark.read.json(str(tmp_path / "r/stats")).collect()} == {"percentageIntersects", "offsetMeans", "offsetStds"}


def test_shape_checks(spark):
    df = spark.createDataFrame([({"type": "Polygon", "coordinates": c},) for c in ([SMALL], [SMALL[:3]], [SMALL[:3] + [[0.0, 0.0]]], [])] + [(None,)], f"g {geometry.POLYGON}")
    assert [r.v for r in df.select(geometry.is_valid(F.col("g")).alias("v")).collect()] == [True, False, False, False, False]
    for wkt in ("POINT(1 2)", "POLYGON((1 2, 3 4, 1 2))"):
        with pytest.raises(ValueError):
            parcels.rings_of(wkt)


def test_run_log(spark, tmp_path):
    log = runs.RunLog(spark, str(tmp_path / "runs"))
    steps = {t: (lambda: None) for t in runs.TASKS}
    assert runs.resumed(log, steps) is None
    first = runs.triggered(log, steps, {"maxPolygons": "3"})
    row = log.latest().first()
    assert (row.unique_key, row.status, row.last_task) == (first, runs.STOPPED, "analyseInspire") and json.loads(row.options) == {"maxPolygons": "3"}
    log.put("cut", status=runs.RUNNING, startedAt=dt.datetime(2999, 1, 1), last_task="analyseInspire", last_poly_analysed=7, options="{}")
    assert runs.triggered(log, steps) is None
    again = runs.resumed(log, steps)
    states = {r.unique_key: r for r in log.current().collect()}
    assert states["cut"].status == runs.INTERRUPTED and states[again].last_poly_analysed == 7 and states[again].last_task == "analyseInspire"
    old = runs.RunLog(spark, str(tmp_path / "old"))
    old.put("k", status=runs.INTERRUPTED, startedAt=dt.datetime(2001, 1, 1), last_task="downloadInspire")
    with pytest.raises(ValueError):
        runs.resume_task(old, "now", dt.date(2024, 5, 9))
    assert runs.latest_publish_date(dt.date(2024, 5, 9)) == dt.date(2024, 5, 5) and runs.latest_publish_date(dt.date(2024, 5, 2)) == dt.date(2024, 4, 5)
    with pytest.raises(ValueError):
        runs.latest_publish_date(dt.date(2024, 5, 5))


def test_zipped_sources(spark, tmp_path):
    import zipfile

    head = "Title Number,Tenure,Change Indicator\n"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", head + 'T1,"a, b",A\nT2,,D\nRow Count:,2\n')
        z.writestr("readme.txt", "no rows")
    rows = files.zipped_csv(spark, str(tmp_path / "*.zip")).collect()
    assert [(r["Title Number"], r["Tenure"], r["Change Indicator"]) for r in rows] == [("T1", "a, b", "A"), ("T2", "", "D")]
    ring = lambda e: f"<gml:exterior><gml:LinearRing><gml:posList>{e} 313177 {e + 10} 313177 {e + 5} 313190 {e} 313177</gml:posList></gml:LinearRing></gml:exterior>"
    one = lambda n, e: f"<m><LR:PREDEFINED><LR:INSPIREID>{n}</LR:INSPIREID><LR:GEOMETRY><gml:Polygon>{ring(e)}</gml:Polygon></LR:GEOMETRY></LR:PREDEFINED></m>"
    doc = lambda n, body: f'<?xml version="1.0"?><c xmlns:LR="lr" xmlns:gml="gml" numberMatched="{n}">{body}</c>'
    for council, n, body in (("Adur", 2, one(5, 651400) + one(5, 651500)), ("Bath", 0, ""), ("York", 1, one(7, 651400))):
        with zipfile.ZipFile(tmp_path / f"{council}.zip", "w") as z:
            z.writestr("Land_Registry.gml", doc(n, body))
    for folder in ("2024-05", "2024-06"):
        (tmp_path / "in" / folder).mkdir(parents=True)
    for f in tmp_path.glob("[ABY]*.zip"):
        f.rename(tmp_path / "in/2024-06" / f.name)
    assert files.latest_month(spark, str(tmp_path / "in")) == "2024-06"
    files.load_councils(spark, str(tmp_path / "in/2024-06"), str(tmp_path / "gml"), str(tmp_path / "pending"))
    got = spark.read.parquet(str(tmp_path / "pending")).collect()
    assert sorted((r.council, r.poly_id, len(r.geom.coordinates)) for r in got) == [("Adur", 5, 1), ("Adur", 5, 1), ("York", 7, 1)]
    files.load_councils(spark, str(tmp_path / "in/2024-06"), str(tmp_path / "gml2"), str(tmp_path / "pending"), after="Bath")
    assert spark.read.parquet(str(tmp_path / "pending")).count() == 3


def test_distances_of_odd_shapes(spark):
    """Triangles and rectangles at known distances, one within another, and a pair that crosses without a corner near."""
    m = 180 / (math.pi * 6371008.8)
    tri = [[0.0, 0.0], [100 * m, 0.0], [50 * m, 80 * m], [0.0, 0.0]]
    rows = [(1, tri), (2, [[100 * m + 3 * m, 0.0], [200 * m, 0.0], [200 * m, 9 * m], [103 * m, 0.0]]), (3, box_ring(0, -20 * m, 100 * m, -4 * m)), (4, box_ring(45 * m, 20 * m, 55 * m, 25 * m)), (5, [[0.0, -30 * m], [1000 * m, -26.0 * m], [0.0, -26 * m], [0.0, -30 * m]])]
    df = shapes(spark, rows, "poly_id long")
    got = {(r.poly_id, r.other_id): r.metres for r in lineage.adjacent(df, df).collect()}
    assert {k for k in got if k[0] < k[1]} == {(1, 2), (1, 3), (1, 4), (2, 3)} - ({(2, 3)} if math.hypot(3, 4) > 5 else set()) and all((b, a) in got for a, b in got)
    assert abs(got[1, 2] - 3) < 1e-3 and abs(got[1, 3] - 4) < 1e-3 and got[1, 4] == 0


def test_components_of_chains(spark):
    r = random.Random(2)
    n = list(range(60))
    r.shuffle(n)
    edges = list(zip(n[:50], n[1:51], strict=True)) + [(1000 + i, 1000) for i in range(30)] + [(7000, 7001)]
    got = {x.node: x.root for x in lineage.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(n[:51], min(n[:51])), **dict.fromkeys(range(1000, 1030), 1000), 7000: 7000, 7001: 7000}


def test_ring_keys(spark):
    """Free of start, direction and shift; not of mirroring, scale or another point."""
    ring = [[-1.5, 51.2], [-1.4998, 51.2001], [-1.4997, 51.2004], [-1.5001, 51.2003], [-1.5, 51.2]]
    turned = ring[2:-1] + ring[:3]
    same = [ring, turned, turned[::-1], ring[::-1], moved(ring, 3e-5, -2e-5)]
    other = [[[-x, y] for x, y in ring], ring[:3] + ring[4:], [[x, y + (y - 51.2)] for x, y in ring], ring[:2] + [[-1.4997, 51.20041]] + ring[3:]]
    keys = [r.k for r in spark.createDataFrame([(i, p) for i, p in enumerate(same + other)], "i int, ring array<array<double>>").select("i", lineage.ring_key(F.col("ring")).alias("k")).orderBy("i").collect()]
    assert len(set(keys[:5])) == 1 and len(set(keys)) == 5


def _settle(rows, decisions):
    """A plain fold of rows in order of id."""
    state, known, marks = {}, {d[0]: d for d in decisions}, set()
    ids = {p: i for i, p, _ in rows}
    for i, p, own in sorted(rows):
        if state.get(p) == "fail" or (state.get(p) == "newSegment" and i not in known):
            continue
        if i not in known:
            state[p] = own
            continue
        _, _, decision, gone, segments = known[i]
        state[p] = decision
        if decision != "boundariesShifted":
            for s in segments:
                if s in ids:
                    state[s] = "fail" if decision == "fail" else "newSegment"
            marks |= set(gone) if decision != "fail" else set()
    return state, marks


def test_decisions_act_in_order(spark):
    r = random.Random(8)
    for size in (24,):
        order = r.sample(range(1000), size)
        rows = [(i, 10 + p, r.choice(["exact", "fail", "newBoundary"])) for p, i in enumerate(order)]
        decisions = []
        for i, p, _ in rows:
            if r.random() < 0.7:
                what = r.choice(["fail", "fail", "merged", "segmented", "boundariesShifted", "mergedAndSegmented"])
                pool = [q for j, q, _ in rows if q != p]
                # Segments that are accepted are new numbers; only failures name any row.
                segments = r.sample(pool, min(len(pool), r.randrange(4))) if what == "fail" else []
                decisions.append((i, p, what, [900 + p] if what.startswith("merged") else [], segments))
        fresh = [(i, p, o) for i, p, o in rows if i not in {d[0] for d in decisions}]
        for d in decisions:
            if d[2] in ("segmented", "mergedAndSegmented") and fresh:
                d[4].extend({r.choice(fresh)[1] for _ in range(2)})
        a = spark.createDataFrame(rows, "id long, poly_id long, match_type string")
        b = spark.createDataFrame(decisions, "id long, poly_id long, decision string, merged_ids array<long>, segment_ids array<long>")
        out, marks = lineage.resolved(a, b)
        state, gone = _settle(rows, decisions)
        assert {x.poly_id: x.match_type for x in out.collect()} == state and {x.poly_id for x in marks.collect()} == gone


def test_losses_in_rounds(spark):
    """What is left after a first neighbour is looked at again, shrunk by less; land of no one ends it."""
    u = 1e-4
    old = shapes(spark, [(1, box_ring(0, 0, 20 * u, 8 * u))], "poly_id long")
    keep, wide = box_ring(0, 0, 2 * u, 8 * u), box_ring(2 * u, 0, 18.6 * u, 8 * u)
    thin = box_ring(18.6 * u, 0, 20 * u, 8 * u)
    for last, incomplete, segments in ((thin, False, [2, 3]), (None, True, [2])):
        new = shapes(spark, [(1, keep), (2, wide)] + ([(3, last)] if last else []), "poly_id long")
        rows = old.select("poly_id", F.col("geom").alias("old_geom")).join(new.select("poly_id", "geom"), "poly_id").select(F.lit(1).cast("long").alias("id"), "*", F.lit(0.0).alias("lng_offset"), F.lit(0.0).alias("lat_offset"))
        got = lineage.losses(lineage._shapes(rows), old, new).first()
        assert (got.segments, got.failed, got.incomplete) == (segments, False, incomplete)


def _grid_file(order, *grids):
    """An NTv2 file; grids: (name, south, north, west, east, step in degrees, shift of (lat, lng) in seconds)."""
    text = lambda x: x.ljust(8).encode()
    whole = lambda k, x: text(k) + struct.pack(f"{order}i", x) + b"\0" * 4
    real = lambda k, x: text(k) + struct.pack(f"{order}d", x)
    word = lambda k, x: text(k) + text(x)
    out = [whole("NUM_OREC", 11), whole("NUM_SREC", 11), whole("NUM_FILE", len(grids)), word("GS_TYPE", "SECONDS"), word("VERSION", "1"), word("SYSTEM_F", "A"), word("SYSTEM_T", "B"), *[real(k, 6e6) for k in ("MAJOR_F", "MINOR_F", "MAJOR_T", "MINOR_T")]]
    for name, south, north, west, east, step, shift in grids:
        rows, cols = round((north - south) / step) + 1, round((east - west) / step) + 1
        out += [word("SUB_NAME", name), word("PARENT", "NONE"), word("CREATED", ""), word("UPDATED", "")]
        out += [real(k, x * 3600) for k, x in (("S_LAT", south), ("N_LAT", north), ("E_LONG", -east), ("W_LONG", -west), ("LAT_INC", step), ("LONG_INC", step))] + [whole("GS_COUNT", rows * cols)]
        for i in range(rows):
            for j in range(cols):
                lat, lng = shift(south + i * step, east - j * step)
                out.append(struct.pack(f"{order}4f", lat, -lng, 0, 0))
    return b"".join(out) + text("END") + b"\0" * 8


@pytest.mark.parametrize("order", ["<", ">"])
def test_grid_shift(spark, tmp_path, order):
    """Shifts that are bilinear come out exactly; of nested sub-grids the finer counts; beyond them seven parameters do."""
    coarse = lambda lat, lng: (3 + 2 * (lat - 50) + 0.5 * (lng + 3) * (lat - 50), -4 + (lng + 3) * 1.5)
    fine = lambda lat, lng: (7 - (lat - 51), 1 + (lng + 2))
    (tmp_path / "g.gsb").write_bytes(_grid_file(order, ("COARSE", 50, 52, -3, 0, 0.5, coarse), ("FINE", 51, 51.5, -2, -1.5, 0.125, fine)))
    r = random.Random(4)
    at = [(r.uniform(-3, 0), r.uniform(50, 52)) for _ in range(60)] + [(-3.0, 50.0), (0.0, 52.0), (-2.0, 51.0), (-1.5, 51.5), (-1.75, 51.25), (-9.0, 49.0)]
    cells = gridshift.cells(spark, str(tmp_path / "g.gsb"))
    assert cells.groupBy("grid").count().orderBy("grid").collect() == [("COARSE", 24), ("FINE", 16)]
    got = {x.key: (x.lng, x.lat) for x in gridshift.shifted(spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "key long, lng double, lat double"), cells).collect()}
    for i, (lng, lat) in enumerate(at):
        if lng == -9:
            far = files.helmert(pd.Series([lng]), pd.Series([lat])).iloc[0]
            want = (far.lng, far.lat)
        else:
            dlat, dlng = (fine if 51 <= lat <= 51.5 and -2 <= lng <= -1.5 else coarse)(lat, lng)
            want = (lng + dlng / 3600, lat + dlat / 3600)
        assert abs(got[i][0] - want[0]) < 1e-8 and abs(got[i][1] - want[1]) < 1e-8, at[i]
    hole = [[-2.5, 50.2], [-2.4, 50.2], [-2.4, 50.3], [-2.5, 50.2]]
    df = spark.createDataFrame([(1, {"type": "Polygon", "coordinates": [box_ring(-2.9, 50.1, -1.1, 51.9), hole]}), (2, {"type": "Polygon", "coordinates": [hole]}), (2, {"type": "Polygon", "coordinates": [hole]})], f"id long, geom {geometry.POLYGON}")
    out = gridshift.applied(df, cells).collect()
    assert sorted((x.id, [len(c) for c in x.geom.coordinates]) for x in out) == [(1, [5, 4]), (2, [4]), (2, [4])]
    dlat, dlng = coarse(50.2, -2.4)
    assert all(abs(x.geom.coordinates[-1][1][0] - (-2.4 + dlng / 3600)) < 1e-8 and abs(x.geom.coordinates[-1][1][1] - (50.2 + dlat / 3600)) < 1e-8 for x in out)
    with pytest.raises(ValueError):
        list(gridshift.subgrids(b"\0" * 400))


def test_build_goes_on(spark, tmp_path, monkeypatch):
    """A build that is cut off and called again gives what one in one go does."""
    tiles = shapes(spark, [(i, box_ring(i * 0.01, 50, i * 0.01 + 0.009, 50.005)) for i in range(1, 6)], "id long")
    parcels_ = shapes(spark, [(1, box_ring(0.012, 50.001, 0.015, 50.003)), (2, box_ring(0.04, 49.99, 0.044, 50.01))], "id long")
    land = shapes(spark, [(i, i, box_ring(i * 0.01, 50, i * 0.01 + 0.008, 50.005)) for i in range(1, 6)], "id long, tile_id long")
    area = lambda df: sorted((r.tile_id, round(r.a, 2)) for r in df.groupBy("tile_id").agg(F.sum(geometry.area(F.col("geom"))).alias("a")).collect())
    whole, target, calls = unregistered.built, str(tmp_path / "u"), []

    def cut_off(*a):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return whole(*a)

    monkeypatch.setattr(unregistered, "built", cut_off)
    with pytest.raises(KeyboardInterrupt):
        unregistered.build(tiles, parcels_, land, target, 1, 6, step=2)
    assert unregistered.ranges_left(spark, f"{target}/ledger", 1, 6, 2) == [(3, 5), (5, 6)]
    unregistered.build(tiles, parcels_, land, target, 1, 6, step=2)
    unregistered.build(tiles, parcels_, land, target, 1, 6, step=2)
    assert len(calls) == 4 and area(spark.read.parquet(f"{target}/layer")) == area(whole(tiles, parcels_, land))
    unregistered.build(tiles, parcels_, land, str(tmp_path / "some"), 2, 4)
    assert {t for t, _ in area(spark.read.parquet(str(tmp_path / "some/layer")))} == {2, 3}


def test_convex_shapes_grow_as_others_do(monkeypatch):
    rng = np.random.default_rng(5)
    convex = kernel._is_convex
    taken = 0
    for _ in range(120):
        turns = np.sort(rng.random(rng.integers(3, 9))) * 2 * np.pi
        p = np.stack([np.cos(turns), np.sin(turns)], 1) * rng.choice([1e-5, 1e-4, 1e-3]) + rng.normal(0, 3e-6, (len(turns), 2)) + [-4.9, 50.1]
        ring = np.concatenate([p, p[:1]])
        taken += convex(ring)
        metres = float(rng.choice([0.2, 0.6, 5.0]))
        got = kernel.buffered([[ring.tolist()]], metres)
        with monkeypatch.context() as m:
            m.setattr(kernel, "_is_convex", lambda p: False)
            assert got == kernel.buffered([[ring.tolist()]], metres)
    assert taken > 40


def test_windings_equal_a_count_over_all_edges():
    rng = np.random.default_rng(7)
    curves = [[np.concatenate([p, p[:1]])] for p in (rng.integers(0, 40, (7, 2)) * kernel.GRID for _ in range(5))]
    e, group, _ = kernel._edges(curves)
    e, of = kernel._split(e)
    ahead = (e[:, 0] < e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] < e[:, 3]))
    e, place = np.unique(np.where(ahead[:, None], e, e[:, [2, 3, 0, 1]]), axis=0, return_inverse=True)
    net = np.zeros((len(e), len(curves)))
    np.add.at(net, (place.ravel(), group[of]), np.where(ahead, 1.0, -1.0))
    left, right = kernel._sides(e, net)
    assert (left - right == net).all()
    for k, (x0, y0, x1, y1) in enumerate(e):
        x, y = (x0 + x1) / 2, (y0 + y1) / 2
        want = np.zeros(len(curves))
        for c, (a, b, u, v) in enumerate(e):
            if c == k:
                continue
            if x0 == x1 and (b > y) != (v > y) and a + (y - b) * (u - a) / (v - b) > x:
                want += net[c] * np.sign(v - b)
            elif x0 != x1 and a <= x < u and b + (x - a) * (v - b) / (u - a) > y:
                want -= net[c]
        assert (left[k] == want + (net[k] if x0 == x1 else 0)).all()
