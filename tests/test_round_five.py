"""Keys so large that fixtures lie beyond a pole, rounds that take nothing off, frames of many tiles."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera import queries
from tessera.functions import kernel
from tessera.operators import lineage, spatial, unregistered
from tests.test_queries import plain


def square(x, y, side=1e-3):
    return [[[[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]]]


@pytest.mark.parametrize("lat", [89.9985, 90.0, 90.12, 110.0])
def test_shrinking_never_grows(lat):
    """Beyond a pole metres of longitude count the wrong way round; what is narrower than twice the metres has nothing left."""
    assert kernel.buffered(square(1.0, lat), -1.0) == []
    (grown,) = kernel.buffered(square(1.0, lat), 1.0)
    x0, y0, x1, y1 = kernel.bounds([grown])
    assert x0 < 1.0 and x1 > 1.001 and y0 < lat and y1 > lat + 1e-3


def test_narrow_shapes_need_no_overlay(monkeypatch):
    monkeypatch.setattr(kernel, "windings", lambda problems, keeps: [1 / 0 for _ in problems])
    wide = 4.0 * lineage._M
    assert kernel.all_buffered([[[[[0, 0], [1, 0], [1, wide], [0, wide], [0, 0]]]]], [-2.001]) == [[]]


def shifted(spark, sf_dir, folder, customers, suppliers=0):
    for t, keys in (("customer", {"c_custkey": customers}), ("orders", {"o_orderkey": customers, "o_custkey": customers}), ("supplier", {"s_suppkey": suppliers})):
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        df.withColumns({k: F.col(k) + v for k, v in keys.items()}).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


def agrees(spark, sf_dir, folder, name, within=0.0):
    got = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    for t in ("customer", "orders", "supplier"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    cols = sorted(got.columns)
    at = [want.columns.index(c) for c in cols]
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=str)
    expected = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
    assert rows
    if within:
        number = cols.index("hectares")
        assert len(rows) == len(expected) and all(abs(a[number] - b[number]) <= within for a, b in zip(sorted(rows, key=lambda r: r[1 - number]), sorted(expected, key=lambda r: r[1 - number]), strict=True))
    else:
        assert rows == expected


@pytest.fixture(scope="module")
def beyond(spark, sf_dir, tmp_path_factory):
    """The tables with customers' keys shifted to where their shapes lie just beyond the pole."""
    return shifted(spark, sf_dir, tmp_path_factory.mktemp("beyond"), 2_006_000)


@pytest.mark.parametrize("name", ["lineage_resolved", "lineage_deletions", "lineage_decisions_slanted"])
def test_lineage_beyond_the_pole(spark, beyond, sf_dir, monkeypatch, name):
    steps, written = [], lineage.written
    monkeypatch.setattr(lineage, "written", lambda df: steps.append(1) or (written(df) if len(steps) < 25 else pytest.fail("rounds go on")))
    if name == "lineage_deletions":  # nothing is left of pieces there, so nothing is merged
        assert queries.QUERIES[name](spark, beyond).isEmpty()
    else:
        agrees(spark, sf_dir, beyond, name)


def test_layer_close_to_the_pole(spark, sf_dir, tmp_path):
    """Edges that all but run together take more rounds of splitting than a dozen. Corners are rounder there, for the SQL knows none."""
    agrees(spark, sf_dir, shifted(spark, sf_dir, tmp_path, 1_889_900, 252_000), "unregistered_init", within=0.11)


def offset_by_corners(p, d, quarter):
    """The curve that goes by way of every corner that it doesn't go round."""
    p = p[np.r_[True, (p[1:] != p[:-1]).any(1)]]
    out = []
    u = (p[1:] - p[:-1]) / np.hypot(*(p[1:] - p[:-1]).T)[:, None]
    for i, b in enumerate(u):
        a = u[i - 1]
        turn = math.atan2(a[0] * b[1] - a[1] * b[0], (a * b).sum())
        k = max(1, math.ceil(turn / (math.pi / 2) * quarter - 1e-9))
        normals = [math.atan2(-a[0], a[1]) + turn * j / k for j in range(k + 1)] if turn > 0 else [math.atan2(-a[0], a[1]), None, math.atan2(-b[0], b[1])]
        out += [p[i] if n is None else p[i] + d * np.array([math.cos(n), math.sin(n)]) for n in normals]
    return np.array([*out, out[0]])


def test_turns_where_strips_meet(monkeypatch):
    """Grown and shrunk shapes are those of the curve by way of corners: rings with dents, rounded ones and small holes."""
    random.seed(5)
    scale = np.array([1.4e-5, 9e-6])

    def ring(n, size, dent):
        r = [size * (1 - dent * random.random()) for _ in range(n)]
        p = np.array([[x * math.cos(2 * math.pi * i / n), x * math.sin(2 * math.pi * i / n)] for i, x in enumerate(r)])
        return (np.concatenate([p, p[:1]]) * scale + [1, 50]).tolist()

    shapes = [[[ring(random.choice([4, 7, 16, 40]), 30, random.choice([0.02, 0.3, 0.7])), ring(random.choice([4, 8, 24]), random.choice([0.7, 2, 5]), 0.1)]] for _ in range(60)]
    shapes += [kernel.buffered(x, -1.5) for x in shapes]
    for metres in (-3.0, -0.6, 0.6, 1.5):
        got = kernel.all_buffered(shapes, [metres] * len(shapes))
        with monkeypatch.context() as m:
            m.setattr(kernel, "_offset", offset_by_corners)
            want = kernel.all_buffered(shapes, [metres] * len(shapes))
        # Borders that lie a step apart can be beyond the overlay itself, so sizes and boxes are held against each other.
        assert [len(x) for x in got] == [len(x) for x in want] and sum(map(bool, want)) > 50
        assert max(abs(kernel.area(a) - kernel.area(b)) for a, b in zip(got, want, strict=True)) < 0.05
        assert all(np.abs(np.subtract(kernel.bounds(a), kernel.bounds(b))).max() < 1e-8 for a, b in zip(got, want, strict=True) if a)


def test_room_is_never_in_slivers():
    """A shape that has room has something left when shrunk; a wide one's is found without an overlay."""
    random.seed(6)
    found = []
    for _ in range(300):
        w, h, s = random.uniform(1, 40), random.uniform(1, 40), random.choice([0.0, 0.7, 3.0])
        outer = np.array([[0, 0], [w, 0], [w + s * h, h], [s * h, h], [0, 0]])
        inner = outer * random.uniform(0.05, 0.9) + outer[2] * 0.04
        shape = [(ring * [1.4e-5, 9e-6] + [1, 50]).tolist() for ring in (outer, inner[::-1])[: random.choice([1, 2])]]
        found.append((kernel.has_room(shape, 2.0), bool(kernel.buffered([shape], -2.0))))
    assert not any(room and not left for room, left in found)
    assert sum(room for room, _ in found) > 0.8 * sum(left for _, left in found) > 0


def test_tiles_go_in_slices(monkeypatch):
    """A task holds few tiles at once, whatever a frame has, and gives the same."""
    tile = lambda i: square(0.01 * i, 50.0, 2e-3)[0]
    f = pd.DataFrame([(i, tile(i), [square(0.01 * i + 4e-4 * j, 50.0005, 2e-4)[0] for j in range(4)], [tile(i)]) for i in range(30)], columns=["tile_id", "tile", "parcels", "lands"])
    whole = pd.concat(unregistered._tile(iter([f])))
    held, buffered = [], kernel.all_buffered
    monkeypatch.setattr(unregistered, "SHAPES", 20)
    monkeypatch.setattr(kernel, "all_buffered", lambda shapes, *a: held.append(len(shapes)) or buffered(shapes, *a))
    parts = pd.concat(unregistered._tile(iter([f])))
    assert max(held) <= 20 and len(whole) == 30
    assert whole.to_dict("list") == parts.to_dict("list")


def test_rounds_end_where_nothing_comes_off(spark, monkeypatch):
    """A bow tie on lost land: the half that winds the other way has no inside, so it is met and never taken off."""
    rings = {
        "old": [(1, [[0, 50], [0.002, 50], [0.002, 50.001], [0, 50.001], [0, 50]])],
        "new": [(1, [[0, 50], [0.001, 50], [0.001, 50.001], [0, 50.001], [0, 50]]), (3, [[0.0012, 50.0002], [0.0018, 50.0008], [0.0018, 50.0003], [0.0012, 50.0006], [0.0012, 50.0002]])],
    }
    shape = lambda which: spatial.with_box(spark.createDataFrame([(i, [[float(x), float(y)] for x, y in r]) for i, r in rings[which]], "poly_id long, ring array<array<double>>").select("poly_id", F.struct(F.lit("Polygon").alias("type"), F.array("ring").alias("coordinates")).alias("geom")))
    old, new = shape("old"), shape("new")
    rows = new.filter("poly_id = 1").join(old.select("poly_id", F.col("geom").alias("old_geom")), "poly_id").select(F.lit(1).alias("id"), "poly_id", "geom", "old_geom", F.lit(0.0).alias("lng_offset"), F.lit(0.0).alias("lat_offset"))
    steps, written = [], lineage.written
    monkeypatch.setattr(lineage, "written", lambda df: steps.append(1) or (written(df) if len(steps) < 25 else pytest.fail("rounds go on")))
    (row,) = lineage.losses(lineage._shapes(rows), old, new).collect()
    assert row["incomplete"] and row["segments"] == [3] and not row["failed"]
