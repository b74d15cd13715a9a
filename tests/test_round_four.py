"""Shares of covered shapes, renumbered shapes that are many and alike, overlays of many shapes at once."""

import random

from pyspark.sql import functions as F

from tessera.functions import geometry, kernel
from tessera.operators import lineage, spatial


def boxes(spark, rows):
    df = spark.createDataFrame(rows, "poly_id long, x0 double, y0 double, x1 double, y1 double")
    return spatial.with_box(df.select("poly_id", F.lit(None).cast("string").alias("title_no"), geometry.rect(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("geom")))


def test_shares_of_covered_shapes(spark):
    old = boxes(spark, [(1, 0.0, 50.0, 0.002, 50.001), (2, 0.01, 50.0, 0.011, 50.001)])
    new = boxes(spark, [(7, 0.001, 50.0, 0.002, 50.001), (8, 0.0, 50.0, 0.0005, 50.001)])
    got = {(r["old_id"], r["new_id"]): (round(r["old_share"], 3), round(r["new_share"], 3)) for r in lineage.covered(old, new).collect()}
    assert got == {(1, 7): (50.0, 100.0), (1, 8): (25.0, 100.0)}


def test_renumbered_shapes_meet_where_they_lie(spark):
    """Shapes that are all alike: pairs come from neighbouring cells, not from the key alone; borders of cells lose none."""
    at = [(i, 0.001 * (i % 40), 50 + 0.001 * (i // 40)) for i in range(1600)]
    shift = lambda i: 9e-5 * (-1) ** i
    old = boxes(spark, [(i, x, y, x + 5e-4, y + 5e-4) for i, x, y in at])
    new = boxes(spark, [(10_000 + i, x + shift(i), y - shift(i // 2), x + shift(i) + 5e-4, y - shift(i // 2) + 5e-4) for i, x, y in at])
    out = lineage.renamed(new, old, new)
    assert {(r["old_id"], r["new_id"]) for r in out.collect()} == {(i, 10_000 + i) for i, _, _ in at}
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert joins and all("_cx" in x and "_cy" in x for x in joins)


def test_overlays_go_in_batches(monkeypatch):
    """Many overlays at once give what each gives alone, holes and crossings included, and few sweeps do for them all."""
    random.seed(4)

    def shape(x, y):
        w, h, s = random.uniform(1e-4, 1e-3), random.uniform(1e-4, 1e-3), random.choice([0.0, 0.5])
        return [[[[x, y], [x + w, y], [x + w + s * h, y + h], [x + s * h, y + h], [x, y]]]]

    rows = []
    for _ in range(200):
        x, y = random.uniform(-5, 1), random.uniform(50, 58)
        rows.append((shape(x, y), [shape(x + random.uniform(-3e-4, 6e-4), y + random.uniform(-3e-4, 6e-4)) for _ in range(random.choice([0, 1, 2, 5]))]))
    alone = [kernel.difference(a, *cuts) for a, cuts in rows]
    shrunk = [kernel.buffered(p, -3.0) for p in alone]
    calls, split = [], kernel._split
    monkeypatch.setattr(kernel, "_split", lambda *a: calls.append(1) or split(*a))
    assert kernel.differences(rows) == alone and kernel.all_buffered(alone, [-3.0] * len(alone)) == shrunk
    assert kernel.unions([[a, *cuts] for a, cuts in rows[:50]]) == [kernel.union(a, *cuts) for a, cuts in rows[:50]]
    assert len(calls) < 70  # fifty of them the single ones
