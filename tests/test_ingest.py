import zipfile

import pandas as pd
import pytest

from tessera.functions import kernel
from tessera.operators import unregistered
from tessera.plans import ingest, runs
from tessera.sources import files


def archive(path, numbers):
    ring = "<gml:exterior><gml:LinearRing><gml:posList>{0} 313177 {1} 313177 {2} 313190 {0} 313177</gml:posList></gml:LinearRing></gml:exterior>".format(651400, 651410, 651405)
    body = "".join(f"<m><LR:PREDEFINED><LR:INSPIREID>{n}</LR:INSPIREID><LR:GEOMETRY><gml:Polygon>{ring}</gml:Polygon></LR:GEOMETRY></LR:PREDEFINED></m>" for n in numbers)
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("Land_Registry.gml", f'<?xml version="1.0"?><c xmlns:LR="lr" xmlns:gml="gml">{body}</c>')


def test_load_is_cut_off_and_goes_on(spark, tmp_path, monkeypatch):
    downloads, target, log = tmp_path / "in", str(tmp_path / "pending"), runs.RunLog(spark, str(tmp_path / "log"))
    archive(downloads / "2024-05/Adur.zip", [99])
    for n, council in enumerate(["Adur", "Bath", "Hull", "York"]):
        archive(downloads / f"2024-06/{council}.zip", [n] if council != "Bath" else [])
    spark.createDataFrame([(77, None, "Gone")], ingest.SCHEMA).write.partitionBy("council").parquet(target)
    go = lambda **kw: ingest.load(spark, str(downloads), str(tmp_path / "work"), target, log, "k", step=1, **kw)
    got = lambda: sorted((r.council, r.poly_id) for r in ingest.pending(spark, target).collect())
    whole = files.load_councils

    def failing(*a, **kw):
        if kw["only"] == ["Hull"]:
            raise OSError("cut off")
        whole(*a, **kw)

    monkeypatch.setattr(files, "load_councils", failing)
    with pytest.raises(OSError, match="cut off"):
        go()
    assert got() == [("Adur", 0)] and [p.name for p in downloads.iterdir()] == ["2024-06"]
    kept = {p.name for p in (tmp_path / "pending/council=Adur").glob("*.parquet")}
    loaded = []
    monkeypatch.setattr(files, "load_councils", lambda *a, **kw: (loaded.extend(kw["only"]), whole(*a, **kw)))
    assert go(resume=True) == "2024-06" and loaded == ["Hull", "York"]
    assert got() == [("Adur", 0), ("Hull", 2), ("York", 3)]
    assert {p.name for p in (tmp_path / "pending/council=Adur").glob("*.parquet")} == kept
    assert go(after="Hul", most=1) == "2024-06" and got() == [("York", 3)]
    (tmp_path / "none").mkdir()
    assert ingest.load(spark, str(tmp_path / "none"), str(tmp_path / "w"), target, log, "k") is None and got() == [("York", 3)]


@pytest.mark.parametrize("alone", [True, False])
def test_difference_once_more_with_coarser_places(monkeypatch, alone):
    square = lambda x0, y0, x1, y1: [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]
    land, cut = square(0.000003, 50.0, 0.01, 50.01), square(0.004003, 49.9, 0.02, 50.1)
    whole, calls = kernel.difference, []

    def failing(a, *others):
        calls.append((a, others))
        if len(calls) == 1:
            raise ArithmeticError("edges still cross after being split")
        return whole(a, *others)

    monkeypatch.setattr(kernel, "difference", failing)
    shape = lambda c: {"type": "Polygon", "coordinates": c}
    out = unregistered._cut(pd.DataFrame({"land_id": [1], "land": [shape(land)], "cut": [shape(cut)], "alone": [alone]}))
    xs = [p[0] for p in out["geom"].iloc[0]["coordinates"][0]]
    assert len(calls) == 2 and max(xs) == pytest.approx(0.004) and min(xs) == pytest.approx(0.0 if alone else 0.000003)
    monkeypatch.setattr(kernel, "difference", lambda *a: (_ for _ in ()).throw(ArithmeticError("still")))
    with pytest.raises(ArithmeticError):
        unregistered._cut(pd.DataFrame({"land_id": [1], "land": [shape(land)], "cut": [shape(cut)], "alone": [alone]}))
