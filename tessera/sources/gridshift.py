"""Datum shifts by a grid file (NTv2): sub-grids as rows, points shifted by a join on grid cells.

A file has sub-grids of nodes with shifts in seconds of arc, from south to north and,
within a row, from east to west, with longitudes counted westwards. `cells` makes a
row of each cell with its corners' shifts; `applied` takes shapes' points apart,
gives each its cell in the finest sub-grid that holds it, interpolates bilinearly and
puts rings together again. Points beyond the grid get the seven-parameter shift.

A grid file is some tens of MB: one task reads it. Cells are joined by their place,
not collected.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.files import helmert

#: Sub-grids that are told by their extents in one broadcast, counted first.
MOST_GRIDS = 10_000
_CORNERS = ("sw", "se", "nw", "ne")
_CELL = "grid string, south double, west double, north double, east double, lat_step double, lng_step double, row long, col long, " + ", ".join(f"{axis}_{c} double" for c in _CORNERS for axis in ("lat", "lng"))


def subgrids(content: bytes) -> Iterator[tuple[str, dict[str, float], np.ndarray]]:
    """(name, extents in seconds, shifts [row from south, column from west, (lat, lng east)]) of a grid file's sub-grids."""
    order = "<" if struct.unpack_from("<i", content, 8)[0] == 11 else ">"
    number = lambda at, kind: struct.unpack_from(order + kind, content, at + 8)[0]
    if number(0, "i") != 11 or number(16, "i") != 11:
        raise ValueError("not an NTv2 grid file")
    at = 11 * 16
    for _ in range(number(32, "i")):
        name = content[at + 8 : at + 16].decode("ascii", "replace").strip()
        south, north, east, west, lat_step, lng_step = (number(at + 16 * i, "d") for i in range(4, 10))
        rows, cols = round((north - south) / lat_step) + 1, round((west - east) / lng_step) + 1
        if rows * cols != number(at + 160, "i"):
            raise ValueError(f"sub-grid {name} has another number of nodes than its extents say")
        at += 11 * 16
        nodes = np.frombuffer(content, f"{order}f4", rows * cols * 4, at).reshape(rows, cols, 4)[:, ::-1, :2].astype(float)
        at += rows * cols * 16
        yield name, {"south": south, "north": north, "west": -west, "east": -east, "lat_step": lat_step, "lng_step": lng_step}, nodes * np.array([1.0, -1.0])


def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for content in frame["content"]:
            for name, at, nodes in subgrids(content):
                row, col = (x.ravel() for x in np.meshgrid(np.arange(nodes.shape[0] - 1), np.arange(nodes.shape[1] - 1), indexing="ij"))
                corner = {"sw": nodes[:-1, :-1], "se": nodes[:-1, 1:], "nw": nodes[1:, :-1], "ne": nodes[1:, 1:]}
                values = {f"{axis}_{c}": corner[c][..., k].ravel() / 3600 for c in _CORNERS for k, axis in enumerate(("lat", "lng"))}
                yield pd.DataFrame({"grid": name, **{k: v / 3600 for k, v in at.items()}, "row": row, "col": col, **values})[[c.split()[0] for c in _CELL.split(", ")]]


def cells(spark: SparkSession, path: str) -> DataFrame:
    """A row for each cell of a grid file: its sub-grid's extents and steps, its place, its corners' shifts, in degrees."""
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(_cells, _CELL)


def shifted(points: DataFrame, grid: DataFrame) -> DataFrame:
    """points (key, lng, lat, ...) with lng and lat shifted; key: a column that tells points apart."""
    extents = grid.select("grid", "south", "west", "north", "east", "lat_step", "lng_step").distinct()
    if extents.count() > MOST_GRIDS:
        raise ValueError("too many sub-grids")
    inside = (F.col("lat") >= F.col("south")) & (F.col("lat") <= F.col("north")) & (F.col("lng") >= F.col("west")) & (F.col("lng") <= F.col("east"))
    held = points.select("key", "lng", "lat").join(F.broadcast(extents), inside)  # counted
    finest = held.groupBy("key").agg(F.min_by(F.struct("grid", "south", "west", "north", "east", "lat_step", "lng_step", "lng", "lat"), F.struct("lat_step", "grid")).alias("g"))
    place = lambda x, low, high, step: F.least(F.floor((F.col(f"g.{x}") - F.col(f"g.{low}")) / F.col(f"g.{step}")), F.round((F.col(f"g.{high}") - F.col(f"g.{low}")) / F.col(f"g.{step}")) - 1).cast("long")
    placed = finest.select("key", "g", F.col("g.grid").alias("grid"), place("lat", "south", "north", "lat_step").alias("row"), place("lng", "west", "east", "lng_step").alias("col"))
    found = placed.join(grid.select("grid", "row", "col", *[f"{axis}_{c}" for c in _CORNERS for axis in ("lat", "lng")]), ["grid", "row", "col"])
    y = (F.col("g.lat") - F.col("g.south")) / F.col("g.lat_step") - F.col("row")
    x = (F.col("g.lng") - F.col("g.west")) / F.col("g.lng_step") - F.col("col")
    mean = lambda axis: (1 - y) * ((1 - x) * F.col(f"{axis}_sw") + x * F.col(f"{axis}_se")) + y * ((1 - x) * F.col(f"{axis}_nw") + x * F.col(f"{axis}_ne"))
    found = found.select("key", mean("lng").alias("_dx"), mean("lat").alias("_dy"))
    out = points.join(found, "key", "left")
    beyond = F.pandas_udf(helmert, "lng double, lat double")(F.when(F.col("_dx").isNull(), F.col("lng")).otherwise(0.0), F.when(F.col("_dx").isNull(), F.col("lat")).otherwise(50.0))
    out = out.withColumn("_far", beyond)
    return out.withColumns({"lng": F.coalesce(F.col("lng") + F.col("_dx"), F.col("_far.lng")), "lat": F.coalesce(F.col("lat") + F.col("_dy"), F.col("_far.lat"))}).drop("_dx", "_dy", "_far")


def applied(shapes: DataFrame, grid: DataFrame) -> DataFrame:
    """shapes with the points of their rings shifted. Rows keep their columns; a row is told by its content, so rows that are alike are shifted once and come back as often."""
    row = shapes.withColumn("_row", F.sha2(F.to_json(F.struct("geom.coordinates")), 256))
    rings = row.select("_row", "geom.coordinates").dropDuplicates(["_row"]).select("_row", F.posexplode("coordinates").alias("ring", "points"))
    points = rings.select("_row", "ring", F.posexplode("points").alias("at", "p"))
    points = points.select("_row", "ring", "at", F.sha2(F.concat_ws("-", "_row", "ring", "at"), 256).alias("key"), F.col("p")[0].alias("lng"), F.col("p")[1].alias("lat"))
    moved = shifted(points, grid)
    moved = moved.groupBy("_row", "ring").agg(F.sort_array(F.collect_list(F.struct("at", F.array("lng", "lat").alias("p")))).alias("points"))
    moved = moved.groupBy("_row").agg(F.transform(F.sort_array(F.collect_list(F.struct("ring", F.transform("points", lambda x: x.p).alias("points")))), lambda x: x.points).alias("_coordinates"))
    out = row.join(moved, "_row", "left")
    return out.withColumn("geom", F.struct(F.col("geom.type").alias("type"), F.coalesce("_coordinates", F.col("geom.coordinates")).alias("coordinates"))).select(*shapes.columns)
