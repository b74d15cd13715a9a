"""Geometry as columns: no Python runs for any of these.

A polygon is struct<type, coordinates: rings of [lng, lat]>; a ring is closed. Areas
and distances are spherical with radius R; rounding is half up towards +infinity.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

R = 6371008.8
POLYGON = "struct<type:string,coordinates:array<array<array<double>>>>"


def ring(geom: Column | str) -> Column:
    """The exterior ring."""
    return F.col(geom)["coordinates"][0] if isinstance(geom, str) else geom["coordinates"][0]


def rounded(x: Column, places: int = 6) -> Column:
    return F.floor(x * float(10**places) + 0.5) / float(10**places)


def each(coords: Column, f) -> Column:
    """Apply f to every number of a ring's points; f takes the number and its axis (0 lng, 1 lat)."""
    return F.transform(coords, lambda p: F.array(f(p[0], 0), f(p[1], 1)))


def truncated(coords: Column, places: int = 6) -> Column:
    return each(coords, lambda x, _: rounded(x, places))


def shifted(coords: Column, dlng: Column, dlat: Column) -> Column:
    return each(coords, lambda x, axis: x + (dlat if axis else dlng))


def bbox(coords: Column) -> list[Column]:
    """xmin, ymin, xmax, ymax of a ring."""
    xs, ys = F.transform(coords, lambda p: p[0]), F.transform(coords, lambda p: p[1])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def ring_area(coords: Column) -> Column:
    """Square metres that a closed ring surrounds."""
    n = F.size(coords) - 1
    term = lambda a, i: a + (F.radians(coords[(i + 2) % n][0]) - F.radians(coords[i][0])) * F.sin(F.radians(coords[(i + 1) % n][1]))
    return F.when(n < 3, F.lit(0.0)).otherwise(F.abs(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), term)) * (R * R / 2))


def area(geom: Column) -> Column:
    """Exterior less holes."""
    holes = F.aggregate(F.slice(geom["coordinates"], 2, F.greatest(F.size(geom["coordinates"]) - 1, F.lit(0))), F.lit(0.0), lambda a, r: a + ring_area(r))
    return ring_area(geom["coordinates"][0]) - holes


def rect_area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Square metres of a rectangle; none if a side is not positive."""
    size = (F.radians(x1) - F.radians(x0)) * (F.sin(F.radians(y1)) - F.sin(F.radians(y0))) * (R * R)
    return F.when((x1 > x0) & (y1 > y0), size).otherwise(F.lit(0.0))


def center(coords: Column) -> tuple[Column, Column]:
    """The middle of the bounding box."""
    x0, y0, x1, y1 = bbox(coords)
    return (x0 + x1) / 2, (y0 + y1) / 2


def distance(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Metres by the haversine formula."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2) * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return 2 * R * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def same_ring(a: Column, b: Column, within: float = 1e-6) -> Column:
    """As many points, each within the tolerance, in the same order."""
    near = F.forall(F.zip_with(a, b, lambda p, q: (F.abs(p[0] - q[0]) < within) & (F.abs(p[1] - q[1]) < within)), lambda x: x)
    return (F.size(a) == F.size(b)) & F.coalesce(near, F.lit(False))


def offset_stats(old: Column, new: Column) -> Column:
    """struct(same_count, lng_mean, lat_mean, lng_std, lat_std) of new - old, without the closing point."""
    n = F.size(old) - 1

    def stats(axis: int) -> tuple[Column, Column]:
        d = F.zip_with(F.slice(old, 1, n), F.slice(new, 1, n), lambda p, q: q[axis] - p[axis])
        mean = F.aggregate(d, F.lit(0.0), lambda a, x: a + x) / n
        return mean, F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)

    (lng, lng_std), (lat, lat_std) = stats(0), stats(1)
    return F.when((F.size(old) == F.size(new)) & (n > 0), F.struct(lng.alias("lng_mean"), lat.alias("lat_mean"), lng_std.alias("lng_std"), lat_std.alias("lat_std")))


def is_rect(coords: Column) -> Column:
    """An axis-parallel rectangle of five points: its bounding box decides everything."""
    x, y = (lambda i: coords[i][0]), (lambda i: coords[i][1])
    closed = (x(0) == x(4)) & (y(0) == y(4)) & (x(0) != x(2)) & (y(0) != y(2))
    flat = (y(0) == y(1)) & (x(1) == x(2)) & (y(2) == y(3)) & (x(3) == x(0))
    steep = (x(0) == x(1)) & (y(1) == y(2)) & (x(2) == x(3)) & (y(3) == y(0))
    return F.when(F.size(coords) == 5, closed & (flat | steep)).otherwise(F.lit(False))


def is_valid(geom: Column) -> Column:
    """A polygon as constructors take it: rings of four positions or more, each closed."""
    closed = lambda r: F.when(F.size(r) >= 4, (F.element_at(r, 1) == F.element_at(r, -1))).otherwise(F.lit(False))
    return F.coalesce((geom["type"] == "Polygon") & (F.size(geom["coordinates"]) > 0) & F.forall(geom["coordinates"], closed), F.lit(False))


def rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    points = [F.array(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    return F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*points)).alias("coordinates"))


def sheared(x0: Column, y0: Column, x1: Column, y1: Column, slant: float) -> Column:
    """The parallelogram whose points (x, y) have x - slant * y from x0 to x1, and y from y0 to y1."""
    points = [F.array(x + slant * y, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    return F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*points)).alias("coordinates"))


def truncated_shape(geom: Column, places: int = 6) -> Column:
    return F.struct(geom["type"].alias("type"), F.transform(geom["coordinates"], lambda r: truncated(r, places)).alias("coordinates"))


def from_geojson(text: Column) -> Column:
    return F.from_json(text, POLYGON)


def to_geojson(geom: Column) -> Column:
    return F.to_json(geom)


def from_wkt(text: Column) -> Column:
    """POLYGON((lat lng, ...)): pairs in latitude-longitude order, as SRID 4326 has them."""
    rings = F.split(F.regexp_extract(F.trim(text), r"(?is)^polygon\s*\(\s*\((.*)\)\s*\)$", 1), r"\)\s*,\s*\(")
    point = lambda p: F.array(F.split(F.trim(p), r"\s+")[1].cast("double"), F.split(F.trim(p), r"\s+")[0].cast("double"))
    return F.struct(F.lit("Polygon").alias("type"), F.transform(rings, lambda r: F.transform(F.split(r, ","), point)).alias("coordinates"))
