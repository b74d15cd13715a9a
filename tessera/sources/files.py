"""Readers and writers: ownership CSV, catalogues, GeoJSON, GML, partitioned tables."""

from __future__ import annotations

import csv
import io
import itertools
import math
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry

FOOTER = "Row Count:"


def ownership_csv(spark: SparkSession, path: str) -> DataFrame:
    """Titles as text columns, without footers."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.filter(~F.col("Title Number").eqNullSafe(F.lit(FOOTER)))


def zipped_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of the CSV files within zip archives, as text columns, without footers; other entries are passed over.

    A task reads an archive's lines one after the other. The header of one archive
    gives the columns, unless they are named.
    """
    archives = spark.read.format("binaryFile").load(path).select("content")
    names = columns or archives.mapInPandas(_heads, "names array<string>").filter("names is not null").first()[0]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                for reader in _csvs(content):
                    kept = ({n: r.get(n) for n in names} for r in csv.DictReader(reader) if sum(v is not None for v in r.values()) != 2 and r.get("Title Number") != FOOTER)
                    while chunk := list(itertools.islice(kept, 10_000)):
                        yield pd.DataFrame(chunk, columns=names)

    return archives.mapInPandas(rows, ", ".join(f"`{n}` string" for n in names))


def _csvs(content: bytes) -> Iterator[io.TextIOWrapper]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in z.namelist():
            if name.lower().endswith(".csv"):
                yield io.TextIOWrapper(z.open(name), "utf-8-sig", newline="")


def _heads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"names": [next((next(csv.reader(r), None) for r in _csvs(c)), None) for c in frame["content"]]})


def full_ownerships(spark: SparkSession, uk: str, overseas: str) -> DataFrame:
    """The full data set: titles of companies at home, then abroad."""
    return named(zipped_csv(spark, uk), False).unionByName(named(zipped_csv(spark, overseas), True), allowMissingColumns=True)


def catalogues(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All catalogues' files in one list."""
    out = catalogue(spark, paths[0])
    for path in paths[1:]:
        out = out.unionByName(catalogue(spark, path))
    return out


def named(df: DataFrame, overseas: bool) -> DataFrame:
    """Header names to column names, blanks to null (but tenure), dates parsed."""
    from tessera.operators.ownership import iso_date

    def name(c: str) -> str:
        words = c.replace("(", "").replace(")", "").replace(".", "").lower().replace("proprietorship", "proprietor").split()
        return {"title number": "title_no"}.get(c.lower(), "_".join(words))

    cols = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        cols.append((iso_date(x) if name(c) == "date_proprietor_added" else x if name(c) in ("tenure", "title_no") else F.nullif(x, F.lit(""))).alias(name(c)))
    return df.select(*cols, F.lit(not overseas).alias("proprietor_uk_based"))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(filename, type, file_size, file_date, download) from a JSON list; dates as DD-MM-YYYY or ISO."""
    df = spark.read.schema("filename string, type string, file_size string, unsorted_date string, download string").json(path, multiLine=True)
    return df.withColumn("file_date", F.coalesce(F.try_to_date("unsorted_date", "dd-MM-yyyy"), F.try_to_date(F.substring("unsorted_date", 1, 10), "yyyy-MM-dd"))).drop("unsorted_date")


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, geom): a row for each polygon of a feature collection, multipolygons flattened."""
    shape = "struct<type:string,coordinates:string>"
    df = spark.read.schema(f"features array<struct<properties:map<string,string>,geometry:{shape}>>").json(path, multiLine=True)
    rows = df.select(F.explode("features").alias("f")).select("f.properties", "f.geometry")
    one = F.array(F.from_json("geometry.coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))))
    many = F.from_json("geometry.coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))))
    rows = rows.select("properties", F.explode(F.when(F.col("geometry.type") == "MultiPolygon", many).otherwise(one)).alias("c"))
    return rows.select("properties", F.struct(F.lit("Polygon").alias("type"), F.col("c").alias("coordinates")).alias("geom"))


#: The countries whose land is mapped.
COUNTRIES = ("England", "Wales")


def countries(spark: SparkSession, path: str) -> DataFrame:
    """(id, geom): polygons of the countries in a boundary file."""
    rows = geojson(spark, path).filter(F.col("properties")["CTRY24NM"].isin(*COUNTRIES))
    return rows.select(F.xxhash64(F.to_json("geom")).alias("id"), "geom")


#: Half axes of Airy 1830.
AIRY = (6377563.396, 6356256.909)


def to_wgs84(easting: pd.Series, northing: pd.Series) -> pd.DataFrame:
    """National Grid metres to WGS84 degrees by the seven-parameter shift."""
    p = unprojected(easting, northing)
    return helmert(p["lng"], p["lat"])


def unprojected(easting: pd.Series, northing: pd.Series) -> pd.DataFrame:
    """National Grid metres to degrees on Airy 1830: inverse transverse Mercator.

    Fixed values: the projection.
    """
    import numpy as np

    (a, b), f0, lat0, lng0, e0, n0 = AIRY, 0.9996012717, math.radians(49), math.radians(-2), 400000.0, -100000.0
    e, n = np.asarray(easting, float), np.asarray(northing, float)
    e2, k = 1 - b * b / (a * a), (a - b) / (a + b)

    def arc(lat):
        d, s = lat - lat0, lat + lat0
        return b * f0 * ((1 + k + 1.25 * k**2 + 1.25 * k**3) * d - (3 * k + 3 * k**2 + 21 / 8 * k**3) * np.sin(d) * np.cos(s) + (15 / 8 * (k**2 + k**3)) * np.sin(2 * d) * np.cos(2 * s) - 35 / 24 * k**3 * np.sin(3 * d) * np.cos(3 * s))

    lat = lat0 + (n - n0) / (a * f0)
    for _ in range(8):
        lat = lat + (n - n0 - arc(lat)) / (a * f0)
    s2 = np.sin(lat) ** 2
    v, p = a * f0 / np.sqrt(1 - e2 * s2), a * f0 * (1 - e2) / (1 - e2 * s2) ** 1.5
    h, t, c, x = v / p - 1, np.tan(lat), 1 / np.cos(lat), e - e0
    phi = lat - t / (2 * p * v) * x**2 + t / (24 * p * v**3) * (5 + 3 * t**2 + h - 9 * t**2 * h) * x**4 - t / (720 * p * v**5) * (61 + 90 * t**2 + 45 * t**4) * x**6
    lam = lng0 + c / v * x - c / (6 * v**3) * (v / p + 2 * t**2) * x**3 + c / (120 * v**5) * (5 + 28 * t**2 + 24 * t**4) * x**5 - c / (5040 * v**7) * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) * x**7
    return pd.DataFrame({"lng": np.degrees(lam), "lat": np.degrees(phi)})


def helmert(lng: pd.Series, lat: pd.Series) -> pd.DataFrame:
    """Degrees on Airy 1830 to WGS84 by seven parameters.

    Fixed values: the ellipsoid and the published parameters (metres-level).
    """
    import numpy as np

    (a, b), lam, phi = AIRY, np.radians(np.asarray(lng, float)), np.radians(np.asarray(lat, float))
    e2 = 1 - b * b / (a * a)
    v = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    px, py, pz = v * np.cos(phi) * np.cos(lam), v * np.cos(phi) * np.sin(lam), (1 - e2) * v * np.sin(phi)
    tx, ty, tz, scale = 446.448, -125.157, 542.060, 1 - 20.4894e-6
    rx, ry, rz = (math.radians(s / 3600) for s in (0.1502, 0.2470, 0.8421))
    qx, qy, qz = tx + scale * px - rz * py + ry * pz, ty + rz * px + scale * py - rx * pz, tz - ry * px + rx * py + scale * pz
    wa, wb = 6378137.0, 6356752.314245
    we2, r = 1 - wb * wb / (wa * wa), np.hypot(qx, qy)
    out = np.arctan2(qz, r * (1 - we2))
    for _ in range(6):
        out = np.arctan2(qz + we2 * wa / np.sqrt(1 - we2 * np.sin(out) ** 2) * np.sin(out), r)
    return pd.DataFrame({"lng": np.degrees(np.arctan2(qy, qx)), "lat": np.degrees(out)})


def _positions(lists: pd.Series) -> pd.Series:
    """Rings of positions of each feature's lists of numbers."""
    return _rings(lists, to_wgs84)


def _airy_positions(lists: pd.Series) -> pd.Series:
    return _rings(lists, unprojected)


def _rings(lists: pd.Series, degrees: Callable[[pd.Series, pd.Series], pd.DataFrame]) -> pd.Series:
    out = []
    for texts in lists:
        rings = []
        for text in texts:
            xy = [float(x) for x in (text or "").split()]
            p = degrees(pd.Series(xy[0::2], dtype=float), pd.Series(xy[1::2], dtype=float))
            rings.append([[a, b] for a, b in zip(p["lng"].tolist(), p["lat"].tolist(), strict=True)])
        out.append(rings)
    return pd.Series(out, dtype=object)


def gml(spark: SparkSession, path: str, council: str | None = None, grid: str | None = None) -> DataFrame:
    """(poly_id, geom, council) from feature files in National Grid coordinates; without a name, a file's own names the council.

    grid: path of an NTv2 file from Airy 1830 to WGS84; without it the shift is by seven parameters, metres off.

    A row is a feature, so two features of one id stay two shapes. Files without features give none.
    """
    schema = "`LR:INSPIREID` long, `LR:GEOMETRY` struct<`gml:Polygon`:struct<`gml:exterior`:struct<`gml:LinearRing`:struct<`gml:posList`:string>>,`gml:interior`:array<struct<`gml:LinearRing`:struct<`gml:posList`:string>>>>>"
    df = spark.read.format("xml").option("rowTag", "LR:PREDEFINED").schema(schema).load(path)
    polygon = F.col("`LR:GEOMETRY`.`gml:Polygon`")
    outer = F.array(polygon["gml:exterior"]["gml:LinearRing"]["gml:posList"])
    holes = F.transform(F.coalesce(polygon["gml:interior"], F.array().cast("array<struct<`gml:LinearRing`:struct<`gml:posList`:string>>>")), lambda x: x["gml:LinearRing"]["gml:posList"])
    rings = F.pandas_udf(_positions if grid is None else _airy_positions, "array<array<array<double>>>")
    name = F.lit(council) if council is not None else F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"(?i)(%20|\.gml$)", "")
    shapes = df.select(F.col("`LR:INSPIREID`").alias("poly_id"), name.alias("council"), rings(F.concat(outer, holes)).alias("c"))
    shapes = shapes.select("poly_id", F.struct(F.lit("Polygon").alias("type"), F.col("c").alias("coordinates")).alias("geom"), "council")
    if grid is None:
        return shapes
    from tessera.sources import gridshift

    return gridshift.applied(shapes, gridshift.cells(spark, grid))


def latest_month(spark: SparkSession, folder: str) -> str | None:
    """The last of the folders named by month."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    return names.select(F.regexp_extract("path", r"/([0-9]{4}-[0-9]{2})/[^/]*$", 1).alias("m")).filter("m <> ''").agg(F.max("m")).first()[0]


def unzipped(spark: SparkSession, archives: DataFrame, target: str) -> None:
    """(council, content) archives: their feature file as target/<council>.gml, in the shared folder that target names, by tasks."""

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for council, content in zip(frame["council"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.lower().endswith(".gml"):
                            yield pd.DataFrame({"council": [council], "value": [z.read(name).decode("utf-8-sig")]})

    archives.select("council", "content").mapInPandas(texts, "council string, value string").write.mode("overwrite").partitionBy("council").option("lineSep", "\n").text(target)


def archived(spark: SparkSession, folder: str) -> DataFrame:
    """(path, council) of a folder's archives."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    return found.select("path", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.zip$", "").alias("council"))


def load_councils(spark: SparkSession, folder: str, work: str, target: str, after: str | None = None, most: int = 10_000, only: list[str] | None = None) -> None:
    """Archives <council>.zip of a folder, or those of the councils `only`, into the councils' partitions at target; councils without features keep what they have."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    names = archived(spark, folder)
    if only is not None:
        names = names.filter(F.col("council").isin(only))
    listed = councils_after(names.withColumn("ordinal", F.rank().over(Window.orderBy("council"))), after, most)  # one row a council, a few hundred
    unzipped(spark, found.join(F.broadcast(listed.select("path", "council")), "path"), work)
    if listed.isEmpty():
        return
    shapes = gml(spark, work).withColumn("council", F.regexp_extract(F.input_file_name(), r"/council=([^/]*)/", 1))
    write_councils(shapes, target)


def write_councils(df: DataFrame, path: str) -> None:
    """Replace the partitions of the councils that df has, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("council").parquet(path)


def councils_after(councils: DataFrame, after: str | None = None, most: int = 10_000) -> DataFrame:
    """(ordinal, council) behind the first whose name contains `after`, `most` at most."""
    if after:
        first = councils.filter(F.col("council").contains(after)).agg(F.min("ordinal").alias("_at"))
        councils = councils.join(F.broadcast(first), F.col("ordinal") > F.col("_at")).drop("_at")  # one row
    return councils.orderBy("ordinal").limit(most)
