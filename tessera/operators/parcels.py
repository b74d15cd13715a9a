"""Parcel queries: shapes with their ownership by area, number, category or name."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import spatial

LIMIT = 5000
CATEGORIES = [f"proprietor_category_{i}" for i in range(1, 5)]
NAMES = [f"proprietor_name_{i}" for i in range(1, 5)]
#: What the names of church owners contain.
CHURCH = ("diocese", "church commissioners")
#: Columns that both tables have; the parcel's win.
SHARED = {"id", "title_no", "createdAt", "updatedAt"}


def with_ownership(parcels: DataFrame, titles: DataFrame, no_leasehold: bool = False) -> DataFrame:
    """parcels left join titles on title_no; optionally freehold or unmatched only (judged after the join)."""
    own = titles.select(F.col("title_no").alias("_title"), *[c for c in titles.columns if c not in SHARED])
    out = parcels.join(own, parcels.title_no == own["_title"], "left").drop("_title")
    return out.filter((F.col("tenure") == "Freehold") | F.col("tenure").isNull()) if no_leasehold else out


def _has(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(c) for c in names if c in df.columns]


def in_box(parcels: DataFrame, titles: DataFrame, box: tuple[float, float, float, float], kind: str = "all", include_leaseholds: bool = True, limit: int | None = LIMIT) -> DataFrame:
    """Parcels of a box: kind is all, localAuthority or churchOfEngland; at most `limit`, by poly_id."""
    out = with_ownership(spatial.within_box(parcels, *box), titles, not include_leaseholds)
    if kind == "localAuthority":
        out = out.filter(reduce(or_, [c == "Local Authority" for c in _has(out, CATEGORIES)]))
    elif kind == "churchOfEngland":
        out = out.filter(reduce(or_, [c.ilike(f"%{x}%") for c in _has(out, NAMES) for x in CHURCH]))
    elif kind != "all":
        raise ValueError(f"no such type: {kind}")
    return out if limit is None else out.orderBy("poly_id").limit(limit)


def in_polygon(parcels: DataFrame, titles: DataFrame, rings: list[list[list[float]]], include_leaseholds: bool = True, limit: int | None = LIMIT) -> DataFrame:
    out = with_ownership(spatial.in_area(parcels, rings), titles, not include_leaseholds)
    return out if limit is None else out.orderBy("poly_id").limit(limit)


def rings_of(wkt: str) -> list[list[list[float]]]:
    """The rings of a WKT polygon in latitude-longitude order, as lists of [lng, lat]."""
    inner = re.fullmatch(r"(?is)\s*polygon\s*\(\s*\((.*)\)\s*\)\s*", wkt)
    if not inner:
        raise ValueError("not a polygon")
    rings = [[[float(x) for x in p.split()][::-1] for p in ring.split(",")] for ring in re.split(r"\)\s*,\s*\(", inner[1])]
    if any(len(r) < 4 or r[0] != r[-1] for r in rings):
        raise ValueError("a ring has four positions or more and ends where it starts")
    return rings


def in_wkt(parcels: DataFrame, titles: DataFrame, wkt: str) -> DataFrame:
    """All parcels of an area, with ownership."""
    return in_polygon(parcels, titles, rings_of(wkt), limit=None)


def features_of(features: DataFrame, tile_id: int) -> DataFrame:
    """The land features stored for a tile."""
    return features.filter(F.col("tile_id") == tile_id)


def by_ids(parcels: DataFrame, titles: DataFrame, ids: list[int] | None = None, rings: list[list[list[float]]] | None = None, box: tuple | None = None, include_leaseholds: bool = True) -> DataFrame:
    """Parcels by number and/or area."""
    if ids is None and rings is None and box is None:
        raise ValueError("ids or an area are needed")
    if ids is not None:
        parcels = parcels.filter(F.col("poly_id").isin(sorted(set(ids))))
    if rings is not None:
        parcels = spatial.in_area(parcels, rings)
    if box is not None:
        parcels = spatial.within_box(parcels, *box)
    return with_ownership(parcels, titles, not include_leaseholds)


def by_proprietor(parcels: DataFrame, titles: DataFrame, name: str) -> DataFrame:
    """Titles whose first proprietor has this name (case aside), a row for each parcel, or one without."""
    shapes = parcels.select(F.col("title_no").alias("_title"), "poly_id", "geom")
    hit = titles.filter(F.collate("proprietor_name_1", "UNICODE_CI_AI") == F.collate(F.lit(name), "UNICODE_CI_AI"))
    return hit.join(shapes, hit.title_no == shapes["_title"], "left").drop("_title")


def by_title(titles: DataFrame, title_no: str) -> DataFrame:
    return titles.filter(F.col("title_no") == title_no).limit(1)


def pending_in_box(pending: DataFrame, box: tuple[float, float, float, float], accepted_only: bool = False, limit: int = LIMIT) -> DataFrame:
    """Pending shapes of a box; tenure says Accepted or nothing."""
    out = spatial.within_box(pending, *box)
    if accepted_only:
        out = out.filter("accepted")
    return out.withColumn("tenure", F.when(F.col("accepted"), "Accepted").otherwise("")).orderBy("poly_id", "id").limit(limit)


def unregistered_in_box(land: DataFrame, box: tuple[float, float, float, float], limit: int = LIMIT) -> DataFrame:
    return spatial.within_box(land, *box).select(F.col("id").alias("poly_id"), "geom").orderBy("poly_id").limit(limit)


def next_row(df: DataFrame, n: int) -> DataFrame:
    """The first row with id n or more."""
    return df.filter(F.col("id") >= n).orderBy("id").limit(1)


def boundaries(parcels: DataFrame, titles: DataFrame, pending: DataFrame, land: DataFrame, box: tuple[float, float, float, float], kind: str = "all", accepted_only: bool = False) -> DataFrame:
    """The box search by type."""
    if kind == "pending":
        return pending_in_box(pending, box, accepted_only)
    return unregistered_in_box(land, box) if kind == "unregistered" else in_box(parcels, titles, box, kind)
