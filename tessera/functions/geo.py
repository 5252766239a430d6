"""Geometry in text columns: parsing, well-known text, area, distance and containment as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import text_of
from tessera.operators.proximity import haversine_m

BOUNDS = (45.7, 48.6, 16.1, 22.9)  # fixed values: south, north, west, east of the country


def _pair(entry: Column) -> Column:
    """(lat, lon) texts of an entry, or null if it is not two numbers on the globe."""
    p = F.split(F.trim(F.regexp_replace(entry, r"\s+", " ")), " ")
    lat, lon = F.get(p, 0).try_cast("double"), F.get(p, 1).try_cast("double")
    return F.when((F.size(p) == 2) & lat.between(-90, 90) & lon.between(-180, 180), F.struct(F.get(p, 0).alias("lat"), F.get(p, 1).alias("lon")))


def point_wkt(c: Column | str) -> Column:
    """``"lat lon"`` as ``POINT(lon lat)`` with the numbers as written; null if it is not a point on the globe."""
    p = _pair(text_of(c))
    return F.when(p.isNotNull(), F.concat(F.lit("POINT("), p["lon"], F.lit(" "), p["lat"], F.lit(")")))


def corners(c: Column | str) -> Column:
    """Usable (lat, lon) entries of a polygon text, in order."""
    return F.filter(F.transform(F.split(text_of(c), ","), _pair), lambda p: p.isNotNull())


def polygon_wkt(c: Column | str) -> Column:
    """``"lat lon,..."`` as a closed ``POLYGON((lon lat, ...))``; null with fewer than three usable corners."""
    t = F.transform(corners(c), lambda p: F.concat(p["lon"], F.lit(" "), p["lat"]))
    closed = F.when(F.get(t, 0) == F.element_at(t, -1), t).otherwise(F.concat(t, F.array(F.get(t, 0))))
    return F.when(F.size(t) >= 3, F.concat(F.lit("POLYGON(("), F.array_join(closed, ", "), F.lit("))")))


def swapped(c: Column | str) -> Column:
    """Number pairs exchanged wherever two unsigned numbers stand side by side."""
    return F.regexp_replace(text_of(c), r"([0-9.]+) ([0-9.]+)", "$2 $1")


def shoelace(c: Column | str) -> Column:
    """Area of a polygon text in square degrees, by the shoelace rule; null with fewer than three corners."""
    p = F.transform(corners(c), lambda x: F.struct(x["lat"].cast("double").alias("y"), x["lon"].cast("double").alias("x")))
    turn = F.concat(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, 1))
    cross = F.zip_with(p, turn, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.when(F.size(p) >= 3, F.abs(F.aggregate(cross, F.lit(0.0), lambda acc, v: acc + v)) / 2)


def touching(regions: DataFrame, key: str, polygon: str, least: int = 2) -> DataFrame:
    """Pairs of regions (``a`` < ``b``) that share at least ``least`` corners, as written, and how many (``corners``)."""
    p = regions.select(F.col(key).cast("string").alias("id"), F.explode(corners(polygon)).alias("p")).select("id", F.concat("p.lat", F.lit(" "), "p.lon").alias("corner")).distinct()
    pairs = p.withColumnRenamed("id", "a").join(p.withColumnRenamed("id", "b"), "corner").where("a < b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("corners")).where(F.col("corners") >= least)


def geojson_point(lat: Column, lon: Column) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), F.to_json(F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))))


def in_bounds(lat: Column, lon: Column, bounds: tuple[float, float, float, float] = BOUNDS) -> Column:
    """Whether a point lies in a bounding box; false where a coordinate is missing."""
    s, n, w, e = bounds
    return F.coalesce(lat.between(s, n) & lon.between(w, e), F.lit(False))


__all__ = ["point_wkt", "polygon_wkt", "corners", "swapped", "shoelace", "touching", "geojson_point", "in_bounds", "haversine_m", "BOUNDS"]
