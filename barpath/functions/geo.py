"""Places: boxes, polygons, distances and addresses. SURVEY GEO-*, MTH-2, 3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barpath.functions.parse import col

#: A polygon is array<array<struct<x,y>>>: rings, the outer one first. A multipolygon is an array of those.
POLYGON = "array<array<struct<x:double,y:double>>>"


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """MTH-2: to one decimal; null if a coordinate is missing or 0."""
    lat1, lng1, lat2, lng2 = (F.nullif(col(c).cast("double"), F.lit(0.0)) for c in (lat1, lng1, lat2, lng2))
    h = F.power(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.power(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.round(2 * 6371 * F.atan2(F.sqrt(h), F.sqrt(1 - h)), 1)


def diversity(regions, meets) -> Column:
    """MTH-3."""
    return F.round(col(regions) / F.ln(col(meets) + 1), 2)


def polygons(geojson) -> Column:
    """SRC-10: the polygons of a GeoJSON Feature with a Polygon or MultiPolygon."""
    kind = F.get_json_object(col(geojson), "$.geometry.type")
    points = lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    one = F.from_json(F.get_json_object(col(geojson), "$.geometry.coordinates"), "array<array<array<double>>>")
    many = F.from_json(F.get_json_object(col(geojson), "$.geometry.coordinates"), "array<array<array<array<double>>>>")
    return F.when(kind == "Polygon", F.array(F.transform(one, points))).when(kind == "MultiPolygon", F.transform(many, lambda p: F.transform(p, points)))


def bbox(shape) -> Column:
    """GEO-1: a struct of the least and largest x and y of the outer rings."""
    pts = F.flatten(F.transform(col(shape), lambda p: p[0]))
    x, y = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("min_x"), F.array_max(x).alias("max_x"), F.array_min(y).alias("min_y"), F.array_max(y).alias("max_y"))


def in_bbox(x, y, box) -> Column:
    return col(x).between(col(box)["min_x"], col(box)["max_x"]) & col(y).between(col(box)["min_y"], col(box)["max_y"])


def in_ring(x, y, ring: Column) -> Column:
    """GEO-2: does a ray from the point cross the ring an odd number of times?"""
    n = F.size(ring)

    def crossing(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == 1, n).otherwise(i - 1))
        return ((a["y"] > col(y)) != (b["y"] > col(y))) & (col(x) < (b["x"] - a["x"]) * (col(y) - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(False), lambda odd, i: odd != F.coalesce(crossing(i), F.lit(False)))


def in_shape(x, y, shape, holes: bool = False) -> Column:
    """Is the point in a polygon of the shape? The outer ring alone decides, unless ``holes``."""
    inside = lambda p: in_ring(x, y, p[0]) if not holes else in_ring(x, y, p[0]) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda r: in_ring(x, y, r))
    return F.exists(col(shape), inside)


def address_precision(address) -> Column:
    """GEO-11: points for a street number, a street word, a postal code and each comma part up to three; 6 need no new look-up."""
    a = F.coalesce(col(address), F.lit(""))
    has = lambda p, n: F.when(a.rlike(p), n).otherwise(0)
    return has(r"^\d+\s", 2) + has(r"(?i)\b(st|street|ave|avenue|rd|road|blvd|dr|drive|way|ln|lane)\b", 2) + has(r"\b\d{5}(-\d{4})?\b", 2) + F.least(F.size(F.split(a, ",")) - 1, F.lit(3))


def near_any(lat, lng, places: list[tuple[float, float]], within: float = 0.05) -> Column:
    """GEO-12: is the point a known placeholder?"""
    at = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in places])
    return F.exists(at, lambda p: (F.abs(col(lat) - p["a"]) <= within) & (F.abs(col(lng) - p["b"]) <= within))


def address_parts(address) -> Column:
    """GEO-10: a struct of street, city, state, zip and country, from the last part back."""
    a = col(address)
    zip_ = F.nullif(F.regexp_extract(a, r"\b(\d{5}(?:-\d{4})?)\b\s*(?:,[^,]*)?$", 1), F.lit(""))
    country = F.when(a.rlike(r"(?i),\s*(usa|united states|us)\s*$"), "United States")
    plain = F.regexp_replace(F.regexp_replace(a, r"(?i),\s*(usa|united states|us)\s*$", ""), r"\s*\d{5}(-\d{4})?\s*$", "")
    parts = F.split(plain, r"\s*,\s*")
    n = F.size(parts)
    return F.struct(
        F.when(n >= 3, F.get(parts, F.lit(0))).alias("street"), F.when(n >= 2, F.get(parts, n - 2)).alias("city"),
        F.when(n >= 2, F.nullif(F.trim(F.get(parts, n - 1)), F.lit(""))).alias("state"), zip_.alias("zip"), country.alias("country"),
    )
