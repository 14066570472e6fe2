"""Distances, boxes and polygons as built-in expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..region import Box
from .columns import Col, col

#: The earth's radius and the length of a degree of latitude, in miles.
EARTH_MILES, DEGREE_MILES = 3958.8, 69.0


def haversine_miles(lat: float, lng: float, latitude: Col = "latitude", longitude: Col = "longitude") -> Column:
    y, x = col(latitude), col(longitude)
    a = F.pow(F.sin(F.radians(y - F.lit(float(lat))) / 2), F.lit(2.0)) + F.cos(F.radians(F.lit(float(lat)))) * F.cos(F.radians(y)) * F.pow(F.sin(F.radians(x - F.lit(float(lng))) / 2), F.lit(2.0))
    return F.lit(EARTH_MILES) * 2 * F.asin(F.sqrt(a))


def haversine(lat1: float, lng1: float, lat2: float, lng2: float) -> float:
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return EARTH_MILES * 2 * math.asin(math.sqrt(a))


def box_around(lat: float, lng: float, miles: float) -> Box:
    high = miles / DEGREE_MILES
    wide = miles / (DEGREE_MILES * max(math.cos(math.radians(lat)), 0.01))
    return Box(lat - high, lat + high, lng - wide, lng + wide)


def in_box(box: Box, latitude: Col = "latitude", longitude: Col = "longitude") -> Column:
    """Plain comparisons, which reach the Parquet scan as pushed filters."""
    return col(latitude).between(box.min_lat, box.max_lat) & col(longitude).between(box.min_lng, box.max_lng)


Ring = list[tuple[float, float]]


def extent(ring: Ring) -> Box:
    return Box(min(y for _, y in ring), max(y for _, y in ring), min(x for x, _ in ring), max(x for x, _ in ring))


def in_polygon(ring: Ring, latitude: Col = "latitude", longitude: Col = "longitude") -> Column:
    """Whether a point is inside a ring of (longitude, latitude) vertices: its box first, then ray casting."""
    y, x = col(latitude), col(longitude)
    edges = list(zip(ring, ring[1:] + ring[:1], strict=True))
    sides = F.array(*[F.struct(F.lit(float(a[0])).alias("ax"), F.lit(float(a[1])).alias("ay"), F.lit(float(b[0])).alias("bx"), F.lit(float(b[1])).alias("by")) for a, b in edges if a[1] != b[1]])

    def crossed(n: Column, e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        return n + F.when(spans & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]), 1).otherwise(0)

    return in_box(extent(ring), y, x) & (F.aggregate(sides, F.lit(0), crossed) % 2 == 1)


def clip(points: DataFrame, ring: Ring) -> DataFrame:
    """Rows inside a ring, with ``in_bbox`` as extracts carry it; the box reaches the scan on its own."""
    return points.where(in_box(extent(ring))).where(in_polygon(ring)).withColumn("in_bbox", F.lit(True))


def extent_of(points: DataFrame) -> DataFrame:
    return points.agg(*[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("min", F.min), ("max", F.max))])


#: Bits a side of the curve's key: cells of about half a metre.
CURVE_BITS = 26
#: Shifts and masks that spread the low 32 bits of a long over its even places.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def curve_key(lat: Column | str, lng: Column | str) -> Column:
    """Place on a space-filling curve over the globe: the bits of latitude and longitude in turn. Null without either.

    Rows sorted by it are near each other where their keys are, so that ranges of rows span small boxes.
    """

    def cells(at: Column | str, low: float, span: float) -> Column:
        at = F.col(at) if isinstance(at, str) else at
        spread = F.least(F.greatest(F.floor((at - low) / span * (1 << CURVE_BITS)), F.lit(0)), F.lit((1 << CURVE_BITS) - 1)).cast("long")
        for shift, mask in SPREAD:
            spread = spread.bitwiseOR(F.shiftleft(spread, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return spread

    # The least of a value and a null is the value: without one of both there is no key.
    known = (F.col(lat) if isinstance(lat, str) else lat).isNotNull() & (F.col(lng) if isinstance(lng, str) else lng).isNotNull()
    return F.when(known, F.shiftleft(cells(lat, -90.0, 180.0), 1).bitwiseOR(cells(lng, -180.0, 360.0)))
