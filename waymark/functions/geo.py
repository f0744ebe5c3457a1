"""Geometry as column expressions: distances, rings and grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2) - F.radians(lat1), F.radians(lon2) - F.radians(lon1)
    a = F.sin(dlat / 2) * F.sin(dlat / 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon / 2) * F.sin(dlon / 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size))


def edges(rings: Column) -> Column:
    """array<struct(x1, y1, x2, y2)> of all rings; a ring that isn't closed is closed."""

    def of(ring: Column) -> Column:
        n = F.size(ring)
        return F.transform(ring, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.get(ring, (i + 1) % n)["x"].alias("x2"), F.get(ring, (i + 1) % n)["y"].alias("y2")))

    return F.flatten(F.transform(rings, of))


def on_edge(x: Column, y: Column, sides: Column) -> Column:
    """The point lies exactly on a side."""
    return F.exists(sides, lambda e: ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def sides_to_the_right(x: Column, y: Column, sides: Column) -> Column:
    """How many sides a ray to the right meets; a side has its lower end and not its upper one."""
    return F.aggregate(sides, F.lit(0), lambda n, e: n + F.when(((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] == e["y1"], F.lit(1.0)).otherwise(e["y2"] - e["y1"]) + e["x1"]), 1).otherwise(0))


def strictly_inside(x: Column, y: Column, sides: Column) -> Column:
    """Even-odd rule over the sides of all rings, so holes and parts need no care; the boundary is outside."""
    return (sides_to_the_right(x, y, sides) % 2 == 1) & ~on_edge(x, y, sides)


def distance_to_sides(x: Column, y: Column, sides: Column) -> Column:
    """Least distance from the point to a side, in the units of the coordinates."""

    def square(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        length = dx * dx + dy * dy
        t = F.when(length == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / F.when(length == 0, F.lit(1.0)).otherwise(length))))
        px, py = x - e["x1"] - t * dx, y - e["y1"] - t * dy
        return px * px + py * py

    return F.sqrt(F.aggregate(sides, F.lit(float("inf")), lambda m, e: F.least(m, square(e))))


def longitude_reach(lat_limit: float, km: float, size: float) -> int:
    """Cells to either side that hold every point within km, up to this latitude."""
    return math.ceil(math.degrees(km / (EARTH_KM * math.cos(math.radians(lat_limit)))) / size)
