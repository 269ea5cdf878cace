"""Plane geometry on edge arrays: array<struct<x1,y1,x2,y2>>."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import col_of

EARTH_RADIUS_M = 6378137.0


def mercator_x(lon: Column | str) -> Column:
    return F.radians(col_of(lon).cast("double")) * F.lit(EARTH_RADIUS_M)


def mercator_y(lat: Column | str) -> Column:
    half = F.radians(col_of(lat).cast("double")) / F.lit(2.0) + F.lit(math.pi / 4)
    return F.ln(F.tan(half)) * F.lit(EARTH_RADIUS_M)


def crosses_right(edge: Column, x: Column, y: Column) -> Column:
    """Does a ray from (x, y) towards +x cross the edge?"""
    spans = (edge.y1 > y) != (edge.y2 > y)
    at = F.try_divide((edge.x2 - edge.x1) * (y - edge.y1), edge.y2 - edge.y1) + edge.x1
    return spans & F.coalesce(x < at, F.lit(False))


def on_edge(edge: Column, x: Column, y: Column) -> Column:
    turn = (edge.x2 - edge.x1) * (y - edge.y1) - (edge.y2 - edge.y1) * (x - edge.x1)
    between_x = x.between(F.least(edge.x1, edge.x2), F.greatest(edge.x1, edge.x2))
    between_y = y.between(F.least(edge.y1, edge.y2), F.greatest(edge.y1, edge.y2))
    return (turn == 0) & between_x & between_y


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Strictly inside, by the even-odd rule over all rings' edges.

    Holes and parts need no case of their own; a point on an edge is outside.
    """
    hits = F.aggregate(edges, F.lit(0), lambda n, e: n + crosses_right(e, x, y).cast("int"))
    return (hits % 2 == 1) & ~F.exists(edges, lambda e: on_edge(e, x, y))


def segment_distance2(edge: Column, x: Column, y: Column) -> Column:
    """Squared distance from (x, y) to the edge."""
    dx, dy = edge.x2 - edge.x1, edge.y2 - edge.y1
    along = F.coalesce(F.try_divide((x - edge.x1) * dx + (y - edge.y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    ex, ey = edge.x1 + t * dx - x, edge.y1 + t * dy - y
    return ex * ex + ey * ey


def min_distance2(edges: Column, x: Column, y: Column) -> Column:
    return F.array_min(F.transform(edges, lambda e: segment_distance2(e, x, y)))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring array<struct<x,y>>; an unclosed ring is closed."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
    )
