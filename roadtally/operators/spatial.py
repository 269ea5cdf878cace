"""Points against polygon layers, by the cells of a quadtree.

A polygon layer is a table of (name, ring) with one row per ring, where ring
is array<struct<x,y>> in longitude / latitude. Several rings of one name are
its parts and holes. The layer is cut into cells (see `quadtree`); a point then
meets only the edges of its own cell, by an equi-join on the cell's number.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.functions.geometry import mercator_x, mercator_y, min_distance2, ring_edges
from roadtally.operators.columns import quoted
from roadtally.operators.joins import MAX_BROADCAST_ROWS, spread_join
from roadtally.operators.quadtree import DEPTH, Grid, holds, leaves

# Largest number of indexed edges that is sent to every executor.
MAX_BROADCAST_EDGES = 2_000_000


def polygon_edges(polygons: DataFrame, name: str = "name", projected: bool = False) -> DataFrame:
    """(place, name, x1, y1, x2, y2): one row per edge. `place` orders the names.

    With `projected` the coordinates are Web-Mercator metres.
    """
    order = "place" if "place" in polygons.columns else name
    edges = polygons.select(
        F.col(quoted(order)).alias("place"), F.col(quoted(name)).alias("name"), F.explode(ring_edges(F.col("ring"))).alias("e")
    ).select("place", "name", "e.*")
    if not projected:
        return edges.selectExpr("place", "name", *[f"cast({c} as double) {c}" for c in ("x1", "y1", "x2", "y2")])
    return edges.select(
        "place", "name",
        mercator_x("x1").alias("x1"), mercator_y("y1").alias("y1"), mercator_x("x2").alias("x2"), mercator_y("y2").alias("y2"),
    )


@dataclass(frozen=True)
class CellIndex:
    """Shapes by cell, a table for each level of the quadtree that has any. Small tables are broadcast."""

    grid: Grid
    levels: dict[int, tuple[DataFrame, bool]]

    @property
    def small(self) -> bool:
        return all(small for _, small in self.levels.values())


def _rings(polygons: DataFrame, name: str = "name", projected: bool = False) -> DataFrame:
    """(place, name, edges): one row per ring."""
    order = "place" if "place" in polygons.columns else name
    edges = F.transform(ring_edges(F.col("ring")), lambda e: F.struct(*[e[c].cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]))
    if projected:
        edges = F.transform(edges, lambda e: F.struct(
            mercator_x(e.x1).alias("x1"), mercator_y(e.y1).alias("y1"), mercator_x(e.x2).alias("x2"), mercator_y(e.y2).alias("y2")))
    return polygons.select(F.col(quoted(order)).alias("place"), F.col(quoted(name)).alias("name"), edges.alias("edges"))


def _index(polygons: DataFrame, reach: float | None, max_edges: int, max_cells: int) -> CellIndex:
    """The layer's quadtree; each level's table is broadcast if its edges and cells are few enough."""
    grid = Grid.over(polygon_edges(polygons, projected=reach is not None)).widened(reach or 0.0)
    found = leaves(_rings(polygons, projected=reach is not None), grid, reach)
    return CellIndex(grid, {level: (table, n <= max_edges and cells <= max_cells) for level, (table, n, cells) in found.items()})


class Layer:
    """A polygon layer with its indexes, each built once on first use."""

    def __init__(self, polygons: DataFrame, max_edges: int = MAX_BROADCAST_EDGES, max_cells: int = MAX_BROADCAST_ROWS):
        self.polygons = polygons
        self.limits = (max_edges, max_cells)
        self._near: dict[float, CellIndex] = {}

    @cached_property
    def within(self) -> CellIndex:
        return _index(self.polygons, None, *self.limits)

    def near(self, reach: float) -> CellIndex:
        if reach not in self._near:
            self._near[reach] = _index(self.polygons, reach, *self.limits)
        return self._near[reach]


def as_layer(polygons: DataFrame | Layer) -> Layer:
    return polygons if isinstance(polygons, Layer) else Layer(polygons)


def _with_shapes(points: DataFrame, index: CellIndex, x: Column, y: Column, only: Column | None) -> DataFrame:
    """Attach the shapes of each point's cell, and the cell's level. A cell is in one level's table, so rows stay as many.

    A point without coordinates, outside the layer or outside `only` has no
    cell and meets nothing; one that met its cell looks no further.
    """
    placed = points.withColumns({"_x": x, "_y": y, "_level": F.lit(None).cast("int")})
    found = None
    for level, (table, small) in index.levels.items():
        cell = F.when(F.col("_level").isNull(), index.grid.cell(F.col("_x"), F.col("_y"), level))
        placed = placed.withColumn("_cell", cell if only is None else F.when(only, cell))
        table = table.select(F.col("cell").alias("_cell"), F.col("shapes").alias(f"_shapes_{level}"))
        placed = placed.join(F.broadcast(table), "_cell", "left") if small else spread_join(placed, table, "_cell", "left")
        mine = F.col(f"_shapes_{level}")
        placed = placed.withColumn("_level", F.when(mine.isNotNull(), F.lit(level)).otherwise(F.col("_level")))
        found = mine if found is None else F.coalesce(found, mine)
    empty = F.lit(None).cast("array<struct<place:int,name:string,base:boolean,edges:array<struct<x1:double,y1:double,x2:double,y2:double>>>>")
    return placed.withColumn("shapes", empty if found is None else found)


def _corner(index: CellIndex, v: str, start: float) -> Column:
    """The right or upper side of each point's cell, computed as the quadtree does."""
    out = F.lit(None).cast("double")
    for level in index.levels:
        unit = index.grid.width / 2**DEPTH
        at = F.shiftright(F.floor((F.col(v) - F.lit(start)) / F.lit(unit)).cast("long"), DEPTH - level) + 1
        out = F.when(F.col("_level") == level, F.lit(start) + at * F.lit(index.grid.width / 2**level)).otherwise(out)
    return out


def point_in_polygon(
    points: DataFrame,
    polygons: DataFrame | Layer,
    out: str = "polygon",
    lat: str = "latitude",
    lon: str = "longitude",
    only: Column | None = None,
) -> DataFrame:
    """Add the first polygon (by `place`, else by name) that contains each point, else null."""
    x, y = F.col(quoted(lon)).cast("double"), F.col(quoted(lat)).cast("double")
    index = as_layer(polygons).within
    joined = _with_shapes(points, index, x, y, only)
    joined = joined.withColumns({"_right": _corner(index, "_x", index.grid.x0), "_top": _corner(index, "_y", index.grid.y0)})
    holding = F.filter("shapes", lambda s: holds(s, F.col("_x"), F.col("_y"), F.col("_right"), F.col("_top")))
    return joined.withColumn(out, F.try_element_at(holding, F.lit(1))["name"]).select(*[quoted(c) for c in points.columns], out)


def nearest_polygon(
    points: DataFrame,
    polygons: DataFrame | Layer,
    out: str = "polygon",
    max_m: float = 2000.0,
    lat: str = "latitude",
    lon: str = "longitude",
    distance: str | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Add the polygon nearest to each point within `max_m` Web-Mercator metres, else null.

    The nearest edge decides, ties go to the first polygon. Points are expected
    to lie outside all polygons; `locate` takes those inside first.
    """
    x, y = mercator_x(quoted(lon)), mercator_y(quoted(lat))
    joined = _with_shapes(points, as_layer(polygons).near(max_m), x, y, only)
    ranked = F.transform(
        "shapes",
        lambda s: F.struct(min_distance2(s.edges, F.col("_x"), F.col("_y")).alias("d2"), s.place.alias("place"), s["name"].alias("name")),
    )
    best = F.array_min(ranked)
    near = F.when(best.d2 <= F.lit(max_m * max_m), best)
    cols = {out: near["name"]} if not distance else {out: near["name"], distance: F.sqrt(near["d2"])}
    return joined.withColumns(cols).select(*[quoted(c) for c in points.columns], *cols)


def locate(
    points: DataFrame, polygons: DataFrame | Layer, out: str, max_m: float = 2000.0, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Containing polygon, else the nearest one within `max_m`, else null.

    Only the points that no polygon contains go through the distance step.
    """
    layer = as_layer(polygons)
    placed = point_in_polygon(points, layer, "_within", lat, lon)
    near = nearest_polygon(placed, layer, "_near", max_m, lat, lon, only=F.col("_within").isNull())
    return near.withColumn(out, F.coalesce("_within", "_near")).drop("_within", "_near")


def fill_place(points: DataFrame, polygons: DataFrame | Layer, c: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Fill a missing place name from the polygon that contains the point."""
    found = point_in_polygon(points, polygons, "_place_name", lat, lon, only=F.col(quoted(c)).isNull())
    return found.withColumn(c, F.coalesce(F.col(quoted(c)), F.col("_place_name"))).drop("_place_name")


def rectangle(name: str, west: float, south: float, east: float, north: float) -> tuple:
    """(name, ring) of an axis-parallel box, for tests and fixed layers."""
    return name, [(west, south), (east, south), (east, north), (west, north)]


def polygon_table(spark, shapes: list[tuple]) -> DataFrame:
    """Layer from (name, [(x, y), ...]) pairs, in the order given."""
    rows = [
        {"place": i, "name": n, "ring": [{"x": float(x), "y": float(y)} for x, y in ring]} for i, (n, ring) in enumerate(shapes)
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows), "place int, name string, ring array<struct<x:double,y:double>>")
