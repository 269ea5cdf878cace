"""A quadtree over polygon layers whose cells are as small as their edges are dense.

A cell that many edges touch is cut into finer ones, so that a point meets
few edges wherever it lies. Each polygon of a cell is either all around it (no
edge to test) or crosses it. For those that cross, the cell knows whether its
upper right corner is inside; a point of the cell then needs only the edges
that touch the cell: it is inside if the way from the point to the right side
and up to the corner crosses an odd number of edges more than the corner says.

The tree is built from the root down by expressions on arrays of edges, one
row for each ring and cell, without a shuffle inside a round; rows are written
after each round. Cells are known by one integer of level, column and row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.functions.geometry import segment_distance2
from roadtally.session import written

#: Levels at which cells may end; the last ones are 2**-24 of the layer's width.
LEVELS = (6, 9, 12, 15, 18, 21, 24)
DEPTH = LEVELS[-1]
#: Edges of a cell above which it is cut again.
EDGES = 48
#: Margin by which a cell's box is wider when edges are chosen for it, in its own size; more edges than needed do no harm.
MARGIN = 1e-6


@dataclass(frozen=True)
class Grid:
    """Where cells lie: the root's lower left corner and width, and the steps of each level."""

    x0: float
    y0: float
    width: float

    @classmethod
    def over(cls, edges: DataFrame) -> "Grid":
        """A root a little larger than the box around (x1, y1, x2, y2) rows, so that its corner lies outside all polygons."""
        box = edges.agg(
            F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x1"),
            F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("y1", "y2")).alias("y1")).first()
        if box["x0"] is None:
            return cls(0.0, 0.0, 1.0)
        side = max(box["x1"] - box["x0"], box["y1"] - box["y0"], 1e-9)
        return cls(box["x0"] - 0.0137 * side, box["y0"] - 0.0137 * side, 1.0318 * side)

    def widened(self, by: float) -> "Grid":
        return Grid(self.x0 - by, self.y0 - by, self.width + 2 * by)

    def x(self, column: Column, level: int) -> Column:
        return F.lit(self.x0) + column * F.lit(self.width / 2**level)

    def y(self, row: Column, level: int) -> Column:
        return F.lit(self.y0) + row * F.lit(self.width / 2**level)

    def cell(self, x: Column, y: Column, level: int) -> Column:
        """The cell of a point at a level; null outside the root."""
        unit = self.width / 2**DEPTH

        def place(v: Column, start: float) -> Column:
            at = F.floor((v - F.lit(start)) / F.lit(unit))
            return F.when((at >= 0) & (at < 2**DEPTH), F.shiftright(at.cast("long"), DEPTH - level))

        return cell_number(level, place(x, self.x0), place(y, self.y0))


def cell_number(level: int, column: Column, row: Column) -> Column:
    return (F.lit(level << DEPTH).cast("long") + column) * F.lit(1 << DEPTH).cast("long") + row


def spans(e: Column, y: Column) -> Column:
    return (e.y1 > y) != (e.y2 > y)


def height_at(e: Column, x: Column) -> Column:
    """Height of the edge's line at x; null for an upright edge."""
    return F.try_divide((x - e.x1) * (e.y2 - e.y1), e.x2 - e.x1) + e.y1


def left_of(e: Column, x: Column, y: Column) -> Column:
    """Of an edge that spans height y: does it pass that height left of x? One comparison decides for both ways around the corner (x, y)."""
    rising = (e.y2 > e.y1) == (e.x2 > e.x1)
    return F.when((e.x1 <= x) & (e.x2 <= x), F.lit(True)).when((e.x1 > x) & (e.x2 > x), F.lit(False)).otherwise(rising == (height_at(e, x) > y))


def crosses_up(e: Column, x: Column, low: Column, high: Column) -> Column:
    """Does the edge cross the upright line at x between two heights (the upper one included)?"""
    at = height_at(e, x)
    return ((e.x1 > x) != (e.x2 > x)) & F.coalesce((at > low) & (at <= high), F.lit(False))


def odd(edges: Column, test: Callable[[Column], Column]) -> Column:
    return F.aggregate(edges, F.lit(False), lambda n, e: n != test(e))


def touches(e: Column, xa: Column, ya: Column, xb: Column, yb: Column, m: Column) -> Column:
    """Does the edge meet the box, widened by `m`? By boxes and by the side of the edge's line on which the corners lie."""
    cx, cy, hx, hy = (xa + xb) / 2, (ya + yb) / 2, (xb - xa) / 2 + m, (yb - ya) / 2 + m
    dx, dy = e.x2 - e.x1, e.y2 - e.y1
    over = (F.least(e.x1, e.x2) <= xb + m) & (F.greatest(e.x1, e.x2) >= xa - m) & (F.least(e.y1, e.y2) <= yb + m) & (F.greatest(e.y1, e.y2) >= ya - m)
    return over & (F.abs(dx * (cy - e.y1) - dy * (cx - e.x1)) <= F.abs(dx) * hy + F.abs(dy) * hx)


def holds(shape: Column, x: Column, y: Column, right: Column, top: Column) -> Column:
    """Is the point of a cell with this upper right corner strictly inside the shape (base, edges)?"""
    def crossed(e: Column) -> Column:
        at = F.try_divide((e.x2 - e.x1) * (y - e.y1), e.y2 - e.y1) + e.x1
        return (spans(e, y) & F.coalesce(x < at, F.lit(False)) & left_of(e, right, y)) != crosses_up(e, right, y, top)

    def on(e: Column) -> Column:
        turn = (e.x2 - e.x1) * (y - e.y1) - (e.y2 - e.y1) * (x - e.x1)
        return (turn == 0) & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2)) & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))

    return (shape.base != odd(shape.edges, crossed)) & ~F.exists(shape.edges, on)


def _kids(child: Callable[[Column], Column]) -> Column:
    """A row for each quarter of a cell: ix, iy and what `child` makes of the quarter's box, its part (base, edges).

    The box: xa, ya, xb, yb, the right and upper side of the cell that is cut,
    and the numbers of its round (margin, most). These and the grid are read
    from the column `g`, so that one expression serves all rounds.
    """
    g, ix, iy = F.col("g"), F.col("ix"), F.col("iy")
    quarters = F.array(*[F.struct((ix * 2 + i).alias("ix"), (iy * 2 + j).alias("iy")) for i in (0, 1) for j in (0, 1)])
    boxes = F.transform(quarters, lambda q: F.struct(
        q.ix.alias("ix"), q.iy.alias("iy"), (g.x0 + q.ix * g.step).alias("xa"), (g.y0 + q.iy * g.step).alias("ya"),
        (g.x0 + (q.ix + 1) * g.step).alias("xb"), (g.y0 + (q.iy + 1) * g.step).alias("yb"),
        (g.x0 + (ix + 1) * g.above).alias("right"), (g.y0 + (iy + 1) * g.above).alias("top"), g.margin.alias("margin"), g.most.alias("most")))
    return F.explode(F.transform(boxes, lambda b: F.struct(b.ix.alias("ix"), b.iy.alias("iy"), child(b).alias("part")))).alias("kid")


def _halved(rows: DataFrame, kids: Column, grid: Grid, level: int, reach: float) -> DataFrame:
    """Each cell's row of `level` four times, once a quarter; quarters with neither edges nor an inside go."""
    step = grid.width / 2 ** (level + 1)
    g = {"x0": grid.x0, "y0": grid.y0, "step": step, "above": grid.width / 2**level, "margin": MARGIN * step, "most": (reach + step * 0.5**0.5) ** 2 * (1 + 1e-9)}
    rows = rows.withColumn("g", F.struct(*[F.lit(v).alias(k) for k, v in g.items()])).select("place", "name", kids)
    rows = rows.where((F.size("kid.part.edges") > 0) | F.col("kid.part.base"))
    return rows.select("place", "name", "kid.ix", "kid.iy", "kid.part.base", "kid.part.edges")


def kids_within() -> Column:
    """Quarters with the edges that touch each, and whether each one's upper right corner is inside."""
    def child(b: Column) -> Column:
        def passed(e: Column) -> Column:
            return (spans(e, b.yb) & ~left_of(e, b.xb, b.yb) & left_of(e, b.right, b.yb)) != crosses_up(e, b.right, b.yb, b.top)

        edges = F.filter("edges", lambda e: touches(e, b.xa, b.ya, b.xb, b.yb, b.margin))
        return F.struct((F.col("base") != odd(F.col("edges"), passed)).alias("base"), edges.alias("edges"))

    return _kids(child)


def foot(e: Column, x: Column, y: Column) -> Column:
    """(qx, qy): the point of the edge that is nearest to (x, y)."""
    dx, dy = e.x2 - e.x1, e.y2 - e.y1
    along = F.coalesce(F.try_divide((x - e.x1) * dx + (y - e.y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    return F.struct((e.x1 + t * dx).alias("qx"), (e.y1 + t * dy).alias("qy"))


def can_beat(e: Column, q: Column, b: Column) -> Column:
    """Can the edge be nearer than the point q to some point of the box?

    Over the box, the squared distance to the edge less the one to q is the
    least of functions that are linear in the point, so it is least at a corner.
    """
    corners = [(x, y) for x in (b.xa, b.xb) for y in (b.ya, b.yb)]
    tests = [segment_distance2(e, x, y) <= ((x - q.qx) * (x - q.qx) + (y - q.qy) * (y - q.qy)) * F.lit(1 + 1e-9) + F.lit(1e-6) for x, y in corners]
    return tests[0] | tests[1] | tests[2] | tests[3]


def _nearest(edges: Column | str, b: Column) -> Column:
    """(d, e) of each edge, d its squared distance from the box's centre."""
    return F.transform(edges, lambda e: F.struct(segment_distance2(e, (b.xa + b.xb) / 2, (b.ya + b.yb) / 2).alias("d"), e.alias("e")))


def kids_near() -> Column:
    """Quarters with the edges within reach of each that can be nearest to one of its points.

    The witness against the others is the point of all edges that is nearest to the quarter's centre.
    """
    def child(b: Column) -> Column:
        # arrays of one element hold what is used more than once
        seen = F.transform(F.array(_nearest("edges", b)), lambda a: F.struct(
            a.alias("all"), foot(F.array_min(a).e, (b.xa + b.xb) / 2, (b.ya + b.yb) / 2).alias("q")))
        kept = F.transform(seen, lambda p: F.transform(F.filter(p["all"], lambda f: (f.d <= b.most) & can_beat(f.e, p.q, b)), lambda f: f.e))
        return F.struct(F.lit(False).alias("base"), F.element_at(kept, 1).alias("edges"))

    return _kids(child)


def _first_around(rows: DataFrame) -> DataFrame:
    """Of each cell the shapes up to the first, in order, that is all around it: later ones never decide."""
    shapes = rows.groupBy("ix", "iy", "name").agg(
        F.min("place").alias("place"), (F.sum(F.col("base").cast("int")) % 2 == 1).alias("base"), F.flatten(F.collect_list("edges")).alias("edges"))
    me = F.struct("place", "name")
    shapes = shapes.where((F.size("edges") > 0) | F.col("base")).withColumn("first", F.min(F.when(F.size("edges") == 0, me)).over(Window.partitionBy("ix", "iy")))
    return shapes.where(F.col("first").isNull() | (me <= F.col("first"))).drop("first")


def _nearest_only(rows: DataFrame, grid: Grid, level: int) -> DataFrame:
    """Of each cell the edges that can be nearest, over all rings: see `kids_near`."""
    box = F.struct(
        grid.x(F.col("ix"), level).alias("xa"), grid.y(F.col("iy"), level).alias("ya"),
        grid.x(F.col("ix") + 1, level).alias("xb"), grid.y(F.col("iy") + 1, level).alias("yb"))
    rows = rows.withColumn("box", box)
    least = F.transform(F.array(F.array_min(_nearest("edges", F.col("box")))), lambda n: F.struct(
        n.d.alias("d"), foot(n.e, (F.col("box.xa") + F.col("box.xb")) / 2, (F.col("box.ya") + F.col("box.yb")) / 2).alias("q")))
    kept = rows.withColumn("witness", F.min(F.element_at(least, 1)).over(Window.partitionBy("ix", "iy")))
    kept = kept.withColumn("edges", F.filter("edges", lambda e: can_beat(e, F.col("witness.q"), F.col("box"))))
    kept = kept.where(F.size("edges") > 0)
    return kept.groupBy("ix", "iy", "name").agg(F.min("place").alias("place"), F.lit(False).alias("base"), F.flatten(F.collect_list("edges")).alias("edges"))


def leaves(rings: DataFrame, grid: Grid, reach: float | None = None, edges: int = EDGES) -> dict[int, tuple[DataFrame, int, int]]:
    """Level -> (cell, shapes), their edges and cells, of the cells that end there; shapes: (place, name, base, edges) in order.

    `rings`: place, name, edges, one row a ring. Without `reach`, cells know
    what contains their points, else the edges that are nearest to them.
    """
    rows = rings.select("place", "name", F.lit(0).cast("long").alias("ix"), F.lit(0).cast("long").alias("iy"), F.lit(False).alias("base"), "edges")
    out: dict[int, tuple[DataFrame, int, int]] = {}
    kids = kids_within() if reach is None else kids_near()
    at = 0
    for level in LEVELS:
        while at < level:
            rows = _halved(rows, kids, grid, at, reach or 0.0)
            at += 1
        shapes = _first_around(rows) if reach is None else _nearest_only(rows, grid, level)
        shapes = written(shapes.withColumn("n_edges", F.sum(F.size("edges")).over(Window.partitionBy("ix", "iy"))), f"quadtree-{level}")
        ends = (F.col("n_edges") <= edges) | F.lit(level == DEPTH)
        done = shapes.where(ends).groupBy(cell_number(level, F.col("ix"), F.col("iy")).alias("cell")).agg(
            F.max("n_edges").alias("n_edges"), F.array_sort(F.collect_list(F.struct("place", "name", "base", "edges"))).alias("shapes"))
        table = written(done, f"quadtree-leaves-{level}")
        size = table.agg(F.coalesce(F.sum("n_edges"), F.lit(0)).alias("edges"), F.count(F.lit(1)).alias("cells")).first()
        if size["cells"]:
            out[level] = table.select("cell", "shapes"), size["edges"], size["cells"]
        rows = shapes.where(~ends).select("place", "name", "ix", "iy", "base", "edges")
        if rows.isEmpty():
            break
    return out
