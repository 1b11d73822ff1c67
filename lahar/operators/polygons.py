"""Polygons as tables of edges (shape, x1, y1, x2, y2[, value]): even-odd fill, containment, bounded nearest.

A point is inside a shape if a ray crosses its edges an odd number of times; over all rings of a shape this is the
even-odd fill. Fills go row by row: the crossings of a row's centre line in order, and the cells between pairs, so rows
made are edges times the rows they span, plus the cells filled.

For containment each shape is laid out in cells that suit its own size: cells that an edge passes, with these edges, and
cells wholly inside. A point meets the shapes of its own cell alone. In a whole cell it is inside; in another it is, if
the edges there part it from the cell's reference point or not. So the pairs tried are those found and a share besides,
however many shapes lie over one another.
"""

from __future__ import annotations

from math import log2, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.functions import geo, grid

XY = ["x1", "y1", "x2", "y2"]
#: Where in a cell its reference point lies: no coordinate of data falls there.
AT = (0.3819660112501051, 0.6180339887498949)
#: A shape of n edges is about ACROSS * sqrt(n) cells wide; cells have these levels at least and at most.
ACROSS, COARSEST, FINEST = 6, -8, 12


def closed_edges(rings: DataFrame) -> DataFrame:
    """(shape, ..., ring array of (x, y)) to edges; open rings and rings under four vertices are left out."""
    keep = rings.where((F.size("ring") >= 4) & geo.is_closed(F.col("ring")))
    pairs = F.arrays_zip(F.slice("ring", F.lit(1), F.size("ring") - 1).alias("a"), F.slice("ring", F.lit(2), F.size("ring") - 1).alias("b"))
    other = [c for c in rings.columns if c != "ring"]
    return keep.select(*other, F.explode(pairs).alias("e")).select(*other, F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def boxes(edges: DataFrame, shape: str) -> DataFrame:
    return edges.groupBy(shape).agg(F.min(F.least("x1", "x2")).alias("west"), F.min(F.least("y1", "y2")).alias("south"), F.max(F.greatest("x1", "x2")).alias("east"), F.max(F.greatest("y1", "y2")).alias("north"))


def _scale(level) -> Column:
    """Cells to a degree, of a level that may be a column."""
    return F.lit(2.0**level) if isinstance(level, int) else F.pow(F.lit(2.0), level)


def passed(edges: DataFrame, level, *keys: str) -> DataFrame:
    """(*keys, cell, x1, y1, x2, y2): every cell that an edge passes; borders count for both sides."""
    s, slack = _scale(level), 1e-9
    key = lambda v, o, d: F.floor((v + o) * s + d).cast("long")
    west, east = F.least("x1", "x2"), F.greatest("x1", "x2")
    rows = edges.select(*keys, *XY, F.explode(F.sequence(key(west, 180, -slack), key(east, 180, slack))).alias("ix"))
    slope = (F.col("y2") - F.col("y1")) / F.when(F.col("x2") != F.col("x1"), F.col("x2") - F.col("x1"))
    y_at = lambda x: F.col("y1") + slope * (F.least(F.greatest(x, west), east) - F.col("x1"))
    a, b = y_at(F.col("ix") / s - 180), y_at((F.col("ix") + 1) / s - 180)
    low, high = F.coalesce(F.least(a, b), F.least("y1", "y2")), F.coalesce(F.greatest(a, b), F.greatest("y1", "y2"))
    cells = rows.select(*keys, *XY, "ix", F.explode(F.sequence(key(low, 90, -slack), key(high, 90, slack))).alias("iy"))
    return cells.select(*keys, grid.pack(F.col("ix"), F.col("iy")).alias("cell"), *XY)


def reference(cell: Column, level: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a cell's reference point."""
    side = F.pow(F.lit(2.0), -level)
    return (grid.ix_of(cell) + AT[0]) * side - 180, (grid.iy_of(cell) + AT[1]) * side - 90


def parted(lon: Column, lat: Column, cx: Column, cy: Column, edges: Column) -> Column:
    """How many of a cell's edges lie between a point and the cell's reference point.

    The way goes east or west first, then north or south.
    """

    def more(n: Column, e: Column) -> Column:
        x1, y1, x2, y2 = (e[c] for c in XY)
        level, upright = (y1 > lat) != (y2 > lat), (x1 > cx) != (x2 > cx)
        x_at = (x2 - x1) * (lat - y1) / F.when(level, y2 - y1) + x1
        y_at = (y2 - y1) * (cx - x1) / F.when(upright, x2 - x1) + y1
        across = lambda v, a, b: ((v > F.least(a, b)) & (v <= F.greatest(a, b))).cast("int")
        return n + F.when(level, across(x_at, lon, cx)).otherwise(0) + F.when(upright, across(y_at, lat, cy)).otherwise(0)

    return F.aggregate(edges, F.lit(0), more)


def _sized(edges: DataFrame, shape: str) -> DataFrame:
    """Edges with the level of cells that suits their shape's width and number of edges."""
    own = Window.partitionBy(shape)
    wide = F.max(F.greatest("x1", "x2")).over(own) - F.min(F.least("x1", "x2")).over(own)
    high = F.max(F.greatest("y1", "y2")).over(own) - F.min(F.least("y1", "y2")).over(own)
    level = F.ceil(F.log2(F.sqrt(F.count("*").over(own)) * ACROSS / F.greatest(wide, high, F.lit(1e-9)))).cast("int")
    return edges.select(shape, *XY, F.least(F.greatest(level, F.lit(COARSEST)), F.lit(FINEST)).alias("_level"))


def containing(points: DataFrame, edges: DataFrame, shape: str = "shape", level: int | None = None) -> DataFrame:
    """(id, shape): every point with the shapes that hold it. points: id, lon, lat. All cells may be given one level."""
    sized = _sized(edges, shape) if level is None else edges.select(shape, *XY, F.lit(level).alias("_level"))
    near = passed(sized, F.col("_level"), shape, "_level").select(shape, "_level", "cell", F.struct(*XY).alias("e"), F.lit(False).alias("inside"))
    fill = _filled(sized, [shape, "_level"], F.col("_level"), AT).select(shape, "_level", "cell", F.lit(None).cast(near.schema["e"].dataType).alias("e"), F.lit(True).alias("inside"))
    cells = near.unionByName(fill).groupBy(shape, "_level", "cell").agg(F.collect_list("e").alias("es"), F.max("inside").alias("inside"))
    levels = F.broadcast(sized.select("_level").distinct())
    s = _scale(F.col("_level"))
    at = grid.pack(F.floor((F.col("lon") + 180) * s), F.floor((F.col("lat") + 90) * s))
    placed = points.select("id", "lon", "lat").crossJoin(levels).select("id", "lon", "lat", "_level", at.alias("cell"))
    met = placed.join(cells.hint("merge"), ["_level", "cell"])
    n = F.when(F.size("es") > 0, parted(F.col("lon"), F.col("lat"), *reference(F.col("cell"), F.col("_level")), F.col("es"))).otherwise(0)
    return met.where((n + F.col("inside").cast("int")) % 2 == 1).select("id", shape)


def polyfill(edges: DataFrame, level: int, shape: str = "shape") -> DataFrame:
    """(shape, cell): the cells whose centre a shape holds."""
    return _filled(edges, [shape], level, (0.5, 0.5))


def _filled(edges: DataFrame, keys: list[str], level, at: tuple[float, float]) -> DataFrame:
    """(*keys, cell): the cells in which a shape holds the point at those parts of its sides."""
    scale = _scale(level)
    row = F.explode(F.sequence(*[F.floor((f("y1", "y2") + 90) * scale).cast("long") for f in (F.least, F.greatest)])).alias("iy")
    lines = edges.where("y1 <> y2").select(*keys, *XY, row).withColumn("lat", (F.col("iy") + at[1]) / scale - 90)
    hit = lines.where((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat")))
    x = (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    lines = hit.withColumn("x", x).groupBy(*keys, "iy").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pairs = F.explode(F.transform(F.sequence(F.lit(1), F.size("xs") - 1, F.lit(2)), lambda i: F.struct(F.element_at("xs", i).alias("a"), F.element_at("xs", i + 1).alias("b")))).alias("span")
    spans = lines.where(F.size("xs") > 1).select(*keys, "iy", pairs)
    ix = F.explode(F.sequence(F.floor((F.col("span.a") + 180) * scale).cast("long"), F.floor((F.col("span.b") + 180) * scale).cast("long"))).alias("ix")
    cells = spans.select(*keys, "iy", "span", ix)
    lon = (F.col("ix") + at[0]) / scale - 180
    return cells.where((lon >= F.col("span.a")) & (lon < F.col("span.b"))).select(*keys, grid.pack(F.col("ix"), F.col("iy")).alias("cell"))


def footprint(contours: DataFrame, level: int, floor: float = 5.0) -> DataFrame:
    """Intensity of each cell: the highest contour at or above the floor whose fill holds the cell's centre."""
    values = contours.where(F.col("value") >= floor)
    filled = polyfill(values, level, "value")
    return filled.groupBy("cell").agg(F.max("value").alias("mmi"))


def nearest_within(points: DataFrame, edges: DataFrame, bound: float, shape: str = "shape", cut=None) -> DataFrame:
    """(id, shape, d2): each point's nearest shape by its edges, if within bound degrees; ties to the smaller name.

    Points and edges meet in cells. Where points are dense, cells as wide as the whole bound hold many edges, of which
    the nearest is close: so a point looks within a part of the bound first, a third of what points are apart, and only
    those that found nothing look eight times as far. cut writes what points found, which both later steps read.
    """
    n, west, east, south, north = points.agg(F.count("*"), F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat")).head()
    area = (east - west) * (north - south) if n and west is not None and south is not None else 0.0
    halves = max(0, min(8, round(log2(bound * 3 * sqrt(n / area))))) if area > 0 else 0
    done, left = None, points.select("id", "lon", "lat")
    while True:
        found = _nearest(left, edges, bound / 2**halves, shape)
        if halves == 0:
            best = found if done is None else done.unionByName(found)
            return best.select("id", shape, F.round("d2", 9).alias("d2"))
        found = cut(found) if cut else found
        done = found if done is None else done.unionByName(found)
        left = left.join(found.select("id").hint("merge"), "id", "left_anti")
        halves = max(0, halves - 3)


def _nearest(points: DataFrame, edges: DataFrame, bound: float, shape: str) -> DataFrame:
    """nearest_within() in one step, not rounded. A point looks into its cell and the eight around.

    Cells are as wide as the bound. An edge walks its columns, in each over the rows that it has there, so it is in about
    a cell and a half for each step of its length. The join is by sorting: an exploded side is larger than Spark expects.
    """
    key = lambda c: F.floor(c / bound).cast("long")
    west, east = F.least("x1", "x2"), F.greatest("x1", "x2")
    walked = edges.select(shape, *XY, F.explode(F.sequence(key(west), key(east))).alias("_kx"))
    slope = (F.col("y2") - F.col("y1")) / F.when(F.col("x2") != F.col("x1"), F.col("x2") - F.col("x1"))
    y_at = lambda x: F.col("y1") + slope * (x - F.col("x1"))
    slack = bound * 1e-9
    a, b = y_at(F.greatest(F.col("_kx") * bound, west)), y_at(F.least((F.col("_kx") + 1) * bound, east))
    low = F.greatest(F.coalesce(F.least(a, b), F.least("y1", "y2")), F.least("y1", "y2"))
    high = F.least(F.coalesce(F.greatest(a, b), F.greatest("y1", "y2")), F.greatest("y1", "y2"))
    near = walked.select(shape, *XY, "_kx", F.explode(F.sequence(key(low - slack), key(high + slack))).alias("_ky"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    p = points.select("id", "lon", "lat", around).select("id", "lon", "lat", (key(F.col("lon")) + F.col("o.i")).alias("_kx"), (key(F.col("lat")) + F.col("o.j")).alias("_ky"))
    d2 = geo.point_segment_km2(F.col("lon"), F.col("lat"), *[F.col(c) for c in XY])
    tried = p.join(near.hint("merge"), ["_kx", "_ky"]).select("id", shape, d2.alias("d2")).where(F.col("d2") <= bound * bound)
    best = tried.groupBy("id").agg(F.min(F.struct(F.col("d2"), F.col(shape))).alias("b"))
    return best.select("id", F.col(f"b.{shape}").alias(shape), F.col("b.d2").alias("d2"))


def rescue(candidates: DataFrame, own: DataFrame, neighbours: DataFrame, bound: float, shape: str = "shape", cut=None) -> DataFrame:
    """Cells that no municipality holds: near the country, not in a neighbour, to the nearest municipality.

    candidates: id, lon, lat. Without neighbours nothing is taken away. The order of the steps is part of the meaning.
    """
    near = nearest_within(candidates, own, bound, shape, cut)
    abroad = containing(candidates, neighbours, shape).select("id").distinct()
    return near.join(abroad, "id", "left_anti")


def signed_areas(edges: DataFrame, shape: str = "shape") -> DataFrame:
    """Planar area and centroid of each shape, by sums over its edges."""
    s = geo.shoelace(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    sums = edges.groupBy(shape).agg(F.sum(s).alias("s"), F.sum(s * (F.col("x1") + F.col("x2"))).alias("sx"), F.sum(s * (F.col("y1") + F.col("y2"))).alias("sy"))
    safe = F.when(F.col("s") != 0, F.col("s"))
    return sums.select(shape, F.round(F.abs(F.col("s")) / 2, 6).alias("area"), F.round(F.col("sx") / (safe * 3), 6).alias("lon"), F.round(F.col("sy") / (safe * 3), 6).alias("lat"))


def outline_km(edges: DataFrame, shape: str = "shape", flipped: bool = False) -> DataFrame:
    """(shape, km): length of each shape's edges on the ellipsoid; flipped says that x is the latitude.

    Edges should be short (a few degrees): each is measured by the radii of curvature at its middle.
    """
    part = geo.ellipsoid_km(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], flipped=flipped)
    return edges.groupBy(shape).agg(F.round(F.sum(part), 6).alias("km"))


def within_shape(edges: DataFrame, shape: str = "shape") -> DataFrame:
    """Pairs of a shape and another whose every vertex it holds (containment of simple shapes).

    Only shapes that hold one vertex, and whose box holds the shape's box, meet the other vertices.
    """
    corners = edges.select(F.col(shape).alias("inner"), F.col("x1").alias("x"), F.col("y1").alias("y")).distinct()
    box = boxes(edges, shape)
    mine = corners.groupBy("inner").agg(F.min(F.struct("x", "y")).alias("p"), F.min("x").alias("west"), F.min("y").alias("south"), F.max("x").alias("east"), F.max("y").alias("north"))
    one = mine.select(F.struct("inner", "west", "south", "east", "north").alias("id"), F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
    theirs = box.select(shape, F.struct("west", "south", "east", "north").alias("_box"))
    outer = edges.join(theirs.hint("merge"), shape).select(F.struct(F.col(shape).alias("of"), "_box").alias("_shape"), *XY)
    i, o = F.col("id"), F.col("_shape._box")
    fits = (i["west"] >= o["west"]) & (i["east"] <= o["east"]) & (i["south"] >= o["south"]) & (i["north"] <= o["north"])
    some = containing(one, outer, "_shape").where(fits & (i["inner"] != F.col("_shape.of"))).select(i["inner"].alias("inner"), F.col("_shape.of").alias("outer"))
    # a vertex's ray meets the outer shape's edges: pairs times vertices times edges, all of one pair in one sum
    points = corners.groupBy("inner").agg(F.collect_list(F.struct("x", "y")).alias("ps"))
    sides = edges.groupBy(F.col(shape).alias("outer")).agg(F.collect_list(F.struct(*XY)).alias("es"))
    both = some.join(points.hint("merge"), "inner").join(sides.hint("merge"), "outer")
    crossed = lambda p: F.aggregate("es", F.lit(0), lambda n, e: n + F.when(geo.crosses(p["x"], p["y"], *[e[c] for c in XY]), 1).otherwise(0))
    return both.where(F.forall("ps", lambda p: crossed(p) % 2 == 1)).select("inner", "outer")
