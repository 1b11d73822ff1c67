"""Planar overlay of edge tables: intersection, difference, union, buffer; and line simplification.

Edges of a group (a pair of shapes, or a shape) are split where they cross, and every piece keeps or leaves the result by
the winding numbers left and right of it, of two layers `a` and `b`. Edges meet only within latitude rows of their group,
so rows made are edges times the rows they span times those beside them there, not all pairs. Pieces that coincide are
one piece whose weights add up, so shared borders need no case of their own.

Winding numbers count edges east of a piece's middle. This is done in sheared coordinates (y + SHEAR * x), in which no
edge of real data is level. A crossing within END of an edge's end is that end.

Where areas are wanted and not outlines, pairs split no edges (`pair_areas`). What lies west of an edge is a strip, and a
fill is the sum of its edges' strips, counted by whether they go up or down. So what two fills share is a sum over pairs
of their edges, of the integral of how far these are apart where they pass the same latitudes. Shapes meet in tiles of
a grid cell, and all that is made of a pair is its row of the result.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat
from math import ceil, cos, log2, pi, pow, sin, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lahar.functions import geo, grid
from lahar.operators.polygons import boxes

XY = ["x1", "y1", "x2", "y2"]
SHEAR = 0.7390851332151607
END = 1e-10
#: A shape of more edges than this is dealt in several parts, each of edges close in latitude.
PART = 256
#: Parts of one layer in a tile, about.
TILE = 1024
#: Tiles are dealt to so many tasks at most.
MOST = 4000
#: Pairs of edges looked at in one step, so that it stays in a core's cache.
STEP = 1 << 15
BOX = ["west", "south", "east", "north"]


def _row_level(edges: DataFrame) -> float:
    """log2 of the rows a unit of latitude is cut into: an edge of mean height spans two."""
    mean = edges.agg(F.avg(F.abs(F.col("y2") - F.col("y1")))).head()[0] or 1.0
    return -log2(mean)


def _rows(low: Column, high: Column, level: float) -> Column:
    s = F.lit(2.0**level)
    return F.explode(F.sequence(F.floor(low * s).cast("long"), F.floor(high * s).cast("long")))


def _upward(edges: DataFrame) -> DataFrame:
    """Edges from their lower sheared end to the higher one; equal ones become one, their weights added up."""
    s = lambda i: F.col(f"y{i}") + SHEAR * F.col(f"x{i}")
    up = (s(1) < s(2)) | ((s(1) == s(2)) & (F.col("x1") < F.col("x2")))
    turned = [F.when(up, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in zip(XY, ["x2", "y2", "x1", "y1"], strict=True)]
    weight = [F.when(up, F.col(w)).otherwise(-F.col(w)).alias(w) for w in ("wa", "wb")]
    others = [c for c in edges.columns if c not in (*XY, "wa", "wb")]
    real = (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))
    return edges.where(real).select(*others, *turned, *weight)


def _splits(edges: DataFrame, level: float) -> DataFrame:
    """(g, e, t, x, y): where edges are cut by others of their group, t being how far along."""
    low = F.least("y1", "y2")
    row = _rows(low, F.greatest("y1", "y2"), level).alias("row")
    banded = edges.select("g", "e", *XY, row)
    other = banded.select("g", "row", *[F.col(c).alias(f"o_{c}") for c in ("e", *XY)])
    c = {n: F.col(n) for n in (*XY, *[f"o_{x}" for x in XY])}
    beside = (F.least("x1", "x2") <= F.greatest("o_x1", "o_x2")) & (F.least("o_x1", "o_x2") <= F.greatest("x1", "x2"))
    beside &= (F.least("y1", "y2") <= F.greatest("o_y1", "o_y2")) & (F.least("o_y1", "o_y2") <= F.greatest("y1", "y2"))
    # two edges meet in the first row that both span, so no pair is seen twice and none is shuffled
    first = F.floor(F.greatest(low, F.least("o_y1", "o_y2")) * F.lit(2.0**level)).cast("long")
    met = banded.join(other, ["g", "row"]).where((F.col("e") < F.col("o_e")) & (F.col("row") == first) & beside)
    dx, dy, ox, oy = c["x2"] - c["x1"], c["y2"] - c["y1"], c["o_x2"] - c["o_x1"], c["o_y2"] - c["o_y1"]
    px, py = c["o_x1"] - c["x1"], c["o_y1"] - c["y1"]
    met = met.select("g", "e", "o_e", *c, dx.alias("dx"), dy.alias("dy"), ox.alias("ox"), oy.alias("oy"), px.alias("px"), py.alias("py"))
    dx, dy, ox, oy, px, py = (F.col(n) for n in ("dx", "dy", "ox", "oy", "px", "py"))
    det, one, two = dx * oy - dy * ox, dx * dx + dy * dy, ox * ox + oy * oy
    level_ = F.abs(det) <= 1e-12 * F.sqrt(one * two)
    safe = F.when(~level_, det)
    met = met.withColumns({"t": (px * oy - py * ox) / safe, "u": (px * dy - py * dx) / safe, "on": level_ & (F.abs(px * dy - py * dx) <= 1e-12 * (one + F.sqrt(one * (px * px + py * py))))})
    t, u = F.col("t"), F.col("u")
    inside = lambda x: (x > END) & (x < 1 - END)
    within = lambda x: (x >= -END) & (x <= 1 + END)
    own_end = F.when(t <= END, F.struct(c["x1"].alias("x"), c["y1"].alias("y"))).when(t >= 1 - END, F.struct(c["x2"].alias("x"), c["y2"].alias("y")))
    far_end = F.when(u <= END, F.struct(c["o_x1"].alias("x"), c["o_y1"].alias("y"))).when(u >= 1 - END, F.struct(c["o_x2"].alias("x"), c["o_y2"].alias("y")))
    at = F.coalesce(own_end, far_end, F.struct((c["x1"] + t * dx).alias("x"), (c["y1"] + t * dy).alias("y")))
    cut = lambda e, s, p: F.struct(F.col(e).alias("e"), s.alias("t"), p["x"].alias("x"), p["y"].alias("y"))
    found = [F.when(within(u) & inside(t), cut("e", t, at)), F.when(within(t) & inside(u), cut("o_e", u, at))]
    for e, (x, y), (vx, vy), length, ends in (("e", ("x1", "y1"), (dx, dy), one, "o_"), ("o_e", ("o_x1", "o_y1"), (ox, oy), two, "")):
        for i in (1, 2):
            p = F.struct(c[f"{ends}x{i}"].alias("x"), c[f"{ends}y{i}"].alias("y"))
            s = ((p["x"] - c[x]) * vx + (p["y"] - c[y]) * vy) / length
            found.append(F.when(F.col("on") & inside(s), cut(e, s, p)))
    return met.select("g", F.explode(F.filter(F.array(*found), lambda s: s.isNotNull())).alias("s")).select("g", "s.*")


def arranged(edges: DataFrame, level: float | None = None) -> DataFrame:
    """(g, x1, y1, x2, y2, la, lb, ra, rb): pieces of all edges, and the winding numbers of both layers left and right.

    edges: g, x1, y1, x2, y2, and the weights wa and wb with which an edge counts in each layer.
    """
    level = _row_level(edges) if level is None else level
    # edges are dealt once, by (g, e), and pieces once, by (g, row): all that is grouped or joined below is in place then
    dealt = _upward(edges).withColumn("e", F.xxhash64(*XY)).repartition("g", "e")
    whole = dealt.groupBy("g", "e", *XY).agg(F.sum("wa").alias("wa"), F.sum("wb").alias("wb"))
    cuts = _splits(whole, level).groupBy("g", "e").agg(F.array_sort(F.collect_set(F.struct("t", "x", "y"))).alias("cuts"))
    point = lambda i: F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y"))
    between = F.transform(F.coalesce("cuts", F.array().cast("array<struct<t:double,x:double,y:double>>")), lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))
    lines = whole.join(cuts, ["g", "e"], "left").select("g", "e", "wa", "wb", F.concat(F.array(point(1)), between, F.array(point(2))).alias("p"))
    ends = F.arrays_zip(F.slice("p", F.lit(1), F.size("p") - 1).alias("a"), F.slice("p", F.lit(2), F.size("p") - 1).alias("b"))
    pieces = lines.select("g", "e", "wa", "wb", F.explode(ends).alias("s")).select("g", "e", "wa", "wb", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))
    mx, my = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    ms = my + SHEAR * mx
    pieces = _upward(pieces).withColumn("row", F.floor(ms * F.lit(2.0**level)).cast("long")).repartition("g", "row")
    pieces = pieces.groupBy("g", "row", *XY).agg(F.sum("wa").alias("wa"), F.sum("wb").alias("wb"), F.collect_set("e").alias("own"))
    tried = pieces.where("wa <> 0 OR wb <> 0").withColumns({"mx": mx, "ms": ms})
    low, high = F.col("y1") + SHEAR * F.col("x1"), F.col("y2") + SHEAR * F.col("x2")
    rows = whole.select("g", "e", F.col("x1").alias("ex"), low.alias("low"), high.alias("high"), ((F.col("x2") - F.col("x1")) / F.when(high != low, high - low)).alias("slope"), F.col("wa").alias("ea"), F.col("wb").alias("eb"), _rows(low, high, level).alias("row"))
    east = (F.col("low") <= F.col("ms")) & (F.col("high") > F.col("ms")) & (F.col("ex") + (F.col("ms") - F.col("low")) * F.col("slope") > F.col("mx"))
    seen = tried.join(rows, ["g", "row"], "left")
    counts = lambda w: F.coalesce(F.sum(F.when(east & ~F.array_contains("own", F.col("e")), F.col(w))), F.lit(0))
    right = seen.groupBy("g", "row", *XY, "wa", "wb").agg(counts("ea").alias("ra"), counts("eb").alias("rb"))
    return right.select("g", *XY, (F.col("ra") + F.col("wa")).alias("la"), (F.col("rb") + F.col("wb")).alias("lb"), "ra", "rb")


def combined(edges: DataFrame, inside: Callable[[Column, Column], Column], level: float | None = None) -> DataFrame:
    """(g, x1, y1, x2, y2): the outline of where inside(winding of a, winding of b) holds, which lies on its left."""
    found = arranged(edges, level).withColumns({"l": inside(F.col("la"), F.col("lb")), "r": inside(F.col("ra"), F.col("rb"))}).where("l <> r")
    return found.select("g", *[F.when(F.col("l"), F.col(c)).otherwise(F.col(o)).alias(c) for c, o in zip(XY, ["x2", "y2", "x1", "y1"], strict=True)])


def _odd(w: Column) -> Column:
    return w % 2 != 0


#: What a piece must lie in, by even-odd fill of both layers.
FILLS: dict[str, Callable[[Column, Column], Column]] = {
    "intersection": lambda a, b: _odd(a) & _odd(b),
    "difference": lambda a, b: _odd(a) & ~_odd(b),
    "union": lambda a, b: _odd(a) | _odd(b),
    "symmetric": lambda a, b: _odd(a) != _odd(b),
}


def meeting(a: DataFrame, b: DataFrame, shape: str = "shape", level: int = -2) -> DataFrame:
    """(a, b): shapes of two tables whose boxes touch; they meet in grid cells that both boxes touch."""
    side = lambda e, n: boxes(e, shape).select(F.col(shape).alias(n), *[F.col(c).alias(f"{n}_{c}") for c in ("west", "south", "east", "north")])
    cells = lambda df, n: df.withColumn("cell", F.explode(grid.cells_in_box(*[F.col(f"{n}_{c}") for c in ("west", "south", "east", "north")], level)))
    both = cells(side(a, "a"), "a").join(cells(side(b, "b"), "b"), "cell")
    touch = (F.col("a_west") <= F.col("b_east")) & (F.col("b_west") <= F.col("a_east")) & (F.col("a_south") <= F.col("b_north")) & (F.col("b_south") <= F.col("a_north"))
    return both.where(touch).select("a", "b").distinct()


def overlay(a: DataFrame, b: DataFrame, fill: str, shape: str = "shape", level: float | None = None, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(a, b, x1, y1, x2, y2): the outline of a fill (see FILLS) for each pair of shapes whose boxes touch."""
    pairs = meeting(a, b, shape)
    one = pairs.join(a.select(F.col(shape).alias("a"), *XY), "a").select(F.struct("a", "b").alias("g"), *XY, F.lit(1).alias("wa"), F.lit(0).alias("wb"))
    two = pairs.join(b.select(F.col(shape).alias("b"), *XY), "b").select(F.struct("a", "b").alias("g"), *XY, F.lit(0).alias("wa"), F.lit(1).alias("wb"))
    both = one.unionByName(two)
    return combined(cut(both) if cut else both, FILLS[fill], level).select("g.*", *XY)


def areas(edges: DataFrame, *keys: str) -> DataFrame:
    """Area inside outlines whose inside lies on their left."""
    part = geo.shoelace(*[F.col(c) for c in XY])
    return edges.groupBy(*keys).agg(F.round(F.sum(part) / 2, 6).alias("area"))


def outlined(edges: DataFrame, shape: str = "shape", level: float | None = None) -> DataFrame:
    """(shape, x1, y1, x2, y2): the outline of each shape's even-odd fill, which lies on its left."""
    own = edges.select(F.col(shape).alias("g"), *XY, F.lit(1).alias("wa"), F.lit(0).alias("wb"))
    return combined(own, lambda a, _: _odd(a), level).select(F.col("g").alias(shape), *XY)


def _parts(edges: DataFrame, shape: str, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(shape, part, parts, own, west, south, east, north, edges): outlines in parts, with the box and area of the shape."""
    lines, sloped = cut(outlined(edges, shape)), F.col("y1") != F.col("y2")  # level edges have no part in strips
    whole = lines.groupBy(shape).agg((F.sum(geo.shoelace(*[F.col(c) for c in XY])) / 2).alias("own"), F.ceil(F.count_if(sloped) / PART).cast("int").alias("parts"))
    place = F.row_number().over(Window.partitionBy(shape).orderBy(F.col("y1") + F.col("y2"), *XY))
    dealt = lines.where(sloped).withColumn("part", F.floor((place - 1) / PART).cast("int")).groupBy(shape, "part").agg(F.array_sort(F.collect_list(F.array(*XY))).alias("edges"))
    # shapes without an inside have a box too, and pairs
    every = boxes(edges, shape).join(dealt.join(whole, shape), shape, "left")
    return every.withColumns({"part": F.coalesce("part", F.lit(0)), "parts": F.coalesce("parts", F.lit(1)), "own": F.coalesce("own", F.lit(0.0)), "edges": F.coalesce("edges", F.array().cast("array<array<double>>"))})


def _box_level(*parts: DataFrame) -> int:
    """The level whose cells are as large as boxes are: in all, shapes touch at most four cells each, whatever their sizes."""
    w, h = F.col("east") - F.col("west"), F.col("north") - F.col("south")
    sizes = [p.where("part = 0").select(w.alias("w"), h.alias("h")) for p in parts]
    mean = sizes[0].union(sizes[1]).agg(F.avg("w"), F.avg("h"), F.avg(F.col("w") * F.col("h"))).head()
    side = max(mean[0] or 0.0, mean[1] or 0.0, sqrt(mean[2] or 0.0))
    return -ceil(log2(side)) if side else 0


def _padded(edges: pa.Array, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """x, y, upper y, slope and direction of the edges of some parts, which go up; filled up with edges without height."""
    lists = edges.take(pa.array(of))
    size = np.diff(lists.offsets.to_numpy())
    width = 1 << int(max(size.max(initial=1) - 1, 0)).bit_length()
    out = np.zeros((len(of), width, 4))
    out[np.arange(width) < size[:, None]] = lists.flatten().flatten().to_numpy().reshape(-1, 4)
    up = out[..., 3] >= out[..., 1]
    x, y, tx, ty = (np.where(up, out[..., i], out[..., i - 2 if i > 1 else i + 2]) for i in range(4))
    slope = np.divide(tx - x, ty - y, out=np.zeros_like(x), where=ty > y)
    return x, y, ty, slope, np.where(up, 1.0, -1.0)


def shared_areas(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """What fill i of a and fill j of b share, for each pair of parts: minus half of how far edges are apart, summed up."""
    out = np.zeros(len(i))
    step = max(1, STEP // (a[0].shape[1] * b[0].shape[1]))
    for k in range(0, len(i), step):
        ax, ay, at, am, au = (v[i[k : k + step], :, None] for v in a)
        bx, by, bt, bm, bu = (v[j[k : k + step], None, :] for v in b)
        low = np.maximum(ay, by)
        high = np.maximum(np.minimum(at, bt) - low, 0)
        one = ax - bx + (low - ay) * am - (low - by) * bm
        two = one + high * (am - bm)
        apart = np.abs(one) + np.abs(two)
        square = one * one + two * two + np.maximum(2 * one * two, 0)
        across = np.divide(high * square, apart, out=np.zeros_like(square), where=(high > 0) & (apart > 0))
        out[k : k + step] = -(across * (au * bu)).sum((1, 2)) / 4
    return out


def _met(a: pa.Table, b: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a and of b whose boxes touch, the corner of what they share being in this cell; and what their fills share."""
    box = lambda t, n: [t.column(f"{n}_{c}").to_numpy() for c in BOX]
    (aw, as_, ae, an), (bw, bs, be, bn) = box(a, "a"), box(b, "b")
    cell, s = a.column("cell")[0].as_py(), 2.0**level
    found = [], []
    for k in range(len(aw)):
        j = np.flatnonzero((aw[k] <= be) & (bw <= ae[k]) & (as_[k] <= bn) & (bs <= an[k]))
        x, y = np.maximum(aw[k], bw[j]), np.maximum(as_[k], bs[j])
        j = j[np.floor((x + 180) * s).astype(np.int64) * grid.SHIFT + np.floor((y + 90) * s).astype(np.int64) == cell]
        found[0].append(np.full(len(j), k))
        found[1].append(j)
    i, j = (np.concatenate(f) for f in found)
    share = np.zeros(len(i))
    ea, eb = (t.column(f"{n}_edges").combine_chunks() for t, n in ((a, "a"), (b, "b")))
    wide = lambda e: np.ceil(np.log2(np.maximum(np.diff(e.offsets.to_numpy()), 1))).astype(int)
    wa, wb = wide(ea), wide(eb)
    for p in np.unique(wa):
        ia = np.flatnonzero(wa == p)
        left, at_a = _padded(ea, ia), np.searchsorted(ia, i)
        for q in np.unique(wb):
            ib = np.flatnonzero(wb == q)
            here = np.flatnonzero((wa[i] == p) & (wb[j] == q))
            share[here] = shared_areas(left, _padded(eb, ib), at_a[here], np.searchsorted(ib, j[here]))
    return i, j, share


#: The area of a fill, of what both shapes share, a's own and b's own.
AREAS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "intersection": lambda both, a, b: both,
    "difference": lambda both, a, b: a - both,
    "union": lambda both, a, b: a + b - both,
    "symmetric": lambda both, a, b: a + b - 2 * both,
}


def _shared(a: DataFrame, b: DataFrame, cut: Callable[[DataFrame], DataFrame], shape: str = "shape", tile: int = TILE) -> DataFrame:
    """(a, b, a_own, b_own, both): what each pair of shapes whose boxes touch shares, and their own areas."""
    sides = {"a": cut(_parts(a, shape, cut)), "b": cut(_parts(b, shape, cut))}
    level = _box_level(*sides.values())
    cells = {n: df.select(*[F.col(c).alias(f"{n}_{c}") for c in (shape, "part", "parts", "own", *BOX, "edges")], F.explode(grid.cells_in_box(*[F.col(c) for c in BOX], level)).alias("cell")) for n, df in sides.items()}
    blocks = {n: df.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias(f"{n}_blocks")) for n, df in cells.items()}
    both = blocks["a"].join(blocks["b"], "cell")
    block = lambda n: F.pmod(F.xxhash64(f"{n}_{shape}", f"{n}_part"), F.col(f"{n}_blocks")).cast("int").alias(f"{n}_block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(f"{n}_blocks") - 1)).alias(f"{n}_block")
    dealt = {n: df.join(both, "cell").select("cell", block(n), every(o), *[c for c in df.columns if c != "cell"]) for (n, df), o in zip(cells.items(), "ba", strict=True)}
    names = [f"{n}_{c}" for n in "ab" for c in (shape, "own", "parts")]
    schema = ", ".join(f"`{c}` {dealt[c[0]].schema[c].dataType.simpleString()}" for c in names) + ", both double"

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        i, j, both = _met(left, right, level) if left.num_rows and right.num_rows else (np.empty(0, int), np.empty(0, int), np.empty(0))
        columns = [(left.column(c).take(pa.array(i)) if c[0] == "a" else right.column(c).take(pa.array(j))) for c in names]
        return pa.Table.from_arrays([*columns, pa.array(both)], [*names, "both"])

    # what a tile makes is far more than what it reads, so tiles are dealt by their number and not by bytes
    key, tiles = ["cell", "a_block", "b_block"], both.agg(F.sum(F.col("a_blocks") * F.col("b_blocks"))).head()[0] or 1
    left, right = (dealt[n].repartition(min(tiles, MOST), *key).groupBy(*key) for n in "ab")
    found = left.cogroup(right).applyInArrow(meet, schema)
    if any(not df.where("parts > 1").isEmpty() for df in sides.values()):
        found = found.groupBy(f"a_{shape}", f"b_{shape}").agg(F.first("a_own").alias("a_own"), F.first("b_own").alias("b_own"), F.sum("both").alias("both"))
    return found.select(F.col(f"a_{shape}").alias("a"), F.col(f"b_{shape}").alias("b"), "a_own", "b_own", "both")


def filled(shared: DataFrame, fill: str) -> DataFrame:
    return shared.select("a", "b", AREAS[fill](F.col("both"), F.col("a_own"), F.col("b_own")).alias("area"))


def pair_areas(a: DataFrame, b: DataFrame, fill: str, cut: Callable[[DataFrame], DataFrame], shape: str = "shape") -> DataFrame:
    """(a, b, area): the area of a fill for each pair of shapes whose boxes touch."""
    return filled(_shared(a, b, cut, shape), fill)


def buffered(edges: DataFrame, radius: float, corners: int = 8, shape: str = "shape", level: float | None = None) -> DataFrame:
    """(shape, x1, y1, x2, y2): shapes grown by a regular polygon of that many corners with that outer radius.

    A shape grows by what the polygon sweeps along its edges: the polygon at each vertex, and for each edge the
    quadrilateral between its corners farthest to both sides. What any of them winds around belongs to the result.
    """
    disc = [(radius * cos(2 * pi * k / corners), radius * sin(2 * pi * k / corners)) for k in range(corners)]
    vertex = F.explode(F.array(*[F.struct(F.lit(p[0]).alias("ax"), F.lit(p[1]).alias("ay"), F.lit(q[0]).alias("bx"), F.lit(q[1]).alias("by")) for p, q in zip(disc, disc[1:] + disc[:1], strict=True)]))
    e = edges.select(F.col(shape).alias("g"), *XY)
    around = e.select("g", F.col("x1").alias("x"), F.col("y1").alias("y")).union(e.select("g", F.col("x2"), F.col("y2"))).distinct().withColumn("d", vertex)
    discs = around.select("g", (F.col("x") + F.col("d.ax")).alias("x1"), (F.col("y") + F.col("d.ay")).alias("y1"), (F.col("x") + F.col("d.bx")).alias("x2"), (F.col("y") + F.col("d.by")).alias("y2"), F.lit(1).alias("wa"), F.lit(0).alias("wb"))
    side = lambda x, y: F.col("dy") * x - F.col("dx") * y
    corner = F.array(*[F.struct(side(F.lit(x), F.lit(y)).alias("s"), F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in disc])
    swept = e.withColumns({"dx": F.col("x2") - F.col("x1"), "dy": F.col("y2") - F.col("y1")}).withColumns({"r": F.array_max(corner), "l": F.array_min(corner)})
    at = lambda i, k: (F.col(f"x{i}") + F.col(f"{k}.x"), F.col(f"y{i}") + F.col(f"{k}.y"))
    ring = [at(1, "r"), at(2, "r"), at(2, "l"), at(1, "l")]
    sides = F.array(*[F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")) for p, q in zip(ring, ring[1:] + ring[:1], strict=True)])
    bands = swept.select("g", F.explode(sides).alias("s")).select("g", "s.*", F.lit(1).alias("wa"), F.lit(0).alias("wb"))
    # the shape itself counts by even-odd fill in the other layer
    own = e.select("g", *XY, F.lit(0).alias("wa"), F.lit(1).alias("wb"))
    grown = combined(discs.unionByName(bands).unionByName(own), lambda a, b: (a != 0) | _odd(b), level)
    return grown.select(F.col("g").alias(shape), *XY)


@F.arrow_udf(DoubleType())
def _chord_d2(px: pa.Array, py: pa.Array, ax: pa.Array, ay: pa.Array, bx: pa.Array, by: pa.Array) -> pa.Array:
    """Squared distance of a vertex from its chord, null where a coordinate is.

    Vertices of a lattice are equally far but for the last bit, which then decides what stays. So squares are C's pow,
    as SQL engines take them: in one of about a thousand it differs from v * v, which is what Spark's pow gives.
    """
    square = lambda v: np.fromiter(map(pow, v.tolist(), repeat(2.0)), float, len(v))
    given = [c.to_numpy(zero_copy_only=False) for c in (px, py, ax, ay, bx, by)]
    x, y, x1, y1, x2, y2 = given
    dx, dy = x2 - x1, y2 - y1
    size = square(dx) + square(dy)
    t = np.divide((x - x1) * dx + (y - y1) * dy, size, out=np.zeros_like(size), where=size > 0)
    t = np.maximum(0.0, np.minimum(1.0, t))
    lacking = np.logical_or.reduce([c.is_null().to_numpy(zero_copy_only=False) for c in (px, py, ax, ay, bx, by)])
    return pa.array(square(x - (x1 + t * dx)) + square(y - (y1 + t * dy)), mask=lacking)


def kept_vertices(lines: DataFrame, tolerance: float, cut: Callable[[DataFrame], DataFrame], key: str = "shape", line: str = "ring") -> DataFrame:
    """(key, i, p): the vertices of lines, arrays of (x, y), that stay: others lie within tolerance of what is left.

    A vertex is known by its place i in its line, as a line may pass a point twice.

    Douglas-Peucker by rounds: in each, the vertex farthest from its chord stays if it is farther than the tolerance,
    and halves its stretch; stretches without one are done and take no part in later rounds. Ties go to the first
    vertex. Lines of up to two vertices stay as they are, null and empty ones are left out.
    """
    vertex = lines.where(F.size(line) > 0).select(key, F.size(line).alias("n"), F.element_at(line, 1).alias("a"), F.element_at(line, -1).alias("b"), F.posexplode(line).alias("i", "p"))
    vertex = vertex.select(key, "i", "p", F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"), "a", "b")
    kept = cut(vertex.where("i = lo OR i = hi").select(key, "i", "p"))
    open_ = cut(vertex.where("i > lo AND i < hi"))
    while not open_.isEmpty():
        d2 = _chord_d2(*[F.col(c).cast("double") for c in ("p.x", "p.y", "a.x", "a.y", "b.x", "b.y")])
        far = open_.withColumn("d2", d2).groupBy(key, "lo").agg(F.max(F.struct("d2", (-F.col("i")).alias("i"), "p")).alias("m"))
        far = cut(far.where(F.col("m.d2") > tolerance * tolerance).select(key, "lo", (-F.col("m.i")).alias("mi"), F.col("m.p").alias("mp")))
        kept = kept.unionByName(far.select(key, F.col("mi").alias("i"), F.col("mp").alias("p")))
        before = F.col("i") < F.col("mi")
        open_ = cut(
            open_.join(far, [key, "lo"]).where("i <> mi").select(
                key, "i", "p", F.when(before, F.col("lo")).otherwise(F.col("mi")).alias("lo"), F.when(before, F.col("mi")).otherwise(F.col("hi")).alias("hi"),
                F.when(before, F.col("a")).otherwise(F.col("mp")).alias("a"), F.when(before, F.col("mp")).otherwise(F.col("b")).alias("b"),
            )
        )
    return kept


def simplified(lines: DataFrame, tolerance: float, cut: Callable[[DataFrame], DataFrame], key: str = "shape", line: str = "ring") -> DataFrame:
    """(key, line): lines with the vertices that stay, see kept_vertices."""
    kept = kept_vertices(lines, tolerance, cut, key, line)
    return kept.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda s: s["p"]).alias(line))
