"""Outlines of cell sets: directed sides chained into rings by pointer jumping, holes nested in their polygon.

Each cell has four sides that go around it with the cell on their left; sides that two cells share vanish. A side is
followed by the one that starts where it ends; where two do, cells touch at a corner only, and the left turn stays with
the cell. So each polygon is one set of cells joined by sides, and has one outer ring. Pointers are doubled, so rounds
grow with the logarithm of the longest ring, and a round joins sides by keys that occur once: no ring meets in one task
until it is asked for as an array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lahar.functions import grid
from lahar.operators import fires

VERTEX = 1 << 21


def _sides(cells: DataFrame) -> DataFrame:
    """(cell, side, start, end, way): sides with a cell on their left and none on their right. Ways: east, north, west, south."""
    x, y = grid.ix_of(F.col("cell")), grid.iy_of(F.col("cell"))
    at = lambda dx, dy: (x + dx) * VERTEX + (y + dy)
    corner = [at(0, 0), at(1, 0), at(1, 1), at(0, 1)]
    four = [F.struct(corner[w].alias("start"), corner[(w + 1) % 4].alias("end"), F.lit(w).alias("way")) for w in range(4)]
    every = cells.select("cell").where("cell IS NOT NULL").distinct().select("cell", F.explode(F.array(*four)).alias("s")).select("cell", "s.*")
    line = [F.least("start", "end").alias("low"), F.greatest("start", "end").alias("high")]
    alone = every.groupBy(*line).agg(F.count("*").alias("n"), F.first(F.struct("cell", "start", "end", "way")).alias("s")).where("n = 1").select("s.*")
    return alone.withColumn("side", F.col("start") * 4 + F.col("way"))


def _chained(sides: DataFrame) -> DataFrame:
    """(side, next): the side that goes on where one ends; a left turn comes before straight on and a right turn."""
    ahead = sides.select(F.col("start").alias("end"), F.col("side").alias("next"), F.col("way").alias("next_way"))
    turn = F.struct((F.col("way") + 1 - F.col("next_way") + 4) % 4, "next")
    return sides.join(ahead, "end").groupBy("side").agg(F.min_by("next", turn).alias("next"))


def _rings(chain: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(side, ring): each side with the smallest side of its ring."""
    state = cut(chain.select("side", F.col("next").alias("to"), F.least("side", "next").alias("ring")))
    while True:
        ahead = state.select(F.col("side").alias("to"), F.col("to").alias("beyond"), F.col("ring").alias("other"))
        step = state.join(ahead, "to").select("side", F.col("beyond").alias("to"), F.col("ring").alias("old"), F.least("ring", "other").alias("ring"))
        state = cut(step)
        # if no window of sides learns a smaller one from the window behind it, windows hold the same one all around
        if state.where("old <> ring").isEmpty():
            return state.select("side", "ring")


def _placed(chain: DataFrame, rings: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(side, ring, left): how many steps each side is before its ring's first side. What has arrived rests."""
    both = chain.join(rings, "side")
    first = F.col("side") == F.col("ring")
    state = cut(both.select("side", "ring", F.when(first, F.col("side")).otherwise(F.col("next")).alias("to"), F.when(first, 0).otherwise(1).cast("long").alias("left")))
    while True:
        moving, arrived = state.where("to <> ring"), state.where("to = ring")
        if moving.isEmpty():
            return state.select("side", "ring", "left")
        ahead = state.select(F.col("side").alias("to"), F.col("to").alias("beyond"), F.col("left").alias("more"))
        state = cut(moving.join(ahead, "to").select("side", "ring", F.col("beyond").alias("to"), (F.col("left") + F.col("more")).alias("left")).unionByName(arrived))


def outlines(cells: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(polygon, ring, place, x, y): corners of the rings around cells, in order, in grid steps.

    A polygon is named by its smallest cell. Outer rings turn left, holes turn right. Places begin at 0 and have gaps
    where a ring goes straight on. Repeated cells count once, null cells are left out.
    """
    sides = cut(_sides(cells))
    chain = cut(_chained(sides))
    order = _placed(chain, _rings(chain, cut), cut)
    turns = chain.where(F.pmod("side", F.lit(4)) != F.pmod("next", F.lit(4))).select(F.col("next").alias("side"))
    named = sides.join(fires.clusters(cells, False, cut).withColumnRenamed("cluster", "polygon"), "cell").select("side", "start", "polygon")
    corners = named.join(turns, "side").join(order, "side")
    most = order.groupBy("ring").agg(F.max("left").alias("most"))
    place = F.when(F.col("left") == 0, 0).otherwise(F.col("most") + 1 - F.col("left"))
    x = F.floor(F.col("start") / VERTEX)
    return corners.join(most, "ring").select("polygon", "ring", place.cast("long").alias("place"), x.alias("x"), (F.col("start") - x * VERTEX).alias("y"))


def edges_of(corners: DataFrame, level: int) -> DataFrame:
    """(shape, ring, x1, y1, x2, y2): outlines as edges in degrees, for fills and overlays."""
    w = Window.partitionBy("ring").orderBy("place")
    all_ = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nx, ny = F.coalesce(F.lead("x").over(w), F.first("x").over(all_)), F.coalesce(F.lead("y").over(w), F.first("y").over(all_))
    s = 2.0**level
    rows = corners.select("polygon", "ring", "x", "y", nx.alias("nx"), ny.alias("ny"))
    return rows.select(F.col("polygon").alias("shape"), "ring", *[(F.col(c) / s - o).alias(n) for c, o, n in (("x", 180, "x1"), ("y", 90, "y1"), ("nx", 180, "x2"), ("ny", 90, "y2"))])


def multipolygons(corners: DataFrame) -> DataFrame:
    """(polygon, rings): closed rings of (x, y), the outer one first, then holes by their first side."""
    ring = corners.groupBy("polygon", "ring").agg(F.array_sort(F.collect_list(F.struct("place", "x", "y"))).alias("p"))
    point = lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))
    closed = ring.select("polygon", "ring", F.transform(F.concat("p", F.slice("p", 1, 1)), point).alias("p"))
    turn = F.aggregate(F.sequence(F.lit(1), F.size("p") - 1), F.lit(0).cast("long"), lambda s, i: s + F.element_at("p", i)["x"] * F.element_at("p", i + 1)["y"] - F.element_at("p", i)["y"] * F.element_at("p", i + 1)["x"])
    rows = closed.withColumn("hole", turn < 0)
    return rows.groupBy("polygon").agg(F.transform(F.array_sort(F.collect_list(F.struct("hole", "ring", "p"))), lambda r: r["p"]).alias("rings"))
