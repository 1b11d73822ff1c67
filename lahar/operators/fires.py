"""Fire detections: windows, cells, totals, priority, wind, and connected clusters."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.functions import grid
from lahar.operators import graph

WINDOW_HOURS = 24
CAP = 60_000


def recent(rows: DataFrame, stamp: str = "ts", hours: int = WINDOW_HOURS) -> DataFrame:
    """Rows within hours of the newest stamp of the rows themselves, not of the clock; rows without a stamp stay."""
    newest = rows.agg(F.max(stamp).alias("_newest"))
    joined = rows.crossJoin(F.broadcast(newest))  # one row
    return joined.where(F.col(stamp).isNull() | F.col("_newest").isNull() | (F.col(stamp) >= F.col("_newest") - F.make_interval(hours=F.lit(hours)))).drop("_newest")


def first_of_each(rows: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """Deduplication: the first row of each key in reading order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def all_cells(rows: DataFrame) -> DataFrame:
    """Every cell with a detection, those of low confidence alone too."""
    low = F.col("confidence") == "low"
    return rows.groupBy("cell").agg(
        F.count_if(~low).alias("detecciones"),
        F.count_if(low).alias("detecciones_baja"),
        F.max("frp").cast("double").alias("frp_max"),
        F.round(F.sum("frp"), 1).cast("double").alias("frp_suma"),
        F.round(F.max("brightness"), 1).alias("brillo_max_k"),
        F.min("ts").alias("primera_utc"),
        F.max("ts").alias("ultima_utc"),
    )


def fire_cells(rows: DataFrame) -> DataFrame:
    """Cells with at least one detection that isn't of low confidence."""
    return all_cells(rows).where("detecciones >= 1")


def only_low(rows: DataFrame) -> DataFrame:
    """What fire_cells leaves out, counted."""
    return all_cells(rows).where("detecciones = 0").agg(F.count("*").alias("celdas"), F.coalesce(F.sum("detecciones_baja"), F.lit(0)).alias("detecciones"))


def with_exposure(fires: DataFrame, cells: DataFrame) -> DataFrame:
    """Every fire cell; where the asset has none, no country and zeros."""
    numbers = [c for c in cells.columns if c not in ("cell", "country")]
    return fires.join(cells, "cell", "left").withColumns({"country": F.coalesce("country", F.lit(""))} | {c: F.coalesce(c, F.lit(0).cast(cells.schema[c].dataType)) for c in numbers})


def totals(fires: DataFrame, discarded: DataFrame | None = None, cap: int | None = None, kept: Column | None = None) -> DataFrame:
    """Sums over all cells. Columns that a table lacks (health_count, edu_count) count as zero.

    With discarded, as only_low() gives it, and the cap of the published list, also what both leave out. With kept, a
    condition on cells, sums are over kept ones and the others are what is discarded, all in one pass.
    """
    own = lambda c: F.col(c) if kept is None else F.when(kept, F.col(c))
    whole = lambda c: (F.coalesce(F.sum(own(c)), F.lit(0)) if c in fires.columns else F.lit(0).cast("long"))
    exact = lambda c: F.coalesce(F.sum(own(c).cast("decimal(28,6)")), F.lit(0)).cast("double")
    left_out = [] if kept is None else [F.count_if(~kept).alias("celdas_solo_baja"), F.coalesce(F.sum(F.when(~kept, F.col("detecciones_baja"))), F.lit(0)).alias("detecciones_baja_sin_celda")]
    sums = fires.agg(
        (F.count("*") if kept is None else F.count_if(kept)).alias("celdas"),
        whole("detecciones").alias("detecciones"),
        whole("detecciones_baja").alias("detecciones_baja"),
        F.count_if((F.col("pop_total") > 0) & (F.lit(True) if kept is None else kept)).alias("pobladas"),
        exact("pop_total").alias("personas"),
        whole("health_count").alias("salud"),
        whole("edu_count").alias("edu"),
        whole("bld_count").alias("edificios"),
        exact("frp_suma").alias("potencia"),
        *left_out,
    )
    if discarded is not None:
        left = discarded.select(F.col("celdas").alias("celdas_solo_baja"), F.col("detecciones").alias("detecciones_baja_sin_celda"))
        sums = sums.crossJoin(F.broadcast(left))  # one row
    return sums if cap is None else sums.withColumn("celdas_publicadas", F.least("celdas", F.lit(cap)))


def document(fires: DataFrame, discarded: DataFrame, cap: int = CAP) -> DataFrame:
    """One JSON document: totals over all cells, the cap, and the listed cells in order of priority."""
    sums = totals(fires, discarded, cap)
    listed = priority(fires, cap).withColumn("_place", F.row_number().over(Window.orderBy(*_by_priority())))
    cells = [c for c in fires.columns]
    row = F.struct("_place", F.struct(*cells).alias("c"))
    lists = listed.agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["c"]).alias("cells"))  # at most cap rows
    both = sums.select(F.struct(*sums.columns).alias("totals")).crossJoin(F.broadcast(lists))
    return both.select(F.to_json(F.struct("totals", F.lit(cap).alias("cap"), "cells")).alias("json"))


def _by_priority() -> list:
    return [(F.col("pop_total") > 0).desc(), F.desc("pop_total"), F.desc("frp_suma"), F.col("cell")]


def priority(fires: DataFrame, cap: int = CAP) -> DataFrame:
    """Populated cells first by people and power, then the others by power; the cap is part of the product."""
    return fires.orderBy(*_by_priority()).limit(cap)


def weighted_shares(fires: DataFrame, shares: list[str]) -> DataFrame:
    """Energy-weighted land-cover shares over cells that were measured; how many were and weren't."""
    seen = F.col("lulc_px") > 0
    energy = F.sum(F.when(seen, F.col("frp_suma").cast("decimal(28,6)"))).cast("double")
    safe = F.when(F.coalesce(energy, F.lit(0.0)) == 0, 1.0).otherwise(energy)
    parts = [F.round(F.sum(F.when(seen, (F.col("frp_suma") * F.col(s) / 100).cast("decimal(28,6)"))).cast("double") / safe * 100, 1).alias(s) for s in shares]
    return fires.agg(*parts, F.count_if(seen).alias("medidas"), F.count_if(~seen).alias("sin_medir"))


def wind_at(points: DataFrame, lattice: DataFrame, step: float) -> DataFrame:
    """Wind of the nearest lattice point, by its rounded index; null where the lattice has none."""
    i, j = F.round(F.col("lat") / step).cast("long"), F.round(F.col("lon") / step).cast("long")
    return points.withColumn("i", i).withColumn("j", j).join(lattice, ["i", "j"], "left")


def wind_near(points: DataFrame, lattice: DataFrame, most: float = 0.5) -> DataFrame:
    """Nearest published lattice point within most degrees: both sides meet in cells of that side, eight around.

    Sides are sorted, not broadcast: a task holds the points of one cell. Pairs are points times lattice points near by.
    """
    key = lambda x: F.floor(F.col(x) / most).cast("long")
    near = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    p = points.select("*", near.alias("_o")).withColumn("_kx", key("lon") + F.col("_o.dx")).withColumn("_ky", key("lat") + F.col("_o.dy")).drop("_o")
    q = lattice.select(F.col("lon").alias("w_lon"), F.col("lat").alias("w_lat"), "speed", F.floor(F.col("lon") / most).cast("long").alias("_kx"), F.floor(F.col("lat") / most).cast("long").alias("_ky"))
    both = p.join(q.hint("merge"), ["_kx", "_ky"]).withColumn("d2", F.pow(F.col("lon") - F.col("w_lon"), 2) + F.pow(F.col("lat") - F.col("w_lat"), 2)).where(F.col("d2") <= most * most)
    best = both.groupBy("id").agg(F.min_by(F.struct("speed", "d2"), F.struct("d2", "w_lon", "w_lat")).alias("b"))
    return best.select("id", F.col("b.speed").alias("speed"), F.round("b.d2", 6).alias("d2"))


#: Cells of a block are joined in one task: at most 4 ** BLOCK of them.
BLOCK = 6


def _in_blocks(cells: DataFrame, diagonal: bool) -> DataFrame:
    """(cell, piece): connected cells within each block, named by their smallest cell."""
    steps = [(1 << 20), 1, (1 << 20) + 1, (1 << 20) - 1][: 4 if diagonal else 2]

    def joined(table: pa.Table) -> pa.Table:
        own = sorted(table.column("cell").to_pylist())
        to = {c: c for c in own}

        def root(c: int) -> int:
            while to[c] != c:
                to[c] = c = to[to[c]]
            return c

        for c in own:
            for step in steps:
                if c + step in to:
                    x, y = root(c), root(c + step)
                    to[max(x, y)] = min(x, y)
        return pa.table({"cell": pa.array(own, pa.int64()), "piece": pa.array([root(c) for c in own], pa.int64())})

    return cells.groupBy(grid.parent(F.col("cell"), BLOCK).alias("block")).applyInArrow(joined, "cell long, piece long")


def clusters(cells: DataFrame, diagonal: bool = True, cut=None) -> DataFrame:
    """(cell, cluster): connected components of adjacent cells, named by their smallest cell. Null cells are left out.

    Cells are joined within square blocks first, each in one pass; only cells at a block's border meet cells of others,
    and only the pieces that these belong to go through rounds of contraction. cut writes what a round needs where lost
    executors don't matter.
    """
    cut = cut or (lambda df: df.checkpoint())
    pieces = cut(_in_blocks(cells.select("cell").where("cell IS NOT NULL").distinct(), diagonal))
    side = 1 << BLOCK
    x, y = grid.ix_of(F.col("cell")) % side, grid.iy_of(F.col("cell")) % side
    border = pieces.where((x == 0) | (x == side - 1) | (y == 0) | (y == side - 1))
    block = lambda c: grid.parent(F.col(c), BLOCK)
    near = border.select("cell", F.col("piece").alias("x"), F.explode(grid.neighbours(F.col("cell"), 1, diagonal)).alias("near")).where(block("cell") != block("near"))
    links = near.join(border.select(F.col("cell").alias("near"), F.col("piece").alias("y")), "near").select("x", "y")
    roots = graph.components(links, cut).select(F.col("node").alias("piece"), "root")
    return pieces.join(roots, "piece", "left").select("cell", F.coalesce("root", "piece").alias("cluster"))


def cluster_summary(fires: DataFrame, labels: DataFrame) -> DataFrame:
    """Per cluster: cells, detections, people, power, first and last sight; its most frequent country, blanks ignored."""
    both = fires.join(labels, "cell")
    named = both.where("country <> ''").groupBy("cluster", "country").agg(F.count("*").alias("n"))
    modal = named.groupBy("cluster").agg(F.min_by("country", F.struct((-F.col("n")).alias("n"), "country")).alias("country"))
    sums = both.groupBy("cluster").agg(
        F.count("*").alias("celdas"),
        F.sum("detecciones").alias("detecciones"),
        F.sum(F.col("pop_total").cast("decimal(28,6)")).cast("double").alias("personas"),
        F.max("frp_max").alias("frp_max"),
        F.min("primera_utc").alias("primera_utc"),
        F.max("ultima_utc").alias("ultima_utc"),
    )
    return sums.join(modal, "cluster", "left").withColumn("country", F.coalesce("country", F.lit("")))


def viewer_filter(rows: DataFrame, country: str | None, hours: int | None, box: tuple[float, float, float, float] | None) -> DataFrame:
    """The viewer's list filters; rows without a date or coordinates pass."""
    out = rows
    if country is not None:
        out = out.where(F.col("country") == country)
    if hours is not None:
        out = recent(out, "ultima_utc", hours)
    if box is not None:
        w, s, e, n = box
        out = out.where(F.col("lon").isNull() | F.col("lat").isNull() | (F.col("lon").between(w, e) & F.col("lat").between(s, n)))
    return out


#: How a list of fires can be sorted, and how many are listed.
ORDERS, LISTED = {"people": "people", "recent": "last", "area": "area", "energy": "energy"}, 60


def listed(clusters: DataFrame, mode: str, most: int = LISTED) -> DataFrame:
    """(place, of, cluster, ...): the first fires by the figure chosen, ties by cluster, and how many there are in all.

    A missing figure comes last. Places are given to the rows listed only.
    """
    order = [F.desc_nulls_last(ORDERS[mode]), F.col("cluster")]
    every = F.broadcast(clusters.agg(F.count("*").alias("of")))  # one row
    top = clusters.orderBy(*order).limit(most)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).crossJoin(every)
