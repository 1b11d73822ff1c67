"""Building the exposure asset: pixels, points and lines to cells, the layer star, crosswalks, checks of one build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.functions import geo, grid

#: Degrees for a metre; length of a line step in km, most steps, longest line in km.
DEGREES_PER_M = 1 / 111_320
STEP_KM, MOST_STEPS, LONGEST_KM = 0.2, 2000, 2000.0
PRIMARY_ROADS = ("motorway", "trunk", "primary")


def raster_sums(pixels: DataFrame, level: int, nodata: float | None = None, above: float | None = None) -> DataFrame:
    """Sum of pixel values by cell; partial sums by task come with the aggregation."""
    rows = pixels.where(F.col("value").isNotNull() & ~F.isnan("value"))
    if nodata is not None:
        rows = rows.where(F.col("value") != nodata)
    if above is not None:
        rows = rows.where(F.col("value") > above)
    return rows.groupBy(grid.cell_of(F.col("lon"), F.col("lat"), level).alias("cell")).agg(F.count("*").alias("pixels"), F.sum(F.col("value").cast("decimal(28,6)")).cast("double").alias("total"))


def class_counts(pixels: DataFrame, level: int) -> DataFrame:
    return pixels.groupBy(grid.cell_of(F.col("lon"), F.col("lat"), level).alias("cell"), "class").agg(F.count("*").alias("n"))


def class_shares(counts: DataFrame, classes: list[str]) -> DataFrame:
    """Share of each class among a cell's classified pixels, and their number."""
    total = F.sum("n").over(Window.partitionBy("cell"))
    shares = counts.withColumn("all", total).withColumn("pct", F.round(F.col("n") * 100 / F.col("all"), 1))
    return shares.groupBy("cell").agg(*[F.coalesce(F.max(F.when(F.col("class") == c, F.col("pct"))), F.lit(0.0)).alias(f"{c}_pct") for c in classes], F.max("all").alias("px"))


def sampled(points: DataFrame, raster: DataFrame, west: float, north: float, dx: float, dy: float, value: str) -> DataFrame:
    """Raster value at each point by pixel index; no pixel, NaN or infinity give zero."""
    px, py = F.floor((F.col("lon") - west) / dx).cast("long"), F.floor((F.lit(north) - F.col("lat")) / dy).cast("long")
    both = points.withColumn("px", px).withColumn("py", py).join(raster, ["px", "py"], "left")
    return both.withColumn(value, F.when(geo.is_finite(F.col(value)), F.col(value)).otherwise(0.0)).drop("px", "py")


#: Reference systems whose coordinates are degrees.
GEOGRAPHIC = ("EPSG:4326", "EPSG:4269", "OGC:CRS84")


def sampled_layers(points: DataFrame, layers: dict[str, DataFrame | None], west: float, north: float, dx: float, dy: float, crs: str = "EPSG:4326") -> DataFrame:
    """sampled() of several rasters (px, py, value) of one grid, a column each; an absent raster is a column of zeros.

    A grid that isn't in degrees is an error, as points would meet pixels elsewhere.
    """
    if crs not in GEOGRAPHIC:
        raise ValueError(f"raster in {crs}: only geographic coordinates are sampled")
    for name, raster in layers.items():
        points = points.withColumn(name, F.lit(0.0)) if raster is None else sampled(points, raster.select("px", "py", F.col("value").alias(name)), west, north, dx, dy, name)
    return points


def dedupe_points(first: DataFrame, later: DataFrame, metres: float) -> DataFrame:
    """later's points that have no point of first strictly within a square window; none within a source is dropped.

    Both sides meet in cells as wide as the window: later's points, usually fewer, look into their own cell and the eight
    around. Sides are sorted, not broadcast, so that a task holds no table.
    """
    if metres <= 0:
        return first.unionByName(later)
    d = metres * DEGREES_PER_M
    key = lambda x: F.floor(F.col(x) / d).cast("long")
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    known = first.select(F.col("lon").alias("k_lon"), F.col("lat").alias("k_lat"), key("lon").alias("kx"), key("lat").alias("ky"))
    tried = later.select("lon", "lat").distinct().select("lon", "lat", around).select("lon", "lat", (key("lon") + F.col("o.i")).alias("kx"), (key("lat") + F.col("o.j")).alias("ky"))
    close = (F.abs(F.col("lon") - F.col("k_lon")) < d) & (F.abs(F.col("lat") - F.col("k_lat")) < d)
    same = (F.col("kx") == F.col("k_kx")) & (F.col("ky") == F.col("k_ky"))
    known = known.withColumnsRenamed({"kx": "k_kx", "ky": "k_ky"})
    gone = tried.join(known.hint("merge"), same & close, "left_semi").select("lon", "lat").distinct()
    return first.unionByName(later.join(gone.hint("merge"), ["lon", "lat"], "left_anti").select(*later.columns))


def point_counts(points: DataFrame, level: int) -> DataFrame:
    return points.groupBy(grid.cell_of(F.col("lon"), F.col("lat"), level).alias("cell")).agg(F.count("*").alias("n"))


def road_class(c: Column) -> Column:
    return F.when(c.isin(*PRIMARY_ROADS), "primary").when(c == "secondary", "secondary").otherwise("other")


def wanted_roads(roads: DataFrame, excluded: list[str]) -> DataFrame:
    """Roads without a class stay."""
    return roads.where((F.col("subtype") == "road") & (F.col("class").isNull() | ~F.col("class").isin(excluded)))


def road_km(segments: DataFrame, level: int) -> DataFrame:
    """Road kilometres by cell and class: each segment's length is shared by the midpoints of its steps."""
    km = geo.haversine_km(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    rows = segments.withColumn("km", km).where(geo.is_finite(F.col("km")) & (F.col("km") > 0) & (F.col("km") < LONGEST_KM))
    rows = rows.withColumn("n", F.least(F.greatest(F.ceil(F.col("km") / STEP_KM), F.lit(2)), F.lit(MOST_STEPS)).cast("int"))
    steps = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).withColumn("t", (F.col("i") - 0.5) / F.col("n"))
    cell = grid.cell_of(geo.along(F.col("x1"), F.col("x2"), F.col("t")), geo.along(F.col("y1"), F.col("y2"), F.col("t")), level)
    part = F.col("km") / F.col("n")
    return steps.groupBy(cell.alias("cell")).agg(*[F.round(F.sum(F.when(F.col("class") == c, part).otherwise(0.0)), 6).alias(f"road_km_{c}") for c in ("primary", "secondary", "other")])


def age_bands(main: Column, alt: Column, alt_young: Column, alt_old: Column) -> tuple[Column, Column, Column]:
    """The alternative model's shares on the main total; the middle is what is left, never below zero."""
    share = lambda x: F.when(alt > 0, main * x / alt).otherwise(0.0)
    young, old = share(alt_young), share(alt_old)
    return young, F.greatest(main - young - old, F.lit(0.0)), old


def quality_flags(pop: Column, alt: Column, buildings: Column, built: Column) -> Column:
    """Three rules, joined by commas; null without any."""
    rules = F.concat_ws(
        ",",
        F.when((buildings == 0) & (pop > 500), "sin_edificios"),
        F.when((buildings == 0) & (built > 1000), "construido_sin_edificios"),
        F.when(F.abs(pop - alt) > alt * 2, "poblacion_discrepante"),
    )
    return F.nullif(rules, F.lit(""))


def assemble(crosswalk: DataFrame, lookup: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """The layer star: named cells with every layer joined on the cell, zero where a layer has none.

    All layers share the key, so each is shuffled once and the joins chain without another exchange.
    """
    out = crosswalk.join(lookup, "adm2_id")
    for layer in layers.values():
        names = [c for c in layer.columns if c != "cell"]
        out = out.join(layer, "cell", "left").withColumns({c: F.coalesce(c, F.lit(0).cast(layer.schema[c].dataType)) for c in names})
    return out


def non_empty(cells: DataFrame, columns: list[str]) -> DataFrame:
    cond = F.lit(False)
    for c in columns:
        cond = cond | (F.coalesce(c, F.lit(0)) > 0)
    return cells.where(cond)


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    """Optional columns that an older asset lacks, as typed literals; and which ones they are."""
    missing = [c for c in defaults if c not in df.columns]
    return df.withColumns({c: defaults[c] for c in missing}), missing


def summary(cells: DataFrame) -> DataFrame:
    return cells.agg(
        F.count("*").alias("cells"),
        F.sum(F.col("pop_total").cast("decimal(28,6)")).cast("double").alias("pop_total"),
        F.sum("bld_count").alias("bld_count"),
        F.countDistinct("adm2_id").alias("municipalities"),
        F.count_if(F.col("flags_calidad").isNotNull()).alias("flagged"),
    )


def prorate(values: DataFrame, fractions: DataFrame) -> DataFrame:
    """Values shared by the fractions of a cell that lie in each municipality."""
    return values.join(fractions, "cell").groupBy("adm2_id").agg(F.round(F.sum(F.col("value") * F.col("frac_area")), 6).alias("value"))


def bad_fractions(fractions: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Cells whose fractions leave [0, 1] or don't sum to one."""
    sums = fractions.groupBy("cell").agg(F.sum("frac_area").alias("total"), F.min("frac_area").alias("least"), F.max("frac_area").alias("most"))
    return sums.where((F.abs(F.col("total") - 1) > tolerance) | (F.col("least") < 0) | (F.col("most") > 1)).select("cell")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def dictionary(parts: DataFrame) -> DataFrame:
    """One row for each municipality: its name and the area-weighted centroid of its parts."""
    return parts.groupBy("adm2_id").agg(F.min("name").alias("name"), F.round(F.sum(F.col("lon") * F.col("area")) / F.sum("area"), 6).alias("lon"), F.round(F.sum(F.col("lat") * F.col("area")) / F.sum("area"), 6).alias("lat"))


def extent(points: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """The box of all points, and whether a declared box holds it."""
    box = points.agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))
    return box.withColumn("inside", (F.col("west") >= west) & (F.col("south") >= south) & (F.col("east") <= east) & (F.col("north") <= north))


def source_digest(files: DataFrame) -> DataFrame:
    """One digest of a source from its files' names and digests, whatever their order."""
    return files.groupBy("source").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("  ", "name", "sha256"))), "\n"), 256).alias("digest"))


def fingerprint(sources: DataFrame) -> DataFrame:
    """The first sixteen digits of the digest of a recipe's sorted lines."""
    line = F.concat_ws("|", "id", "layer", "url", "license")
    return sources.groupBy("recipe").agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256), 1, 16).alias("fingerprint"))


def compared(old: DataFrame, new: DataFrame, down_pct: float, up_pct: float) -> DataFrame:
    """Layers of two builds whose change passes an asymmetric margin; layers of one build alone are skipped."""
    both = old.select("layer", F.col("total").alias("before")).join(new.select("layer", F.col("total").alias("after")), "layer").where("before <> 0")
    both = both.withColumn("pct", F.round((F.col("after") - F.col("before")) * 100 / F.col("before"), 4))
    return both.withColumn("ok", F.col("pct").between(-down_pct, up_pct))


#: By how much a layer of a new build may fall and rise, as shares of what was published.
MARGINS = {
    "pop_total": (0.03, 0.03), "celdas": (0.05, 0.05), "municipios": (0.10, 0.10), "bld_count": (0.10, 0.30), "built_m2": (0.10, 0.30),
    "road_km": (0.10, 0.30), "health_count": (0.30, 1.00), "edu_count": (0.30, 1.00),
}


def build_findings(old: DataFrame, new: DataFrame) -> DataFrame:
    """(layer, finding) of layers whose change passes their own margin, or that a new build has emptied.

    old, new: layer, total. Layers that one build lacks, or of which nothing was published, are not judged.
    """
    both = old.select("layer", F.coalesce("total", F.lit(0.0)).alias("before")).join(new.select("layer", F.coalesce("total", F.lit(0.0)).alias("after")), "layer").where("before <> 0")
    bound = lambda j: F.element_at(F.create_map(*[F.lit(x) for k, v in MARGINS.items() for x in (k, v[j])]), F.col("layer"))
    share = (F.col("after") - F.col("before")) / F.col("before")
    finding = F.when(F.col("after") == 0, "emptied").when(share < -bound(0), "fell").when(share > bound(1), "rose")
    return both.where(F.col("layer").isin(*MARGINS)).select("layer", finding.alias("finding")).where("finding IS NOT NULL")


def building_area(edges: DataFrame, level: int, shape: str = "shape", flipped: bool = False) -> DataFrame:
    """(cell, buildings, m2): buildings by the cell of their centroid, with their area on the ellipsoid.

    edges: closed rings, holes turning the other way than their outer ring. Centroids are reckoned from each building's
    own corner: from a far origin, the sums of small rings cancel out and leave errors wider than the building.
    """
    own = Window.partitionBy(shape)
    near = edges.withColumns({"_x": F.min("x1").over(own), "_y": F.min("y1").over(own)})
    part = geo.ellipsoid_area_part(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], flipped=flipped)
    x1, y1, x2, y2 = F.col("x1") - F.col("_x"), F.col("y1") - F.col("_y"), F.col("x2") - F.col("_x"), F.col("y2") - F.col("_y")
    turn = geo.shoelace(x1, y1, x2, y2)
    sums = near.groupBy(shape).agg(F.abs(F.sum(part)).alias("m2"), F.min("_x").alias("x"), F.min("_y").alias("y"), F.sum(turn).alias("s"), F.sum(turn * (x1 + x2)).alias("sx"), F.sum(turn * (y1 + y2)).alias("sy"))
    first, second = F.col("x") + F.col("sx") / (3 * F.col("s")), F.col("y") + F.col("sy") / (3 * F.col("s"))
    at = (second, first) if flipped else (first, second)
    return sums.where("s <> 0").groupBy(grid.cell_of(*at, level).alias("cell")).agg(F.count("*").alias("buildings"), F.round(F.sum("m2"), 1).alias("m2"))


def boundary(cells: DataFrame) -> DataFrame:
    """(ix, iy, upright): the sides of cells that no two of them share, which outline their union."""
    sides = cells.select("cell").distinct().select(F.explode(grid.borders(F.col("cell"))).alias("b")).select("b.*")
    return sides.groupBy("ix", "iy", "upright").agg(F.count("*").alias("n")).where("n = 1").drop("n")


def tiles(west: int, south: int, east: int, north: int, side: int, spark) -> DataFrame:
    """The lower left corners of all tiles that a box touches, also below zero."""
    low = lambda v: v // side * side
    xs = spark.range(1).select(F.explode(F.sequence(F.lit(low(west)), F.lit(low(east)), F.lit(side))).alias("lon"))
    return xs.select("lon", F.explode(F.sequence(F.lit(low(south)), F.lit(low(north)), F.lit(side))).alias("lat"))


def bilinear(points: DataFrame, lattice: DataFrame, step: float = 1.0, value: str = "v") -> DataFrame:
    """(id, value): the lattice's values at points, weighed by nearness to the four lattice points around.

    lattice: lon, lat, value, on multiples of step. NaN where one of the four with weight is missing or null: outside, or
    in a hole. Points meet lattice points by whole steps, an equi-join; points without coordinates give NaN.
    """
    low = lambda c: F.floor(F.col(c) / step).cast("long")
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    rows = points.select("id", "lon", "lat", corner.alias("c")).withColumns({"_x": low("lon") + F.col("c.i"), "_y": low("lat") + F.col("c.j")})
    weight = (1 - F.abs(F.col("lon") / step - F.col("_x"))) * (1 - F.abs(F.col("lat") / step - F.col("_y")))
    known = lattice.select(F.round(F.col("lon") / step).cast("long").alias("_x"), F.round(F.col("lat") / step).cast("long").alias("_y"), F.col(value).alias("_v"))
    met = rows.withColumn("_w", weight).join(known, ["_x", "_y"], "left")
    lost = F.max(F.col("_w").isNull() | ((F.col("_w") > 0) & F.col("_v").isNull()))
    return met.groupBy("id").agg(F.when(lost, F.lit(float("nan"))).otherwise(F.sum(F.when(F.col("_w") > 0, F.col("_w") * F.col("_v")))).alias(value))


def rescued_population(rescued: DataFrame, people: DataFrame, shape: str = "shape") -> DataFrame:
    """(shape, cells, people): what each municipality gains by rescued cells (id, shape), with the people (id, people) there.

    Sums are decimal, so no order of adding changes a figure; a cell without a count gains a cell and nobody.
    """
    both = rescued.join(people, "id", "left")
    return both.groupBy(shape).agg(F.count("*").alias("cells"), F.coalesce(F.sum(F.col("people").cast("decimal(28,6)")), F.lit(0)).cast("double").alias("people"))
