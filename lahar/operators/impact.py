"""Hazard by exposure: the cell join, cumulative bands by municipality and nation, ranking, radii."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.functions import geo

BANDS = (6, 7, 8)
#: A band titles a report only if it holds this share of the population at six and more.
TITLE_SHARE = 0.01
GROUND_FAILURE_FLOOR = 0.10
#: Published measures by band: column, the bands that are published.
MEASURES = {
    "pop_total": (6, 7, 8), "pop_0_14": (6, 7), "pop_65p": (6, 7), "bld_count": (6, 7), "built_m2": (6, 7),
    "health_count": (6, 7), "edu_count": (6, 7), "road_km": (6, 7),
}


def join_impact(exposure: DataFrame, intensity: DataFrame, ground_failure: DataFrame | None = None) -> DataFrame:
    """Exposure of every cell in the footprint; ground failure where it is known, else zero.

    All sides are keyed by cell; Spark broadcasts the footprint when its size allows, and otherwise all three
    shuffle once on the same key.
    """
    out = exposure.join(intensity, "cell")
    if ground_failure is not None:
        out = out.join(ground_failure, "cell", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("ls_prob", "lq_prob")})
    return out


def exact(column: str) -> Column:
    return F.col(column).cast("decimal(28,6)")


def banded(column: str, band: float, also: Column | None = None) -> Column:
    """Sum over cells at the band and above, in decimals, so that no order of adding changes a published figure."""
    cond = F.col("mmi") >= band
    return F.sum(F.when(cond if also is None else cond & also, F.col(column)).otherwise(F.lit(0).cast("decimal(28,6)"))).cast("double")


def measured(impact: DataFrame) -> DataFrame:
    """Every measure as a decimal, cast once for all its bands."""
    return impact.withColumns({c: exact(c) for c in MEASURES})


def band_measures() -> list[Column]:
    """Of measured() rows."""
    out = [banded(c, b).alias(f"{c}_{b}") for c, bands in MEASURES.items() for b in bands]
    for prob in ("ls_prob", "lq_prob"):
        out.append(banded("pop_total", 6, F.col(prob) >= GROUND_FAILURE_FLOOR).alias(f"pop_{prob[:2]}"))
    return out


def by_municipality(impact: DataFrame, key: str = "adm2_id") -> DataFrame:
    flags = F.nullif(F.array_join(F.array_sort(F.collect_set("flags_calidad")), ","), F.lit(""))
    return measured(impact).groupBy(key).agg(F.max("mmi").alias("mmi_max"), *band_measures(), flags.alias("flags_calidad"))


def discrepancy_pct(total: Column, alternative: Column) -> Column:
    """Null where there is nothing to compare with: unmeasured is not zero."""
    return F.abs(total - alternative) * 100 / F.nullif(alternative, F.lit(0.0))


def national(impact: DataFrame) -> DataFrame:
    """The same measures over all cells at six and above; null sums are zero, but not the discrepancy."""
    felt = measured(impact.where(F.col("mmi") >= 6))
    sums = felt.agg(F.max("mmi").alias("mmi_max"), *band_measures(), F.sum("pop_total").cast("double").alias("pop"), F.sum(exact("pop_alt")).cast("double").alias("alt"))
    names = [c for c in sums.columns if c not in ("mmi_max", "pop", "alt")]
    return sums.select("mmi_max", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names], discrepancy_pct(F.col("pop"), F.col("alt")).alias("discrepancy_pct"))


def title_band(pop6: Column, pop7: Column, pop8: Column) -> Column:
    return F.when((pop8 > 0) & (pop8 >= pop6 * TITLE_SHARE), 8).when((pop7 > 0) & (pop7 >= pop6 * TITLE_SHARE), 7).when(pop6 > 0, 6).otherwise(0)


def published_band(pop6: Column, pop7: Column) -> Column:
    return F.when((pop7 > 0) & (pop7 >= pop6 * TITLE_SHARE), 7).otherwise(6)


def ranked_figure(band: Column) -> Column:
    """What a municipality is ranked by: at band 7 the people at seven and above, else those at six, or at seven if none."""
    six, seven = F.coalesce("pop_total_6", F.lit(0.0)), F.coalesce("pop_total_7", F.lit(0.0))
    return F.when((band == 7) | (six == 0), seven).otherwise(six)


def ranking(adm2: DataFrame, lookup: DataFrame, band: Column, top: int | None = 15) -> DataFrame:
    """Named municipalities with a figure, by that of the published band, then intensity, then code."""
    named = adm2.join(lookup, "adm2_id").withColumn("pop_band", ranked_figure(band)).where("pop_band > 0")
    ordered = named.orderBy(F.desc("pop_band"), F.desc("mmi_max"), "adm2_id")
    return ordered if top is None else ordered.limit(top)


def top_municipalities(impact: DataFrame, lookup: DataFrame, top: int = 15) -> DataFrame:
    """The ranking at the band that the national totals publish, from one pass over the cells."""
    return ranking(with_national(by_municipality(impact)), lookup, published_band(F.col("all6"), F.col("all7")), top)


def with_national(adm2: DataFrame) -> DataFrame:
    """Municipal rows with the sums of all, by a window over them: as many rows as a country has municipalities."""
    every = Window.partitionBy()
    return adm2.withColumns({"all6": F.sum("pop_total_6").over(every), "all7": F.sum("pop_total_7").over(every)})


def within_radii(cells: DataFrame, lon: float, lat: float, radii: tuple[int, ...] = (25, 50, 100)) -> DataFrame:
    """Population no farther from a point than each radius; radii are cumulative."""
    d = geo.haversine_km(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat), geo.RADIUS_PRELIMINARY)
    return cells.withColumn("km", d).agg(*[F.coalesce(F.sum(F.when(F.col("km") <= r, F.col("pop_total"))), F.lit(0.0)).alias(f"pop_{r}km") for r in radii])


def nearest_populated(cells: DataFrame, lon: float, lat: float) -> DataFrame:
    """Distance to the nearest cell with people; null if there is none."""
    d = geo.haversine_km(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat))
    return cells.where("pop_total > 0").agg(F.round(F.min(d), 6).alias("km"))


def radii_if_unfelt(totals: DataFrame, radii: DataFrame) -> DataFrame:
    """Radii figures only where nobody is at six or seven and above."""
    return radii.crossJoin(F.broadcast(totals.select("pop_total_6", "pop_total_7"))).where("pop_total_6 = 0 AND pop_total_7 = 0").drop("pop_total_6", "pop_total_7")  # one row each


def zero_cause(mmi_max: Column, depth: Column, offshore: Column) -> Column:
    """Why a table holds only zeros."""
    return F.when(mmi_max.isNotNull() & (mmi_max < 6), "below_six").when(depth >= 70, "deep").when(offshore, "offshore").otherwise("unknown")


def mapping_gap(built: Column, buildings: Column) -> Column:
    """Whether built-up area is half as much again as mapped buildings of 100 m2 would have."""
    return built >= buildings * 150.0


def viewer_cells(cells: DataFrame, levels: int = 1) -> DataFrame:
    """Cells one level up: rounded maxima and sums, bands null where none qualify."""
    from lahar.functions import grid

    up = cells.withColumn("parent", grid.parent(F.col("cell"), levels))
    return up.groupBy("parent").agg(
        F.round(F.max("mmi"), 1).alias("mmi"),
        F.round(F.sum("pop_total")).alias("pop"),
        F.round(F.sum(F.when(F.col("mmi") >= 7, F.col("pop_total")))).alias("pop_7"),
        F.round(F.sum(F.when(F.col("mmi") >= 8, F.col("pop_total")))).alias("pop_8"),
    )


def area_by_band(cells: DataFrame, km2: float) -> DataFrame:
    """Cells and area of each whole band, and its share of the largest."""
    from pyspark.sql import Window

    bands = cells.groupBy(F.floor("mmi").cast("int").alias("band")).agg(F.count("*").alias("cells"))
    return bands.withColumn("km2", F.col("cells") * km2).withColumn("share", F.round(F.col("cells") / F.max("cells").over(Window.partitionBy()), 6))


def cumulative_from_top(rows: DataFrame, level: str, amount: str) -> DataFrame:
    """What stands at each level and above; one row for each level."""
    from pyspark.sql import Window

    w = Window.orderBy(F.desc(level)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.groupBy(level).agg(F.sum(amount).alias(amount)).withColumn("cumulative", F.sum(amount).over(w))


def contrast(evaluated: DataFrame, cells: DataFrame) -> DataFrame:
    """Evaluated buildings against the asset's: cells, damage share and ratio of counts, zero without a denominator."""
    both = evaluated.join(cells, "cell")
    sums = both.agg(F.count("*").alias("cells"), F.sum("evaluadas").alias("evaluadas"), F.sum("danadas").alias("danadas"), F.sum("bld_count").alias("bld_count"))
    ratio = lambda a, b, k: F.when(F.col(b) > 0, F.round(F.col(a) * k / F.col(b), 4)).otherwise(0.0)
    return sums.select("cells", "evaluadas", "danadas", "bld_count", ratio("danadas", "evaluadas", 100.0).alias("damaged_pct"), ratio("evaluadas", "bld_count", 1.0).alias("coverage"))


def contour_against_grid(contour: DataFrame, grid_cells: DataFrame, bands: tuple[int, ...] = (6, 7)) -> DataFrame:
    """Population by band under two intensity estimates of the same cells; a cell missing in one counts as zero there."""
    both = contour.join(grid_cells, "cell", "left").withColumn("grid_mmi", F.coalesce("grid_mmi", F.lit(0.0)))
    out = []
    for b in bands:
        out += [F.sum(F.when(F.col("mmi") >= b, F.col("pop_total")).otherwise(0.0)).alias(f"contour_{b}"), F.sum(F.when(F.col("grid_mmi") >= b, F.col("pop_total")).otherwise(0.0)).alias(f"grid_{b}")]
    return both.agg(*out)
