"""Impact queries on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lahar.functions import grid
from lahar.operators import impact
from lahar.plans import adapter as a

Q, SQL = {}, {}
LON, LAT = -75.0, 4.0


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def hit(s, d):
    return impact.join_impact(a.exposure(s, d), a.intensity(s, d), a.ground_failure(s, d))


HIT_SQL = a.with_ctes(a.EXPOSURE_SQL, a.INTENSITY_SQL, a.GROUND_FAILURE_SQL, a.LOOKUP_SQL, """hit AS (
  SELECT e.*, i.mmi, coalesce(g.ls_prob, 0) AS ls_prob, coalesce(g.lq_prob, 0) AS lq_prob
  FROM exposure e JOIN intensity i USING (cell) LEFT JOIN ground_failure g USING (cell))""")  # fmt: skip
_BANDS = ", ".join(f"sum(CASE WHEN mmi >= {b} THEN {c}::DECIMAL(28,6) ELSE 0 END)::DOUBLE AS {c}_{b}" for c, bands in impact.MEASURES.items() for b in bands)
_BANDS += ", " + ", ".join(f"sum(CASE WHEN mmi >= 6 AND {p}_prob >= 0.10 THEN pop_total::DECIMAL(28,6) ELSE 0 END)::DOUBLE AS pop_{p}" for p in ("ls", "lq"))
ADM2_SQL = HIT_SQL + f""", adm2 AS (
  SELECT adm2_id, max(mmi) AS mmi_max, {_BANDS}, nullif(string_agg(DISTINCT flags_calidad, ',' ORDER BY flags_calidad), '') AS flags_calidad
  FROM hit GROUP BY adm2_id)
"""


@register("j1_j2_impact_cells", HIT_SQL + "SELECT * FROM hit")
def j1_j2_impact_cells(s, d):
    return hit(s, d)


@register("a1_a2_municipal_impact", ADM2_SQL + "SELECT * FROM adm2")
def a1_a2_municipal_impact(s, d):
    return impact.by_municipality(hit(s, d))


NATIONAL_SQL = HIT_SQL + f""", sums AS (SELECT max(mmi) AS mmi_max, {_BANDS}, sum(pop_total::DECIMAL(28,6))::DOUBLE AS pop, sum(pop_alt::DECIMAL(28,6))::DOUBLE AS alt FROM hit WHERE mmi >= 6)
SELECT * EXCLUDE (pop, alt), abs(pop - alt) * 100 / nullif(alt, 0) AS discrepancy_pct FROM sums
"""


@register("a3_a4_national_totals", NATIONAL_SQL)
def a3_a4_national_totals(s, d):
    return impact.national(hit(s, d))


_TOP = """SELECT a.*, nombre, adm1_id, departamento, all6, all7,
  CASE WHEN all7 > 0 AND all7 >= all6 * 0.01 THEN pop_total_7 ELSE pop_total_6 END AS pop_band
FROM adm2 a JOIN lookup USING (adm2_id), (SELECT sum(pop_total_6) AS all6, sum(pop_total_7) AS all7 FROM adm2)
WHERE pop_band > 0 ORDER BY pop_band DESC, mmi_max DESC, adm2_id"""


@register("o1_top_municipalities", ADM2_SQL + _TOP + " LIMIT 15")
def o1_top_municipalities(s, d):
    return impact.top_municipalities(hit(s, d), a.lookup(s, d))


@register("o2_municipal_csv_order", ADM2_SQL + f"SELECT adm2_id, nombre, pop_band, row_number() OVER (ORDER BY pop_band DESC, mmi_max DESC, adm2_id) AS place FROM ({_TOP})")
def o2_municipal_csv_order(s, d):
    from pyspark.sql import Window

    adm2 = impact.with_national(impact.by_municipality(hit(s, d)))
    ranked = impact.ranking(adm2, a.lookup(s, d), impact.published_band(F.col("all6"), F.col("all7")), None)
    w = Window.orderBy(F.desc("pop_band"), F.desc("mmi_max"), "adm2_id")
    return ranked.withColumn("place", F.row_number().over(w)).select("adm2_id", "nombre", "pop_band", "place")


@register("r1_title_and_published_band", ADM2_SQL + """SELECT adm2_id,
  CASE WHEN pop_total_8 > 0 AND pop_total_8 >= pop_total_6 * 0.01 THEN 8 WHEN pop_total_7 > 0 AND pop_total_7 >= pop_total_6 * 0.01 THEN 7 WHEN pop_total_6 > 0 THEN 6 ELSE 0 END AS title_band,
  CASE WHEN pop_total_7 > 0 AND pop_total_7 >= pop_total_6 * 0.01 THEN 7 ELSE 6 END AS published_band FROM adm2""")  # fmt: skip
def r1_title_and_published_band(s, d):
    p = [F.col(f"pop_total_{b}") for b in (6, 7, 8)]
    return impact.by_municipality(hit(s, d)).select("adm2_id", impact.title_band(*p).alias("title_band"), impact.published_band(*p[:2]).alias("published_band"))


@register("r2_ranking_fallback", ADM2_SQL + "SELECT adm2_id, CASE WHEN pop_total_6 = 0 THEN pop_total_7 ELSE pop_total_6 END AS figure FROM adm2 WHERE CASE WHEN pop_total_6 = 0 THEN pop_total_7 ELSE pop_total_6 END > 0")
def r2_ranking_fallback(s, d):
    return impact.by_municipality(hit(s, d)).select("adm2_id", impact.ranked_figure(F.lit(6)).alias("figure")).where("figure > 0")


def _centres(df):
    return df.withColumn("lon", grid.lon_of(F.col("cell"), a.COARSE)).withColumn("lat", grid.lat_of(F.col("cell"), a.COARSE))


_KM = "asin(sqrt(least(1.0::DOUBLE, pow(sin((radians({lat}) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians({lat})) * pow(sin(radians({lon} - lon) / 2), 2)))) * 2 * {r}::DOUBLE"
_CENTRES = ", centres AS (SELECT *, (floor(cell / 1048576) + 0.5) / 0.25 - 180 AS lon, (cell % 1048576 + 0.5) / 0.25 - 90 AS lat FROM exposure)\n"
CENTRES_SQL = a.with_ctes(a.EXPOSURE_SQL) + _CENTRES


@register("a6_population_in_radii", CENTRES_SQL + f""", far AS (SELECT pop_total, {_KM.format(lat="4.0", lon="(-75.0)", r="6371.0088")} AS km FROM centres)
SELECT """ + ", ".join(f"coalesce(sum(pop_total) FILTER (km <= {r}), 0) AS pop_{r}km" for r in (250, 500, 1000)) + " FROM far")  # fmt: skip
def a6_population_in_radii(s, d):
    return impact.within_radii(_centres(a.exposure(s, d)), LON, LAT, (250, 500, 1000))


@register("a7_nearest_populated", CENTRES_SQL + f"SELECT round(min({_KM.format(lat='4.0', lon='(-75.0)', r='6371.0')}), 6) AS km FROM centres WHERE pop_total > 0")
def a7_nearest_populated(s, d):
    return impact.nearest_populated(_centres(a.exposure(s, d)), LON, LAT)


@register("r3_radii_when_unfelt", HIT_SQL + _CENTRES + f""", far AS (SELECT pop_total, {_KM.format(lat="4.0", lon="(-75.0)", r="6371.0088")} AS km FROM centres),
parts AS (SELECT * FROM range(2) p(part)), felt AS (SELECT part, coalesce(sum(pop_total) FILTER (mmi >= 6), 0) AS six, coalesce(sum(pop_total) FILTER (mmi >= 7), 0) AS seven FROM parts LEFT JOIN hit ON mmi < 6 OR part = 1 GROUP BY part)
SELECT part, pop_25km, pop_50km, pop_100km FROM felt, (SELECT coalesce(sum(pop_total) FILTER (km <= 25), 0) AS pop_25km, coalesce(sum(pop_total) FILTER (km <= 50), 0) AS pop_50km, coalesce(sum(pop_total) FILTER (km <= 100), 0) AS pop_100km FROM far) WHERE six = 0 AND seven = 0""")  # fmt: skip
def r3_radii_when_unfelt(s, d):
    """Two events: one that is nowhere at six, and the one of the footprint; radii stand where totals are zero."""
    radii = impact.within_radii(_centres(a.exposure(s, d)), LON, LAT)
    felt = lambda df: impact.national(df).select("pop_total_6", "pop_total_7")
    rows = hit(s, d)
    return impact.radii_if_unfelt(felt(rows.where("mmi < 6")), radii).withColumn("part", F.lit(0).cast("long")).unionByName(impact.radii_if_unfelt(felt(rows), radii).withColumn("part", F.lit(1).cast("long")))


@register("a23_viewer_cells", HIT_SQL + """SELECT floor(floor(cell / 1048576) / 2)::BIGINT * 1048576 + floor((cell % 1048576) / 2)::BIGINT AS parent, round(max(mmi), 1) AS mmi, round(sum(pop_total)) AS pop,
  round(sum(pop_total) FILTER (mmi >= 7)) AS pop_7, round(sum(pop_total) FILTER (mmi >= 8)) AS pop_8 FROM hit GROUP BY 1""")  # fmt: skip
def a23_viewer_cells(s, d):
    return impact.viewer_cells(hit(s, d))


@register("a33_w7_area_by_band", HIT_SQL + """, b AS (SELECT floor(mmi)::INT AS band, count(*) AS cells FROM intensity GROUP BY 1)
SELECT band, cells, cells * 0.74::DOUBLE AS km2, round(cells / max(cells) OVER (), 6) AS share FROM b""")  # fmt: skip
def a33_w7_area_by_band(s, d):
    return impact.area_by_band(a.intensity(s, d), 0.74)


@register("a37_cumulative_from_top", HIT_SQL + "SELECT mmi, sum(bld_count)::BIGINT AS bld_count, sum(sum(bld_count)) OVER (ORDER BY mmi DESC)::BIGINT AS cumulative FROM hit GROUP BY mmi")
def a37_cumulative_from_top(s, d):
    return impact.cumulative_from_top(hit(s, d), "mmi", "bld_count")


EVALUATED_SQL = a.with_ctes(a.EXPOSURE_SQL, f"""evaluated AS (SELECT {a.cell_sql(a.lon_sql("event_id"), a.lat_sql("user_id"), -2)} AS cell, count(*) AS evaluadas, count(*) FILTER (event_type = 'error') AS danadas FROM events GROUP BY 1)""")


def _evaluated(s, d):
    from lahar.session import table

    e = table(s, d, "events").select(a._event_cell(a.COARSE).alias("cell"), "event_type")
    return e.groupBy("cell").agg(F.count("*").alias("evaluadas"), F.count_if(F.col("event_type") == "error").alias("danadas"))


@register("a27_evaluated_buildings", EVALUATED_SQL + "SELECT * FROM evaluated")
def a27_evaluated_buildings(s, d):
    return _evaluated(s, d)


@register("j7_a28_contrast", EVALUATED_SQL + """, c AS (SELECT cell, sum(bld_count)::BIGINT AS bld_count FROM exposure GROUP BY 1), t AS (
  SELECT count(*) AS cells, sum(evaluadas)::BIGINT AS evaluadas, sum(danadas)::BIGINT AS danadas, sum(bld_count)::BIGINT AS bld_count FROM evaluated JOIN c USING (cell))
SELECT *, CASE WHEN evaluadas > 0 THEN round(danadas * 100.0::DOUBLE / evaluadas, 4) ELSE 0 END AS damaged_pct, CASE WHEN bld_count > 0 THEN round(evaluadas * 1.0::DOUBLE / bld_count, 4) ELSE 0 END AS coverage FROM t""")  # fmt: skip
def j7_a28_contrast(s, d):
    return impact.contrast(_evaluated(s, d), a.exposure(s, d).groupBy("cell").agg(F.sum("bld_count").alias("bld_count")))


@register("j8_evaluated_without_exposure", EVALUATED_SQL + "SELECT * FROM evaluated WHERE cell NOT IN (SELECT cell FROM exposure)")
def j8_evaluated_without_exposure(s, d):
    return _evaluated(s, d).join(a.exposure(s, d), "cell", "left_anti")


@register("j25_contour_against_grid", HIT_SQL + """SELECT """ + ", ".join(f"sum(CASE WHEN h.mmi >= {b} THEN pop_total ELSE 0 END) AS contour_{b}, sum(CASE WHEN coalesce(g.g, 0) >= {b} THEN pop_total ELSE 0 END) AS grid_{b}" for b in (6, 7)) + " FROM hit h LEFT JOIN (SELECT cell, 4.5 + 5 * ls_prob AS g FROM ground_failure WHERE ls_prob IS NOT NULL) g USING (cell)")
def j25_contour_against_grid(s, d):
    other = a.ground_failure(s, d).where("ls_prob IS NOT NULL").select("cell", (F.lit(4.5) + 5 * F.col("ls_prob")).alias("grid_mmi"))
    return impact.contour_against_grid(hit(s, d), other)


@register("r5_mapping_gap", ADM2_SQL + "SELECT adm2_id, built_m2_6 >= bld_count_6 * 150.0 AS gap FROM adm2")
def r5_mapping_gap(s, d):
    return impact.by_municipality(hit(s, d)).select("adm2_id", impact.mapping_gap(F.col("built_m2_6"), F.col("bld_count_6")).alias("gap"))


@register("r6_zero_cause", ADM2_SQL + "SELECT adm2_id, CASE WHEN mmi_max < 6 THEN 'below_six' WHEN bld_count_6 >= 70 THEN 'deep' WHEN health_count_6 > 3 THEN 'offshore' ELSE 'unknown' END AS cause FROM adm2")
def r6_zero_cause(s, d):
    return impact.by_municipality(hit(s, d)).select("adm2_id", impact.zero_cause(F.col("mmi_max"), F.col("bld_count_6"), F.col("health_count_6") > 3).alias("cause"))
