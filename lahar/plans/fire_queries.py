"""Fire queries on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lahar.functions import geo, grid
from lahar.operators import fires
from lahar.operators.ranking import placed
from lahar.plans import adapter as a
from lahar.plans.shared import shared_cut

Q, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _seen(s, d, level=a.COARSE):
    return a.detections(s, d).withColumn("cell", grid.cell_of(F.col("lon"), F.col("lat"), level))


def _country(s, d, level=a.COARSE):
    e = a.exposure(s, d, level)
    return e.groupBy("cell").agg(F.min("adm2_id").alias("country"), F.sum(F.col("pop_total").cast("decimal(28,6)")).cast("double").alias("pop_total"), *[F.sum(c).alias(c) for c in ("bld_count", "health_count", "edu_count")])


def _fires(s, d, level=a.COARSE):
    return fires.with_exposure(fires.fire_cells(_seen(s, d, level)), _country(s, d, level))


BASE = a.with_ctes(a.DETECTIONS_SQL, a.EXPOSURE_SQL, f"seen AS (SELECT *, {a.cell_sql('lon', 'lat', a.COARSE)} AS cell FROM detections)", """agg AS (
  SELECT cell, count(*) FILTER (confidence <> 'low') AS detecciones, count(*) FILTER (confidence = 'low') AS detecciones_baja, max(frp)::DOUBLE AS frp_max,
    round(sum(frp), 1)::DOUBLE AS frp_suma, round(max(brightness), 1) AS brillo_max_k, min(ts) AS primera_utc, max(ts) AS ultima_utc FROM seen GROUP BY cell)""",
  """country AS (SELECT cell, min(adm2_id) AS country, sum(pop_total::DECIMAL(28,6))::DOUBLE AS pop_total, sum(bld_count)::BIGINT AS bld_count, sum(health_count)::BIGINT AS health_count, sum(edu_count)::BIGINT AS edu_count FROM exposure GROUP BY cell)""",
  """fires AS (SELECT g.*, coalesce(country, '') AS country, coalesce(pop_total, 0) AS pop_total, coalesce(bld_count, 0) AS bld_count, coalesce(health_count, 0) AS health_count, coalesce(edu_count, 0) AS edu_count FROM agg g LEFT JOIN country USING (cell) WHERE detecciones >= 1)""")  # fmt: skip


@register("f11_t10_detection_window", BASE + "SELECT event_id, ts FROM detections WHERE ts IS NULL OR ts >= (SELECT max(ts) FROM detections) - INTERVAL 24 HOUR")
def f11_t10_detection_window(s, d):
    return fires.recent(a.detections(s, d)).select("event_id", "ts")


@register("f3_region_box", BASE + "SELECT event_id FROM detections WHERE lon BETWEEN -90 AND -60 AND lat BETWEEN -20 AND 10")
def f3_region_box(s, d):
    return a.detections(s, d).where(geo.in_box(F.col("lon"), F.col("lat"), -90.0, -20.0, -60.0, 10.0)).select("event_id")


@register("t11_w4_first_of_each", BASE + "SELECT event_id FROM detections QUALIFY row_number() OVER (PARTITION BY round(lon, 0), round(lat, 0), sensor ORDER BY ts, event_id) = 1")
def t11_w4_first_of_each(s, d):
    key = [F.round("lon", 0), F.round("lat", 0), F.col("sensor")]
    return fires.first_of_each(a.detections(s, d), key, [F.col("ts"), F.col("event_id")]).select("event_id")


@register("a19_fire_cells", BASE + "SELECT * FROM agg WHERE detecciones >= 1")
def a19_fire_cells(s, d):
    return fires.fire_cells(_seen(s, d))


@register("a20_discarded_low", BASE.replace(a.cell_sql("lon", "lat", a.COARSE), a.cell_sql("lon", "lat", a.FINE)) + "SELECT count(*) AS celdas, coalesce(sum(detecciones_baja), 0)::BIGINT AS detecciones FROM agg WHERE detecciones = 0")
def a20_discarded_low(s, d):
    return fires.only_low(_seen(s, d, a.FINE))


@register("j6_fires_with_exposure", BASE + "SELECT * FROM fires")
def j6_fires_with_exposure(s, d):
    return _fires(s, d)


TOTALS = """SELECT count(*) AS celdas, coalesce(sum(detecciones), 0)::BIGINT AS detecciones, coalesce(sum(detecciones_baja), 0)::BIGINT AS detecciones_baja, count(*) FILTER (pop_total > 0) AS pobladas,
  coalesce(sum(pop_total::DECIMAL(28,6)), 0)::DOUBLE AS personas, coalesce(sum(health_count), 0)::BIGINT AS salud, coalesce(sum(edu_count), 0)::BIGINT AS edu,
  coalesce(sum(bld_count), 0)::BIGINT AS edificios, coalesce(sum(frp_suma::DECIMAL(28,6)), 0)::DOUBLE AS potencia {more} FROM fires"""


@register("a21_fire_totals", BASE + TOTALS.format(more=", least(count(*), 50) AS celdas_publicadas, (SELECT count(*) FROM agg WHERE detecciones = 0) AS celdas_solo_baja, (SELECT coalesce(sum(detecciones_baja), 0) FROM agg WHERE detecciones = 0)::BIGINT AS detecciones_baja_sin_celda"))
def a21_fire_totals(s, d):
    every = fires.with_exposure(fires.all_cells(_seen(s, d)), _country(s, d))
    return fires.totals(every, cap=50, kept=F.col("detecciones") >= 1)


@register("f12_f18_f19_a36_filtered_totals", BASE + TOTALS.format(more="") + """ WHERE ultima_utc >= (SELECT max(ultima_utc) FROM fires) - INTERVAL 12 HOUR
  AND (floor(cell / 1048576) + 0.5) / 0.25 - 180 BETWEEN -100 AND -40 AND (cell % 1048576 + 0.5) / 0.25 - 90 BETWEEN -40 AND 20""")  # fmt: skip
def f12_f18_f19_a36_filtered_totals(s, d):
    rows = _fires(s, d).withColumn("lon", grid.lon_of(F.col("cell"), a.COARSE)).withColumn("lat", grid.lat_of(F.col("cell"), a.COARSE))
    return fires.totals(fires.viewer_filter(rows, None, 12, (-100.0, -40.0, -40.0, 20.0)))


@register("o3_k10_fire_priority", BASE + "SELECT cell, pop_total, frp_suma FROM fires ORDER BY (pop_total > 0) DESC, pop_total DESC, frp_suma DESC, cell LIMIT 50")
def o3_k10_fire_priority(s, d):
    return fires.priority(_fires(s, d), 50).select("cell", "pop_total", "frp_suma")


@register("o4_o9_fires_by_energy", BASE + "SELECT cell, frp_suma, row_number() OVER (ORDER BY frp_suma DESC, cell) AS place FROM fires")
def o4_o9_fires_by_energy(s, d):
    return placed(_fires(s, d).select("cell", "frp_suma"), [F.desc("frp_suma"), F.col("cell")], "place", shared_cut(s))


@register("a22_weighted_land_cover", BASE + """, c AS (SELECT *, (cell % 1048576) % 3 AS lulc_px, ((cell % 1048576) % 101)::DOUBLE AS bosque FROM fires)
SELECT round(sum((frp_suma * bosque / 100)::DECIMAL(28,6)) FILTER (lulc_px > 0)::DOUBLE / CASE WHEN coalesce(sum(frp_suma) FILTER (lulc_px > 0), 0) = 0 THEN 1 ELSE sum(frp_suma::DECIMAL(28,6)) FILTER (lulc_px > 0)::DOUBLE END * 100, 1) AS bosque,
  count(*) FILTER (lulc_px > 0) AS medidas, count(*) FILTER (NOT lulc_px > 0) AS sin_medir FROM c""")  # fmt: skip
def a22_weighted_land_cover(s, d):
    iy = grid.iy_of(F.col("cell"))
    return fires.weighted_shares(_fires(s, d).withColumn("lulc_px", iy % 3).withColumn("bosque", (iy % 101).cast("double")), ["bosque"])


WIND = BASE + """, lattice AS (SELECT round(lat / 0.25)::BIGINT AS i, round(lon / 0.25)::BIGINT AS j, max(value) AS speed FROM (SELECT lon, lat, c_acctbal AS value FROM """ + f"(SELECT {a.lon_sql('c_custkey')} AS lon, {a.lat_sql('c_custkey')} AS lat, c_acctbal FROM customer)" + ") GROUP BY 1, 2)\n"


def _lattice(s, d):
    p = a.customer_points(s, d)
    return p.groupBy(F.round(F.col("lat") / 0.25).cast("long").alias("i"), F.round(F.col("lon") / 0.25).cast("long").alias("j")).agg(F.max("c_acctbal").alias("speed"))


@register("j18_wind_at_cell", WIND + "SELECT event_id, speed FROM detections LEFT JOIN lattice ON round(lat / 0.25)::BIGINT = i AND round(lon / 0.25)::BIGINT = j")
def j18_wind_at_cell(s, d):
    return fires.wind_at(a.detections(s, d), _lattice(s, d), 0.25).select("event_id", "speed")


@register("j19_wind_at_cluster", BASE + f""", p AS (SELECT c_custkey AS id, {a.lon_sql("c_custkey")} AS lon, {a.lat_sql("c_custkey")} AS lat FROM customer),
q AS (SELECT {a.lon_sql("s_suppkey")} AS w_lon, {a.lat_sql("s_suppkey + 7")} AS w_lat, s_acctbal AS speed FROM supplier)
SELECT id, speed, round(pow(lon - w_lon, 2) + pow(lat - w_lat, 2), 6) AS d2 FROM p JOIN q ON pow(lon - w_lon, 2) + pow(lat - w_lat, 2) <= 0.25
QUALIFY row_number() OVER (PARTITION BY id ORDER BY pow(lon - w_lon, 2) + pow(lat - w_lat, 2), w_lon, w_lat) = 1""")  # fmt: skip
def j19_wind_at_cluster(s, d):
    from lahar.session import table

    k = F.col("s_suppkey")
    return fires.wind_near(a.customer_points(s, d), table(s, d, "supplier").select(a.lon(k).alias("lon"), a.lat(k + 7).alias("lat"), F.col("s_acctbal").alias("speed")))


@register("wind_speed_and_direction", "SELECT event_id, round(sqrt(u * u + v * v), 1) AS speed, (round_even(270.0 - degrees(atan2(v, u)), 0)::INT % 360 + 360) % 360 AS direction FROM (SELECT event_id, (event_id % 41 - 20)::DOUBLE AS u, (user_id % 37 - 18)::DOUBLE AS v FROM events)")
def wind_speed_and_direction(s, d):
    from lahar.session import table

    e = table(s, d, "events").select("event_id", (F.col("event_id") % 41 - 20).cast("double").alias("u"), (F.col("user_id") % 37 - 18).cast("double").alias("v"))
    return e.select("event_id", geo.wind_speed(F.col("u"), F.col("v")).alias("speed"), geo.wind_direction(F.col("u"), F.col("v")).alias("direction"))


#: At a quarter degree: the four-degree cells are one component on all but tiny inputs.
CLUSTERS = BASE.replace(a.cell_sql("lon", "lat", a.COARSE), a.cell_sql("lon", "lat", a.FINE)).replace(
  a.cell_sql(a.lon_sql("c_custkey"), a.lat_sql("c_custkey"), a.COARSE), a.cell_sql(a.lon_sql("c_custkey"), a.lat_sql("c_custkey"), a.FINE)).replace("WITH ", "WITH RECURSIVE ", 1) + """, own AS (SELECT DISTINCT cell FROM fires),
near AS (SELECT cell, cell + unnest([-1048577, -1048576, -1048575, -1, 1, 1048575, 1048576, 1048577]) AS y FROM own),
e AS (SELECT near.cell AS x, y FROM near JOIN own ON y = own.cell),
r AS (SELECT cell, cell AS cluster FROM own UNION SELECT e.y, r.cluster FROM r JOIN e ON r.cell = e.x),
labels AS (SELECT cell, min(cluster) AS cluster FROM r GROUP BY cell)
"""  # fmt: skip


@register("graph_fire_clusters", CLUSTERS + "SELECT * FROM labels")
def graph_fire_clusters(s, d):
    return fires.clusters(_fires(s, d, a.FINE), cut=shared_cut(s))


SUMMARY = """, b AS (SELECT f.*, cluster FROM fires f JOIN labels USING (cell)), m AS (
  SELECT cluster, country FROM b WHERE country <> '' GROUP BY cluster, country QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, country) = 1)
SELECT cluster, count(*) AS celdas, sum(detecciones)::BIGINT AS detecciones, sum(pop_total::DECIMAL(28,6))::DOUBLE AS personas, max(frp_max) AS frp_max, min(primera_utc) AS primera_utc,
  max(ultima_utc) AS ultima_utc, coalesce(any_value(m.country), '') AS country FROM b LEFT JOIN m USING (cluster) GROUP BY cluster"""  # fmt: skip


@register("a34_a35_cluster_summary", CLUSTERS + SUMMARY)
def a34_a35_cluster_summary(s, d):
    rows = shared_cut(s)(_fires(s, d, a.FINE))
    return fires.cluster_summary(rows, fires.clusters(rows, cut=shared_cut(s)))
