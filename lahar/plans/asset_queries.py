"""Asset and polygon queries on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lahar.functions import geo, grid
from lahar.operators import assets, polygons
from lahar.plans import adapter as a
from lahar.plans.shared import shared_cut
from lahar.session import table

Q, SQL = {}, {}
PX = a.with_ctes(a.PIXELS_SQL)
PT = a.with_ctes(a.POINTS_SQL)
CELL2 = a.cell_sql("lon", "lat", a.FINE)


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@register("s6_a8_raster_sums", PX + f"SELECT {CELL2} AS cell, count(*) AS pixels, sum(value::DECIMAL(28,6))::DOUBLE AS total FROM pixels WHERE value <> 7 AND value > 2 GROUP BY 1")
def s6_a8_raster_sums(s, d):
    return assets.raster_sums(a.pixels(s, d), a.FINE, 7.0, 2.0)


COUNTS = PX.rstrip() + f", counts AS (SELECT {CELL2} AS cell, class, count(*) AS n FROM pixels GROUP BY 1, 2)\n"


@register("s7_a9_class_counts", COUNTS + "SELECT * FROM counts")
def s7_a9_class_counts(s, d):
    return assets.class_counts(a.pixels(s, d), a.FINE)


@register("a10_w1_class_shares", COUNTS + ", t AS (SELECT *, sum(n) OVER (PARTITION BY cell)::BIGINT AS px FROM counts) SELECT cell, " + ", ".join(f"coalesce(max(round(n * 100 / px::DOUBLE, 1)) FILTER (class = '{c}'), 0) AS {c}_pct" for c in ("AF", "NO", "RF", "AO")) + ", max(px) AS px FROM t GROUP BY cell")
def a10_w1_class_shares(s, d):
    return assets.class_shares(assets.class_counts(a.pixels(s, d), a.FINE), ["AF", "NO", "RF", "AO"])


RASTER = """raster AS (SELECT floor((lon + 119) / 0.5)::BIGINT AS px, floor((33 - lat) / 0.5)::BIGINT AS py, max(value) AS v FROM pixels GROUP BY 1, 2)"""


@register("s8_j17_sampled_raster", a.with_ctes(a.PIXELS_SQL, a.POINTS_SQL, RASTER) + "SELECT id, coalesce(v, 0) AS v FROM points LEFT JOIN raster ON floor((lon + 119) / 0.5)::BIGINT = px AND floor((33 - lat) / 0.5)::BIGINT = py")
def s8_j17_sampled_raster(s, d):
    p = a.pixels(s, d)
    raster = p.groupBy(F.floor((F.col("lon") + 119) / 0.5).cast("long").alias("px"), F.floor((F.lit(33) - F.col("lat")) / 0.5).cast("long").alias("py")).agg(F.max("value").alias("v"))
    return assets.sampled(a.customer_points(s, d), raster, -119.0, 33.0, 0.5, 0.5, "v").select("id", "v")


SECOND = f"second AS (SELECT s_suppkey AS id, {a.lon_sql('s_suppkey')} + (s_suppkey % 5) * 0.01 AS lon, {a.lat_sql('s_suppkey')} AS lat FROM supplier)"


def _two(s, d):
    k = F.col("s_suppkey")
    return a.customer_points(s, d).select("id", "lon", "lat"), table(s, d, "supplier").select(k.alias("id"), (a.lon(k) + (k % 5) * 0.01).alias("lon"), a.lat(k).alias("lat"))


@register("j10_point_dedupe", a.with_ctes(a.POINTS_SQL, SECOND) + """SELECT id, lon, lat FROM points UNION ALL SELECT id, lon, lat FROM second b WHERE NOT EXISTS (
  SELECT 1 FROM points p WHERE abs(p.lon - b.lon) < 2000 / 111320.0::DOUBLE AND abs(p.lat - b.lat) < 2000 / 111320.0::DOUBLE)""")  # fmt: skip
def j10_point_dedupe(s, d):
    return assets.dedupe_points(*_two(s, d), metres=2000)


@register("a11_a12_point_counts", PT + f"SELECT {CELL2} AS cell, count(*) AS n FROM points GROUP BY 1")
def a11_a12_point_counts(s, d):
    return assets.point_counts(a.customer_points(s, d), a.FINE)


ROADS = f"""roads AS (SELECT s_suppkey AS id, {a.lon_sql("s_suppkey")} AS x1, {a.lat_sql("s_suppkey")} AS y1, {a.lon_sql("s_suppkey")} + 0.02 * (s_suppkey % 7) AS x2, {a.lat_sql("s_suppkey")} + 0.03 AS y2,
  CASE s_suppkey % 5 WHEN 0 THEN 'motorway' WHEN 1 THEN 'secondary' WHEN 2 THEN NULL WHEN 3 THEN 'footway' ELSE 'residential' END AS class, CASE WHEN s_suppkey % 9 = 0 THEN 'rail' ELSE 'road' END AS subtype FROM supplier)"""


def _roads(s, d):
    k = F.col("s_suppkey")
    kind = F.when(k % 5 == 0, "motorway").when(k % 5 == 1, "secondary").when(k % 5 == 3, "footway").when(k % 5 == 4, "residential")
    return table(s, d, "supplier").select(k.alias("id"), a.lon(k).alias("x1"), a.lat(k).alias("y1"), (a.lon(k) + 0.02 * (k % 7)).alias("x2"), (a.lat(k) + 0.03).alias("y2"), kind.alias("class"), F.when(k % 9 == 0, "rail").otherwise("road").alias("subtype"))


@register("f6_f7_road_classes", a.with_ctes(ROADS) + "SELECT id, CASE WHEN class IN ('motorway','trunk','primary') THEN 'primary' WHEN class = 'secondary' THEN 'secondary' ELSE 'other' END AS class FROM roads WHERE subtype = 'road' AND (class IS NULL OR class <> 'footway')")
def f6_f7_road_classes(s, d):
    return assets.wanted_roads(_roads(s, d), ["footway"]).select("id", assets.road_class(F.col("class")).alias("class"))


_SEG = "asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(y2) - radians(y1)) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2)))) * 2 * 6371.0::DOUBLE"


@register("a13_f9_road_km", a.with_ctes(ROADS, f"k AS (SELECT *, {_SEG} AS km, CASE WHEN class IN ('motorway','trunk','primary') THEN 'primary' WHEN class = 'secondary' THEN 'secondary' ELSE 'other' END AS c FROM roads)",
  "n AS (SELECT *, least(greatest(ceil(km / 0.2), 2), 2000)::INT AS n FROM k WHERE km > 0 AND km < 2000)", "st AS (SELECT *, (unnest(range(1, n + 1)) - 0.5) / n::DOUBLE AS t FROM n)",
  f"p AS (SELECT {a.cell_sql('(x1 + (x2 - x1) * t)', '(y1 + (y2 - y1) * t)', a.FINE)} AS cell, c, km / n AS part FROM st)")
  + "SELECT cell, " + ", ".join(f"round(sum(CASE WHEN c = '{c}' THEN part ELSE 0 END), 6) AS road_km_{c}" for c in ("primary", "secondary", "other")) + " FROM p GROUP BY cell")
def a13_f9_road_km(s, d):
    return assets.road_km(_roads(s, d).withColumn("class", assets.road_class(F.col("class"))), a.FINE)


EXP = a.with_ctes(a.EXPOSURE_SQL, a.LOOKUP_SQL)


@register("age_bands_scaled", EXP + """SELECT cell, adm2_id, round(CASE WHEN pop_alt > 0 THEN pop_total * pop_0_14 / pop_alt ELSE 0 END, 4) AS young, round(greatest(pop_total - (CASE WHEN pop_alt > 0 THEN pop_total * pop_0_14 / pop_alt ELSE 0 END)
  - (CASE WHEN pop_alt > 0 THEN pop_total * pop_65p / pop_alt ELSE 0 END), 0), 4) AS middle, round(CASE WHEN pop_alt > 0 THEN pop_total * pop_65p / pop_alt ELSE 0 END, 4) AS old FROM exposure""")  # fmt: skip
def age_bands_scaled(s, d):
    y, m, o = assets.age_bands(*[F.col(c) for c in ("pop_total", "pop_alt", "pop_0_14", "pop_65p")])
    return a.exposure(s, d).select("cell", "adm2_id", F.round(y, 4).alias("young"), F.round(m, 4).alias("middle"), F.round(o, 4).alias("old"))


@register("quality_flags", EXP + """SELECT cell, adm2_id, nullif(concat_ws(',', CASE WHEN health_count = 0 AND pop_total > 500 THEN 'sin_edificios' END, CASE WHEN health_count = 0 AND built_m2 > 1000 THEN 'construido_sin_edificios' END,
  CASE WHEN abs(pop_total - pop_alt) > pop_alt * 2 THEN 'poblacion_discrepante' END), '') AS flags FROM exposure""")  # fmt: skip
def quality_flags(s, d):
    return a.exposure(s, d).select("cell", "adm2_id", assets.quality_flags(*[F.col(c) for c in ("pop_total", "pop_alt", "health_count", "built_m2")]).alias("flags"))


STAR = EXP + f""", cross_walk AS (SELECT cell, min(adm2_id) AS adm2_id FROM exposure GROUP BY cell), p AS (SELECT {a.cell_sql(a.lon_sql("l_orderkey"), a.lat_sql("l_partkey"), -2)} AS cell, count(*) AS px FROM lineitem GROUP BY 1),
b AS (SELECT cell, sum(bld_count)::BIGINT AS bld, sum(road_km) AS road FROM exposure GROUP BY cell), h AS (SELECT cell, sum(health_count)::BIGINT AS health FROM exposure WHERE health_count > 2 GROUP BY cell),
star AS (SELECT c.cell, c.adm2_id, l.nombre, coalesce(p.px, 0) AS px, coalesce(bld, 0) AS bld, coalesce(road, 0) AS road, coalesce(health, 0) AS health
  FROM cross_walk c JOIN lookup l USING (adm2_id) LEFT JOIN p USING (cell) LEFT JOIN b USING (cell) LEFT JOIN h USING (cell))
"""  # fmt: skip


@register("j3_j4_f8_asset_star", STAR + "SELECT * FROM star WHERE px > 0 OR bld > 0 OR road > 0 OR health > 0")
def j3_j4_f8_asset_star(s, d):
    e = a.exposure(s, d)
    k = table(s, d, "lineitem").groupBy(grid.cell_of(a.lon(F.col("l_orderkey")), a.lat(F.col("l_partkey")), a.COARSE).alias("cell")).agg(F.count("*").alias("px"))
    b = e.groupBy("cell").agg(F.sum("bld_count").alias("bld"), F.sum("road_km").alias("road"))
    h = e.where("health_count > 2").groupBy("cell").agg(F.sum("health_count").alias("health"))
    star = assets.assemble(e.groupBy("cell").agg(F.min("adm2_id").alias("adm2_id")), a.lookup(s, d).select("adm2_id", "nombre"), {"px": k, "b": b, "h": h})
    return assets.non_empty(star, ["px", "bld", "road", "health"])


@register("a15_asset_summary", EXP + "SELECT count(*) AS cells, sum(pop_total::DECIMAL(28,6))::DOUBLE AS pop_total, sum(bld_count)::BIGINT AS bld_count, count(DISTINCT adm2_id) AS municipalities, count(flags_calidad) AS flagged FROM exposure")
def a15_asset_summary(s, d):
    return assets.summary(a.exposure(s, d))


@register("a16_municipality_dictionary", PT + "SELECT lpad(c_nationkey::VARCHAR, 5, '0') AS adm2_id, min('M' || c_nationkey) AS name, round(sum(lon * (1 + id % 3)) / sum(1 + id % 3), 6) AS lon, round(sum(lat * (1 + id % 3)) / sum(1 + id % 3), 6) AS lat FROM points GROUP BY 1")
def a16_municipality_dictionary(s, d):
    p = a.customer_points(s, d)
    return assets.dictionary(p.select(F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("adm2_id"), F.concat(F.lit("M"), "c_nationkey").alias("name"), "lon", "lat", (1 + F.col("id") % 3).alias("area")))


@register("a17_q9_extent", PT + "SELECT min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north, min(lon) >= -119 AND min(lat) >= -57.5 AND max(lon) <= -32 AND max(lat) <= 33 AS inside FROM points")
def a17_q9_extent(s, d):
    return assets.extent(a.customer_points(s, d), *geo.REGION)


@register("a18_q10_duplicate_keys", EXP + "SELECT cell, count(*) AS n FROM exposure GROUP BY cell HAVING count(*) > 1")
def a18_q10_duplicate_keys(s, d):
    return assets.duplicates(a.exposure(s, d), ["cell"])


@register("a39_prorated", EXP + ", f AS (SELECT cell, adm2_id, bld_count / sum(bld_count) OVER (PARTITION BY cell)::DOUBLE AS frac_area FROM exposure), v AS (SELECT cell, sum(built_m2) AS value FROM exposure GROUP BY cell) SELECT adm2_id, round(sum(value * frac_area), 6) AS value FROM f JOIN v USING (cell) GROUP BY 1")
def a39_prorated(s, d):
    from pyspark.sql import Window

    e = a.exposure(s, d)
    f = e.select("cell", "adm2_id", (F.col("bld_count") / F.sum("bld_count").over(Window.partitionBy("cell"))).alias("frac_area"))
    return assets.prorate(e.groupBy("cell").agg(F.sum("built_m2").alias("value")), f)


@register("a39_bad_fractions", EXP + ", f AS (SELECT cell, bld_count / 10.0::DOUBLE AS x FROM exposure) SELECT cell FROM f GROUP BY cell HAVING abs(sum(x) - 1) > 1e-6 OR min(x) < 0 OR max(x) > 1")
def a39_bad_fractions(s, d):
    return assets.bad_fractions(a.exposure(s, d).select("cell", "adm2_id", (F.col("bld_count") / 10).alias("frac_area")))


@register("a31_source_digest", "SELECT p_brand AS source, sha256(string_agg(p_name || '  ' || sha256(p_partkey::VARCHAR), chr(10) ORDER BY p_name || '  ' || sha256(p_partkey::VARCHAR))) AS digest FROM part GROUP BY 1")
def a31_source_digest(s, d):
    return assets.source_digest(table(s, d, "part").select(F.col("p_brand").alias("source"), F.col("p_name").alias("name"), F.sha2(F.col("p_partkey").cast("string"), 256).alias("sha256")))


@register("a32_recipe_fingerprint", "SELECT p_size AS recipe, substr(sha256(string_agg(p_partkey || '|' || p_brand || '|' || p_name || '|' || p_type, chr(10) ORDER BY p_partkey || '|' || p_brand || '|' || p_name || '|' || p_type)), 1, 16) AS fingerprint FROM part GROUP BY 1")
def a32_recipe_fingerprint(s, d):
    return assets.fingerprint(table(s, d, "part").select(F.col("p_size").alias("recipe"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("layer"), F.col("p_name").alias("url"), F.col("p_type").alias("license")))


@register("j24_q14_builds_compared", """WITH o AS (SELECT l_returnflag || l_linestatus AS layer, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS total, l_orderkey % 2 AS half FROM lineitem GROUP BY 1, 3)
SELECT a.layer, a.total AS before, b.total AS after, round((b.total - a.total) * 100 / a.total, 4) AS pct, round((b.total - a.total) * 100 / a.total, 4) BETWEEN -1.0 AND 5.0 AS ok FROM o a JOIN o b USING (layer) WHERE a.half = 0 AND b.half = 1 AND a.total <> 0""")  # fmt: skip
def j24_q14_builds_compared(s, d):
    li = table(s, d, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("layer"), (F.col("l_orderkey") % 2).alias("half")).agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total"))
    return assets.compared(li.where("half = 0"), li.where("half = 1"), 1.0, 5.0)


@register("s18_tiles", "SELECT x AS lon, y AS lat FROM range(-120, -30, 3) a(x), range(-60, 34, 3) b(y) WHERE x >= -120 AND x <= -33 AND y <= 33")
def s18_tiles(s, d):
    return assets.tiles(-119, -58, -32, 33, 3, s)


@register("u1_j9_unplaced_cells", EXP + f", c AS (SELECT DISTINCT {a.cell_sql(a.lon_sql('event_id'), a.lat_sql('user_id'), -2)} AS cell FROM events UNION SELECT {a.cell_sql(a.lon_sql('s_suppkey'), a.lat_sql('s_suppkey'), -2)} FROM supplier) SELECT cell FROM c WHERE cell NOT IN (SELECT cell FROM exposure)")
def u1_j9_unplaced_cells(s, d):
    k = F.col("s_suppkey")
    both = table(s, d, "events").select(a._event_cell(a.COARSE).alias("cell")).union(table(s, d, "supplier").select(grid.cell_of(a.lon(k), a.lat(k), a.COARSE).alias("cell"))).distinct()
    return both.join(a.exposure(s, d), "cell", "left_anti")


@register("u2_a14_partials_summed", "SELECT half, sum(n)::BIGINT AS n FROM (SELECT c_nationkey AS half, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, count(*) FROM supplier GROUP BY 1) GROUP BY 1")
def u2_a14_partials_summed(s, d):
    one = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("half")).agg(F.count("*").alias("n"))
    return one.unionByName(table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("half")).agg(F.count("*").alias("n"))).groupBy("half").agg(F.sum("n").alias("n"))


# shapes: hexagon-like rings around suppliers, a hole of the same shape at half the size in every third
_CORNERS = [(2.0, 0.0), (1.0, 1.7), (-1.0, 1.7), (-2.0, 0.0), (-1.0, -1.7), (1.0, -1.7)]


def shapes_sql(scale: float = 1.0) -> str:
    sides = list(zip(_CORNERS, _CORNERS[1:] + _CORNERS[:1], strict=True))
    part = lambda k: ", ".join(f"{{'x1': {p[0] * k}, 'y1': {p[1] * k}, 'x2': {q[0] * k}, 'y2': {q[1] * k}}}" for p, q in sides)
    return f"""edges AS (SELECT shape, cx + e.x1::DOUBLE AS x1, cy + e.y1::DOUBLE AS y1, cx + e.x2::DOUBLE AS x2, cy + e.y2::DOUBLE AS y2 FROM (
      SELECT s_suppkey AS shape, {a.lon_sql("s_suppkey")} AS cx, {a.lat_sql("s_suppkey")} AS cy, unnest([{part(scale)}]) AS e FROM supplier
      UNION ALL SELECT s_suppkey, {a.lon_sql("s_suppkey")}, {a.lat_sql("s_suppkey")}, unnest([{part(scale / 2)}]) FROM supplier WHERE s_suppkey % 3 = 0))"""


def shapes(s, d, scale: float = 1.0):
    k = F.col("s_suppkey")

    def ring(size: float):
        corner = [F.struct((a.lon(k) + x * size).alias("x"), (a.lat(k) + y * size).alias("y")) for x, y in _CORNERS + _CORNERS[:1]]
        return F.array(*corner).alias("ring")

    sup = table(s, d, "supplier")
    return polygons.closed_edges(sup.select(k.alias("shape"), ring(scale)).unionByName(sup.where(k % 3 == 0).select(k.alias("shape"), ring(scale / 2))))


_HIT = "sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1"


@register("j12_point_in_polygon", a.with_ctes(a.POINTS_SQL, shapes_sql()) + f"SELECT id, shape FROM points, edges GROUP BY id, shape HAVING {_HIT}")
def j12_point_in_polygon(s, d):
    return polygons.containing(a.customer_points(s, d), shapes(s, d))


@register("j12_polygon_in_polygon", a.with_ctes(shapes_sql()) + f""", big AS (SELECT shape + 1000000 AS shape, x1 * 0 + c.x + (x1 - c.x) * 4 AS x1, c.y + (y1 - c.y) * 4 AS y1, c.x + (x2 - c.x) * 4 AS x2, c.y + (y2 - c.y) * 4 AS y2
  FROM edges JOIN (SELECT s_suppkey AS shape, {a.lon_sql("s_suppkey")} AS x, {a.lat_sql("s_suppkey")} AS y FROM supplier) c USING (shape) WHERE shape % 5 = 1),
every AS (SELECT * FROM edges UNION ALL SELECT * FROM big), corner AS (SELECT DISTINCT shape AS inside, x1 AS lon, y1 AS lat FROM every),
held AS (SELECT inside, lon, lat, shape FROM corner JOIN every ON inside <> shape GROUP BY inside, lon, lat, shape HAVING {_HIT})
SELECT inside AS "inner", shape AS "outer" FROM held GROUP BY inside, shape HAVING count(*) = (SELECT count(*) FROM corner c WHERE c.inside = held.inside)""")  # fmt: skip
def j12_polygon_in_polygon(s, d):
    k = F.col("s_suppkey")
    centre = table(s, d, "supplier").select(k.alias("shape"), a.lon(k).alias("x"), a.lat(k).alias("y"))
    e = shapes(s, d)
    far = lambda c, m: (F.col(m) + (F.col(c) - F.col(m)) * 4).alias(c)
    big = e.where("shape % 5 = 1").join(centre, "shape").select((F.col("shape") + 1000000).alias("shape"), far("x1", "x"), far("y1", "y"), far("x2", "x"), far("y2", "y"))
    return polygons.within_shape(e.unionByName(big))


FILL = a.with_ctes(shapes_sql(), "c AS (SELECT x * 1048576 + y AS cell, (x + 0.5) - 180 AS lon, (y + 0.5) - 90 AS lat FROM range(55, 155) a(x), range(25, 130) b(y))")


@register("j26_u5_polyfill", FILL + f"SELECT shape, cell FROM c, edges GROUP BY shape, cell HAVING {_HIT}")
def j26_u5_polyfill(s, d):
    return polygons.polyfill(shapes(s, d), 0)


@register("s13_f17_contour_footprint", FILL + f", v AS (SELECT 4.0::DOUBLE + shape % 5 AS value, x1, y1, x2, y2 FROM edges), f AS (SELECT value, cell FROM c, v WHERE value >= 5 GROUP BY value, cell HAVING {_HIT}) SELECT cell, max(value) AS mmi FROM f GROUP BY cell")
def s13_f17_contour_footprint(s, d):
    return polygons.footprint(shapes(s, d).withColumn("value", F.lit(4.0) + F.col("shape") % 5), 0)


_D2 = """pow(lon - (x1 + t * (x2 - x1)), 2) + pow(lat - (y1 + t * (y2 - y1)), 2)"""
NEAR = a.with_ctes(a.POINTS_SQL, shapes_sql(), """t AS (SELECT id, shape, x1, y1, x2, y2, lon, lat, CASE WHEN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) > 0 THEN greatest(0.0, least(1.0, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) ELSE 0.0 END::DOUBLE AS t FROM points, edges)""",
  f"near AS (SELECT id, shape, {_D2} AS d2 FROM t WHERE {_D2} <= 0.25 QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_D2}, shape) = 1)")


@register("j13_j15_nearest_within", NEAR + "SELECT id, shape, round(d2, 9) AS d2 FROM near")
def j13_j15_nearest_within(s, d):
    return polygons.nearest_within(a.customer_points(s, d), shapes(s, d), 0.5, cut=shared_cut(s))


@register("j14_j16_coast_rescue", NEAR + f", abroad AS (SELECT id FROM points, edges WHERE shape % 7 = 0 GROUP BY id, shape HAVING {_HIT}) SELECT id, shape, round(d2, 9) AS d2 FROM near WHERE id NOT IN (SELECT id FROM abroad)")
def j14_j16_coast_rescue(s, d):
    e = shapes(s, d)
    return polygons.rescue(a.customer_points(s, d), e, e.where("shape % 7 = 0"), 0.5, cut=shared_cut(s))


@register("shape_areas", a.with_ctes(shapes_sql()) + "SELECT shape, round(abs(sum(x1 * y2 - x2 * y1)) / 2, 6) AS area, round(sum((x1 * y2 - x2 * y1) * (x1 + x2)) / (3 * sum(x1 * y2 - x2 * y1)), 6) AS lon, round(sum((x1 * y2 - x2 * y1) * (y1 + y2)) / (3 * sum(x1 * y2 - x2 * y1)), 6) AS lat FROM edges GROUP BY shape")
def shape_areas(s, d):
    return polygons.signed_areas(shapes(s, d))
