"""Remaining operators: catalogue pruning, place names, instants, cycles, sampling between lattice points."""

from __future__ import annotations

from pyspark.sql import functions as F

from lahar.functions import geo, text
from lahar.operators import assets, events
from lahar.operators.ranking import placed
from lahar.plans import adapter as a
from lahar.plans.impact_queries import HIT_SQL, hit
from lahar.plans.shared import shared_cut
from lahar.session import table

Q, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _boxes(s, d):
    k = F.col("s_suppkey")
    box = F.struct(a.lon(k).alias("xmin"), a.lat(k).alias("ymin"), (a.lon(k) + k % 5).alias("xmax"), (a.lat(k) + k % 3).alias("ymax"))
    return table(s, d, "supplier").select(k.alias("file"), box.alias("bbox"))


_B = f"SELECT s_suppkey AS file, {a.lon_sql('s_suppkey')} AS xmin, {a.lat_sql('s_suppkey')} AS ymin, {a.lon_sql('s_suppkey')} + s_suppkey % 5 AS xmax, {a.lat_sql('s_suppkey')} + s_suppkey % 3 AS ymax FROM supplier"


@register("s2_s3_f5_catalog_files", f"SELECT file FROM ({_B}) WHERE xmin <= -60 AND xmax >= -90 AND ymin <= 10 AND ymax >= -20")
def s2_s3_f5_catalog_files(s, d):
    return _boxes(s, d).where(geo.boxes_intersect(F.col("bbox"), -90.0, -20.0, -60.0, 10.0)).select("file")


@register("f4_corner_pruning", f"SELECT file FROM ({_B}) WHERE xmin BETWEEN -90 AND -60 AND ymin BETWEEN -20 AND 10")
def f4_corner_pruning(s, d):
    return _boxes(s, d).where(F.col("bbox.xmin").between(-90, -60) & F.col("bbox.ymin").between(-20, 10)).select("file")


@register("f10_neighbour_land", "SELECT n_nationkey FROM nation WHERE n_name IS NOT NULL AND n_nationkey <> 3 AND n_regionkey % 2 = 1")
def f10_neighbour_land(s, d):
    n = table(s, d, "nation")
    return n.where(F.col("n_name").isNotNull() & (F.col("n_nationkey") != 3) & (F.col("n_regionkey") % 2 == 1)).select("n_nationkey")


@register("j5_j11_cells_without_name", HIT_SQL + "SELECT DISTINCT adm2_id FROM exposure WHERE adm2_id NOT IN (SELECT adm2_id FROM lookup WHERE adm1_id = '1')")
def j5_j11_cells_without_name(s, d):
    return a.exposure(s, d).select("adm2_id").distinct().join(a.lookup(s, d).where("adm1_id = '1'"), "adm2_id", "left_anti")


@register("o5_cells_by_intensity", HIT_SQL + "SELECT cell, mmi, rank() OVER (ORDER BY mmi DESC) AS place FROM intensity")
def o5_cells_by_intensity(s, d):
    return placed(a.intensity(s, d).select("cell", "mmi"), [F.desc("mmi")], "place", shared_cut(s), ties=True)


@register("a5_named_binding", HIT_SQL + "SELECT coalesce(sum(pop_total::DECIMAL(28,6)), 0)::DOUBLE AS pop, max(mmi) AS mmi_max FROM hit WHERE mmi > 99")
def a5_named_binding(s, d):
    return hit(s, d).where("mmi > 99").agg(F.coalesce(F.sum(F.col("pop_total").cast("decimal(28,6)")), F.lit(0)).cast("double").alias("pop"), F.max("mmi").alias("mmi_max"))


#: Places of a feed, and what they read in Spanish.
PLACES = {
    "35 km NNW of Arica, Chile": "35 km al NNO de Arica, Chile",
    "7km E of San Isidro, Peru": "7 km al E de San Isidro, Perú",
    "41 km wsw of Santiago, Panama": "41 km al OSO de Santiago, Panamá",
    "5 km NNS of Lugar, Haiti": "5 km NNS of Lugar, Haití",
    "Near the coast of Guatemala": "Cerca de la costa de Guatemala",
    "off the coast of southern Mexico": "Cerca de la costa del sur de México",
    "Near the coast of Ancon, Peru": "Cerca de la costa de Ancon, Perú",
    "Honduras region": "Región de Honduras",
    "Caribbean Sea region": "Región del mar Caribe",
    "Windward Islands region": "Región de las islas de Barlovento",
    "Easter Island, Chile region": "Región de la isla de Pascua, Chile",
    "Chile-Argentina border region": "Zona fronteriza Chile-Argentina",
    "Brazil - southern Suriname border region": "Zona fronteriza Brasil-sur de Surinam",
    "west of Costa Rica": "Al oeste de Costa Rica",
    "southeast of Easter Island": "Al sureste de la isla de Pascua",
    "north of Puerto Azul, Belize": "Al norte de Puerto Azul, Belice",
    "1939 Chillan, Chile Earthquake": "Terremoto de Chillan, Chile (1939)",
    "northeastern Brazil": "Noreste de Brasil",
    "south central Chile": "Centro-sur de Chile",
    "western Caribbean Sea": "Oeste del mar Caribe",
    "Scotia Sea": "Mar de Escocia",
    "North Atlantic Ocean": "Atlántico Norte",
    "Belize": "Belice",
    "Tumbes, Peru": "Tumbes, Perú",
    "eastern Nowhere": "eastern Nowhere",
    "region": "region",
    " \t ": "",
}


@register("text_places", f"""SELECT c_custkey, [{", ".join(f"'{x}'" for x in PLACES.values())}][c_custkey % {len(PLACES)} + 1] AS place,
  CASE WHEN c_custkey < 16 THEN ['cero','uno','dos','tres','cuatro','cinco','seis','siete','ocho','nueve','diez','once','doce','trece','catorce','quince'][c_custkey + 1] ELSE c_custkey::VARCHAR END AS words FROM customer""")  # fmt: skip
def text_places(s, d):
    k = F.col("c_custkey")
    raw = F.element_at(F.array(*[F.lit(x) for x in PLACES]), (k % len(PLACES) + 1).cast("int"))
    return table(s, d, "customer").select("c_custkey", text.place_es(raw).alias("place"), text.in_words(k).alias("words"))


@register("date_instants", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, date_trunc('second', ts) AS again FROM events")
def date_instants(s, d):
    iso = text.iso_of_millis(F.unix_millis(F.col("ts").cast("timestamp")))
    return table(s, d, "events").select("event_id", iso.alias("iso"), text.instant(iso).cast("timestamp_ntz").alias("again"))


@register("s15_model_cycles", "SELECT n_nationkey, unnest(generate_series(TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 18 HOUR, TIMESTAMP '2024-01-02 00:00:00', INTERVAL 6 HOUR)) AS cycle FROM nation")
def s15_model_cycles(s, d):
    end = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return table(s, d, "nation").select("n_nationkey", F.explode(F.sequence(end - F.expr("interval 18 hours"), end, F.expr("interval 6 hours"))).alias("cycle"))


@register("bilinear_sample", f"""WITH g AS (SELECT (x - 60)::DOUBLE AS gx, (y - 58)::DOUBLE AS gy, ((x * 7 + y * 13) % 50)::DOUBLE AS v FROM range(-60, 40) a(x), range(0, 95) b(y)),
p AS (SELECT c_custkey AS id, {a.lon_sql("c_custkey")} AS lon, {a.lat_sql("c_custkey")} AS lat FROM customer)
SELECT id, round(sum(v * (1 - abs(lon - gx)) * (1 - abs(lat - gy))), 6) AS v FROM p JOIN g ON gx IN (floor(lon), floor(lon) + 1) AND gy IN (floor(lat), floor(lat) + 1) GROUP BY id""")  # fmt: skip
def bilinear_sample(s, d):
    g = s.range(-60, 40).select(F.col("id").alias("x")).select("x", F.explode(F.sequence(F.lit(0), F.lit(94))).alias("y"))
    g = g.select((F.col("x") - 60).alias("gx"), (F.col("y") - 58).cast("long").alias("gy"), (F.col("x") * 7 + F.col("y") * 13).alias("raw"))
    g = g.select("gx", "gy", (F.col("raw") % 50).cast("double").alias("v"))
    at = lambda c: F.explode(F.array(F.floor(c), F.floor(c) + 1))
    p = a.customer_points(s, d).select("id", "lon", "lat", at("lon").alias("gx")).select("*", at("lat").alias("gy"))
    part = F.col("v") * (1 - F.abs(F.col("lon") - F.col("gx"))) * (1 - F.abs(F.col("lat") - F.col("gy")))
    return p.join(g, ["gx", "gy"]).groupBy("id").agg(F.round(F.sum(part), 6).alias("v"))


@register("emb_extension", "SELECT vec_id, len(embedding) AS n, label FROM embeddings")
def emb_extension(s, d):
    return table(s, d, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("n"), "label")


@register("t8_late_revisions", a.with_ctes(a.PRODUCTS_SQL) + """, live AS (SELECT event, arg_max(contributor, (updated, version)) AS contributor, arg_max(version, (updated, version)) AS version FROM products GROUP BY event),
states AS (SELECT n_nationkey::BIGINT AS event, CASE WHEN n_nationkey % 7 <> 0 THEN TIMESTAMP '2024-06-01 00:00:00' - n_nationkey * INTERVAL 5 DAY END AS origin, 'Brand#' || (n_nationkey % 5 + 1) || '1' AS contributor, (n_nationkey % 12)::INT AS version FROM nation)
SELECT event, s.contributor || ' ' || s.version AS before, live.contributor || ' ' || live.version AS after FROM states s JOIN live USING (event)
WHERE origin >= TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 90 DAY AND live.version > 0 AND (live.contributor <> s.contributor OR live.version > s.version)""")  # fmt: skip
def t8_late_revisions(s, d):
    k = F.col("n_nationkey")
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    last = F.struct("updated", "version")
    live = a.products(s, d).groupBy("event").agg(F.max_by("contributor", last).alias("contributor"), F.max_by("version", last).alias("version"))
    states = table(s, d, "nation").select(k.cast("long").alias("event"), F.when(k % 7 != 0, now - F.make_interval(days=(k * 5).cast("int"))).alias("origin"), F.concat(F.lit("Brand#"), (k % 5 + 1).cast("string"), F.lit("1")).alias("contributor"), (k % 12).cast("int").alias("version"))
    return events.late_revisions(states, live, now)


@register("q14_build_findings", HIT_SQL + """, layers AS (SELECT unnest(['pop_total', 'bld_count', 'built_m2', 'road_km', 'health_count', 'edu_count']) AS layer, unnest([sum(pop_total), sum(bld_count), sum(built_m2), sum(road_km), sum(health_count), sum(edu_count)]) AS total FROM exposure),
grown AS (SELECT layer, total * CASE layer WHEN 'pop_total' THEN 1.04 WHEN 'bld_count' THEN 1.2 WHEN 'built_m2' THEN 0.85 WHEN 'road_km' THEN 0 WHEN 'health_count' THEN 0.75 ELSE 2.5 END AS total FROM layers),
r AS (SELECT layer, g.total AS after, (g.total - l.total) / l.total AS share FROM layers l JOIN grown g USING (layer) WHERE l.total <> 0)
SELECT layer, CASE WHEN after = 0 THEN 'emptied' WHEN share < 0 THEN 'fell' ELSE 'rose' END AS finding FROM r
WHERE after = 0 OR (layer = 'pop_total' AND abs(share) > 0.03) OR (layer IN ('bld_count', 'built_m2', 'road_km') AND (share < -0.1 OR share > 0.3)) OR (layer IN ('health_count', 'edu_count') AND (share < -0.3 OR share > 1))""")  # fmt: skip
def q14_build_findings(s, d):
    names = ("pop_total", "bld_count", "built_m2", "road_km", "health_count", "edu_count")
    sums = a.exposure(s, d).agg(*[F.sum(c).cast("double").alias(c) for c in names])
    old = sums.unpivot([], list(names), "layer", "total")
    factor = F.create_map(*[F.lit(x) for kv in zip(names, (1.04, 1.2, 0.85, 0.0, 0.75, 2.5), strict=True) for x in kv])
    return assets.build_findings(old, old.withColumn("total", F.col("total") * F.element_at(factor, F.col("layer"))))


_Z = "(40680631590769.0::DOUBLE * (1 - e2) / 2 * (x / (1 - e2 * x * x) + ln((1 + sqrt(e2) * x) / (1 - sqrt(e2) * x)) / (2 * sqrt(e2))))"


@register("a12_building_area", a.with_ctes(a.POINTS_SQL) + f""", e AS (SELECT 1 / 298.257223563::DOUBLE * (2 - 1 / 298.257223563::DOUBLE) AS e2),
b AS (SELECT id, lon, lat, 0.0002 + id % 7 * 0.0001 AS w FROM points), z AS (SELECT id, lon, lat, w, e2, sin(radians(lat)) AS x FROM b, e UNION ALL SELECT id, lon, lat, w, e2, sin(radians(lat + w)) FROM b, e),
m AS (SELECT id, lon, lat, w, abs(max({_Z}) - min({_Z})) * radians(w) AS m2 FROM z GROUP BY id, lon, lat, w)
SELECT {a.cell_sql("lon + w / 2", "lat + w / 2", -2)} AS cell, count(*) AS buildings, round(sum(m2), 1) AS m2 FROM m GROUP BY 1""")  # fmt: skip
def a12_building_area(s, d):
    """Square buildings given as (lat, lon) pairs."""
    from lahar.operators import polygons

    w = F.lit(0.0002) + F.col("id") % 7 * 0.0001
    at = lambda dy, dx: F.struct((F.col("lat") + w * dy).alias("x"), (F.col("lon") + w * dx).alias("y"))
    rings = a.customer_points(s, d).select(F.col("id").alias("shape"), F.array(at(0, 0), at(0, 1), at(1, 1), at(1, 0), at(0, 0)).alias("ring"))
    return assets.building_area(polygons.closed_edges(rings), -2, flipped=True)


@register("cells_boundary", HIT_SQL + """, c AS (SELECT DISTINCT floor(cell / 1048576)::BIGINT AS x, (cell % 1048576)::BIGINT AS y FROM exposure),
b AS (SELECT x AS ix, y AS iy, false AS upright FROM c UNION ALL SELECT x, y + 1, false FROM c UNION ALL SELECT x, y, true FROM c UNION ALL SELECT x + 1, y, true FROM c)
SELECT ix, iy, upright FROM b GROUP BY ALL HAVING count(*) = 1""")
def cells_boundary(s, d):
    return assets.boundary(a.exposure(s, d))


@register("wkt_centroids", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey + 0.5 END AS lon, CASE WHEN s_suppkey % 4 < 2 THEN -1.25 END AS lat FROM supplier")
def wkt_centroids(s, d):
    k = F.col("s_suppkey")
    text_ = F.when(k % 4 == 0, F.concat(F.lit("POINT ("), (k + 0.5).cast("string"), F.lit(" -1.25)"))).when(k % 4 == 1, F.concat(F.lit(" point("), (k + 0.5).cast("string"), F.lit("  -1.25 ) "))).when(k % 4 == 2, "  ").otherwise("POINT EMPTY")
    p = table(s, d, "supplier").select("s_suppkey", geo.wkt_point(text_).alias("p"))
    return p.select("s_suppkey", "p.lon", "p.lat")
