"""Reports behind their sources, review queues, lists in every order, roll-ups, and round trips of grids in two formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from lahar.operators import assets, events, fires, impact
from lahar.plans import adapter as a
from lahar.plans.event_queries import NOW, now
from lahar.plans.fire_queries import CLUSTERS, SUMMARY, a34_a35_cluster_summary
from lahar.plans.impact_queries import ADM2_SQL, hit
from lahar.plans.io_queries import folder
from lahar.plans.shared import shared_cut
from lahar.session import table
from lahar.sources import readers, writers
from lahar.streaming import state

Q, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


LAG = """WITH r AS (SELECT c_custkey AS event, c_nationkey AS country, CASE WHEN c_custkey % 11 <> 0 THEN 'v' || (c_custkey % 3) END AS manifest, ['us', 'atlas'][1 + c_custkey % 2] AS shake_by, c_custkey % 7 AS shake, 'us' AS ground_by, c_custkey % 4 AS ground FROM customer),
l AS (SELECT o_custkey AS event, count(*) % 8 AS shake, ['us', 'atlas'][1 + max(o_orderkey) % 2] AS shake_by, max(o_orderkey) % 5 AS ground, 'us' AS ground_by FROM orders GROUP BY 1),
m AS (SELECT n_nationkey AS country, CASE WHEN n_nationkey % 6 <> 0 THEN 'v' || (n_nationkey % 3) END AS current FROM nation),
j AS (SELECT r.event, (l.event IS NULL) OR (coalesce(manifest, '') <> '' AND current IS NULL) AS unknown, r.shake > 0 AND l.shake = 0 OR r.ground > 0 AND l.ground = 0 AS gone,
  concat_ws(',', CASE WHEN l.shake > 0 AND (r.shake_by <> l.shake_by OR l.shake > r.shake) THEN 'shake' END, CASE WHEN l.ground > 0 AND l.ground > r.ground THEN 'ground' END, CASE WHEN coalesce(manifest, '') <> '' AND manifest <> current THEN 'manifest' END) AS behind,
  l.shake - r.shake AS shake_gap, l.ground - r.ground AS ground_gap FROM r LEFT JOIN l USING (event) LEFT JOIN m USING (country))
SELECT event, CASE WHEN unknown THEN 'unknown' WHEN gone THEN 'gone' WHEN behind <> '' THEN 'behind' ELSE 'current' END AS outcome, CASE WHEN NOT unknown THEN behind END AS behind, CASE WHEN NOT unknown THEN shake_gap END AS shake_gap, CASE WHEN NOT unknown THEN ground_gap END AS ground_gap FROM j"""  # fmt: skip


@register("j21_report_lag", LAG)
def j21_report_lag(s, d):
    by = lambda k: F.when(k % 2 == 0, "us").otherwise("atlas")
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    version = lambda k: F.concat(F.lit("v"), (k % 3).cast("string"))
    reports = table(s, d, "customer").select(k.alias("event"), F.col("c_nationkey").alias("country"), F.when(k % 11 != 0, version(k)).alias("manifest"), by(k).alias("shake_by"), (k % 7).alias("shake"), F.lit("us").alias("ground_by"), (k % 4).alias("ground"))
    last = F.max("o_orderkey")
    live = table(s, d, "orders").groupBy(F.col("o_custkey").alias("event")).agg((F.count("*") % 8).alias("shake"), by(last).alias("shake_by"), (last % 5).alias("ground")).withColumn("ground_by", F.lit("us"))
    manifests = table(s, d, "nation").select(n.alias("country"), F.when(n % 6 != 0, version(n)).alias("current"))
    return events.report_lag(reports, live, manifests)


STATES = "states AS (SELECT event_id AS event, CASE WHEN event_id % 9 <> 0 THEN ts END AS origin, CASE event_type WHEN 'error' THEN 'descartado' WHEN 'purchase' THEN 'publicado' ELSE 'preliminar' END AS state, CASE WHEN event_id % 8 <> 0 THEN value END AS mag, CASE WHEN event_id % 5 <> 0 THEN (user_id % 40)::DOUBLE END AS people FROM events)"


def _states(s, d):
    k, e = F.col("event_id"), F.col("event_type")
    kind = F.when(e == "error", "descartado").when(e == "purchase", "publicado").otherwise("preliminar")
    return table(s, d, "events").select(k.alias("event"), F.when(k % 9 != 0, F.col("ts")).alias("origin"), kind.alias("state"), F.when(k % 8 != 0, F.col("value")).alias("mag"), F.when(k % 5 != 0, (F.col("user_id") % 40).cast("double")).alias("people"))


@register("o10_review_queue", f"WITH {STATES} SELECT event, origin FROM states WHERE state <> 'descartado' AND origin >= {NOW} + INTERVAL 75 DAY - INTERVAL 90 DAY")
def o10_review_queue(s, d):
    return events.review_queue(_states(s, d), now() + F.make_interval(days=F.lit(75))).select("event", "origin")


@register("o9_events_in_every_order", f"""WITH {STATES}
SELECT 'date' AS mode, event, row_number() OVER (ORDER BY origin DESC NULLS LAST, event) AS place FROM states
UNION ALL SELECT 'magnitude', event, row_number() OVER (ORDER BY coalesce(mag, 0) DESC, event) FROM states
UNION ALL SELECT 'people', event, row_number() OVER (ORDER BY coalesce(people, 0) DESC, event) FROM states""")  # fmt: skip
def o9_events_in_every_order(s, d):
    rows = _states(s, d).select("event", "origin", "mag", "people")
    parts = [events.listed(rows, m, shared_cut(s)).select(F.lit(m).alias("mode"), "event", "place") for m in events.ORDERS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_FIRES = "SELECT cluster, personas AS people, ultima_utc AS last, celdas AS area, frp_max AS energy FROM summary"


@register("o9_fires_in_every_order", CLUSTERS + ", summary AS (SELECT * FROM (" + SUMMARY.replace(", b AS", "WITH b AS", 1) + f")), c AS ({_FIRES})\n" + " UNION ALL ".join(
  f"SELECT '{m}' AS mode, cluster, row_number() OVER (ORDER BY {c} DESC NULLS LAST, cluster) AS place, (SELECT count(*) FROM c) AS of FROM c QUALIFY place <= 60" for m, c in fires.ORDERS.items()))
def o9_fires_in_every_order(s, d):
    rows = a34_a35_cluster_summary(s, d).select("cluster", F.col("personas").alias("people"), F.col("ultima_utc").alias("last"), F.col("celdas").alias("area"), F.col("frp_max").alias("energy"))
    rows = shared_cut(s)(rows)
    parts = [fires.listed(rows, m).select(F.lit(m).alias("mode"), "cluster", "place", "of") for m in fires.ORDERS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register("q20_publication_bucket", "SELECT p_partkey, CASE WHEN p_partkey % 100 >= 75 AND p_size / 50.0 >= 0.5 THEN CASE WHEN p_partkey % 3 = 0 THEN 'nc/' ELSE 'core/' END END AS bucket FROM part")
def q20_publication_bucket(s, d):
    k = F.col("p_partkey")
    recall = F.greatest(F.col("p_size") / 50 + 0.25, F.lit(0.0))
    return table(s, d, "part").select(k, events.publication_bucket(k % 100 / 100, recall, F.when(k % 3 == 0, "nc").otherwise("limpia")).alias("bucket"))


@register("t12_weighted_cadence", """WITH h AS (SELECT user_id AS source, event_id, ts, event_id % 4 AS polls FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 200),
g AS (SELECT source, date_diff('microsecond', lag(ts) OVER (PARTITION BY source ORDER BY ts, event_id), ts) / 60e6 AS gap, greatest(polls, 1) AS polls FROM h)
SELECT source, count(*) AS n, round(quantile_cont(gap / polls, 0.5), 1) AS p50, round(quantile_cont(gap / polls, 0.9), 1) AS p90, round(max(gap / polls), 1) AS worst FROM g WHERE gap > 0 AND gap <= 1440 GROUP BY 1""")  # fmt: skip
def t12_weighted_cadence(s, d):
    """The newest 200 heartbeats keep the polls that each stands for, and the cadence is told of these."""
    beats = table(s, d, "events").select(F.col("user_id").alias("source"), "ts", F.col("event_id").alias("id"), (F.col("event_id") % 4).alias("polls"))
    return events.cadence(state.capped_history(beats, 200))


@register("r2_ranked_figures", ADM2_SQL + ", g AS (SELECT adm2_id, CASE WHEN adm2_id::INT % 2 = 0 THEN 0 ELSE pop_total_6 END AS six, pop_total_7 AS seven FROM adm2) SELECT adm2_id, band::INT AS band, CASE WHEN band = 7 OR six = 0 THEN seven ELSE six END AS figure FROM g, (VALUES (6), (7)) b(band) WHERE CASE WHEN band = 7 OR six = 0 THEN seven ELSE six END > 0")
def r2_ranked_figures(s, d):
    """Every second municipality has no figure at six, as reports of an earlier form have none."""
    rows = impact.by_municipality(hit(s, d)).withColumn("pop_total_6", F.when(F.col("adm2_id").cast("int") % 2 == 0, 0.0).otherwise(F.col("pop_total_6")))
    bands = rows.withColumn("band", F.explode(F.array(F.lit(6), F.lit(7))))
    return bands.select("adm2_id", "band", impact.ranked_figure(F.col("band")).alias("figure")).where("figure > 0")


RASTER = "raster AS (SELECT floor((lon + 119) / 0.5)::BIGINT AS px, floor((33 - lat) / 0.5)::BIGINT AS py, max(value) AS v FROM pixels GROUP BY 1, 2)"


@register("s8_sampled_layers", a.with_ctes(a.PIXELS_SQL, a.POINTS_SQL, RASTER) + "SELECT id, coalesce(v, 0) AS landslide, 0.0::DOUBLE AS liquefaction FROM points LEFT JOIN raster ON floor((lon + 119) / 0.5)::BIGINT = px AND floor((33 - lat) / 0.5)::BIGINT = py")
def s8_sampled_layers(s, d):
    p = a.pixels(s, d)
    raster = p.groupBy(F.floor((F.col("lon") + 119) / 0.5).cast("long").alias("px"), F.floor((F.lit(33) - F.col("lat")) / 0.5).cast("long").alias("py")).agg(F.max("value").alias("value"))
    layers = {"landslide": raster, "liquefaction": None}
    return assets.sampled_layers(a.customer_points(s, d), layers, -119.0, 33.0, 0.5, 0.5).select("id", *layers)


_COVER = "cov AS (SELECT n_nationkey AS country, coalesce(m, 0) > 0 AS built, coalesce(m, 0) AS measured, coalesce(r, 0) AS reference, CASE WHEN m <> 0 AND r <> 0 THEN round((m - r) * 100.0::DOUBLE / r, 2) END AS deviation_pct FROM nation LEFT JOIN (SELECT c_nationkey AS k, count(*) FILTER (c_acctbal > 5000) AS m FROM customer GROUP BY 1) ON k = n_nationkey LEFT JOIN (SELECT s_nationkey AS k2, count(*) * 5 AS r FROM supplier GROUP BY 1) ON k2 = n_nationkey)"


def _coverage(s, d):
    measured = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("country")).agg(F.count_if(F.col("c_acctbal") > 5000).alias("measured"))
    official = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("country")).agg((F.count("*") * 5).alias("reference"))
    every = table(s, d, "nation").select(F.col("n_nationkey").alias("country"))
    return events.coverage(every.join(measured, "country", "left").join(official, "country", "left"))


@register("a29_coverage", f"WITH {_COVER} SELECT * FROM cov")
def a29_coverage(s, d):
    return _coverage(s, d)


@register("a29_coverage_summary", f"WITH {_COVER} SELECT count(*) AS countries, count(*) FILTER (built) AS built, coalesce(sum(measured) FILTER (built), 0)::BIGINT AS people, max(abs(deviation_pct)) FILTER (built) AS worst_pct FROM cov")
def a29_coverage_summary(s, d):
    return events.coverage_summary(_coverage(s, d))


@register("a30_catalogue", "SELECT count(*) AS reports, count(*) FILTER (NOT coalesce(b, false)) AS live, count(*) FILTER (b) AS backtests, count(DISTINCT nullif(country, '')) AS countries, count(*) FILTER (coalesce(six, 0) = 0) AS none_six, count(*) FILTER (coalesce(seven, 0) = 0) AS none_seven FROM (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 4 = 0 END AS b, CASE WHEN c_nationkey % 9 = 0 THEN '' ELSE c_nationkey::VARCHAR END AS country, c_custkey % 6 AS six, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 3 END AS seven FROM customer)")
def a30_catalogue(s, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(s, d, "customer").select(F.when(k % 10 != 0, k % 4 == 0).alias("backtest"), F.when(n % 9 == 0, "").otherwise(n.cast("string")).alias("country"), (k % 6).alias("six"), F.when(k % 5 != 0, k % 3).alias("seven"))
    return events.catalogue(rows, ("six", "seven"))


CONTOURS = """WITH f AS (SELECT s_suppkey, 4.0::DOUBLE + s_suppkey % 5 AS value, 3 + s_suppkey % 4 AS n FROM supplier WHERE s_suppkey % 4 <> 0), g AS (SELECT *, unnest(range(n)) AS place FROM f)
SELECT value, place::INT AS place, s_suppkey + place % (n - 1) * 0.5::DOUBLE AS x, (place % (n - 1) % 2)::DOUBLE AS y FROM g"""  # fmt: skip


@register("s13_contour_vertices", CONTOURS)
def s13_contour_vertices(s, d):
    """Every vertex of every contour by its place on the line."""
    k = F.col("s_suppkey")
    n = 3 + k % 4
    point = lambda i: F.array(k + i % (n - 1) * 0.5, (i % (n - 1) % 2).cast("double"))
    line = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), point)
    value = (F.lit(4.0) + k % 5).alias("value")
    feature = F.struct(F.struct(value, F.when(k % 4 == 0, "pga").when(k % 4 == 1, "mmi").alias("units")).alias("properties"), F.struct(F.array(line).alias("coordinates")).alias("geometry"))
    texts = table(s, d, "supplier").select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("value"))
    return readers.contours(texts).select("value", F.posexplode("ring").alias("place", "p")).select("value", "place", "p.x", "p.y")


TAGS = {"adm2_id": "#adm2+code", "mmi_max": "#severity", "pop_total_6": "#affected+six"}


@register("k3_figures_in_order", ADM2_SQL + "SELECT row_number() OVER (ORDER BY pop_total_6 DESC, adm2_id)::INT AS place, adm2_id, pop_total_6::DOUBLE AS pop_total_6 FROM adm2")
def k3_figures_in_order(s, d):
    """The rows of a tagged CSV by their place in the file, which has one part."""
    path = folder(s, "csv")
    rows = impact.by_municipality(hit(s, d)).select("adm2_id", "mmi_max", "pop_total_6")
    writers.tagged_csv(rows, TAGS, path, [F.desc("pop_total_6"), F.col("adm2_id")])
    place = (F.monotonically_increasing_id() + 1).cast("int")
    return writers.read_tagged_csv(s, path).coalesce(1).select(place.alias("place"), "adm2_id", F.col("pop_total_6").cast("double").alias("pop_total_6"))


GRID = "slots AS (SELECT p_size, unnest(range(20)) AS j FROM (SELECT DISTINCT p_size FROM part)), known AS (SELECT p_size, p_partkey % 20 AS j, max(p_partkey % 60000) AS v FROM part GROUP BY 1, 2), g AS (SELECT * FROM slots LEFT JOIN known USING (p_size, j))"


def _slots(s, d):
    """For each size of part, a grid of five by four; a slot without a part is null."""
    k = F.col("p_partkey")
    slot = [F.max(F.when(k % 20 == j, k % 60000)) for j in range(20)]
    return table(s, d, "part").groupBy("p_size").agg(F.array(*slot).alias("v"))


@register("s16_xml_grids", f"WITH {GRID} SELECT p_size, (j % 5) * 0.5 - 75 AS lon, 10 - (j // 5) * 0.5 AS lat, coalesce(v, 0) / 8 AS mmi FROM g")
def s16_xml_grids(s, d):
    """Grids written as XML texts and read back."""
    j = F.col("j")
    points = _slots(s, d).select("p_size", F.posexplode("v").alias("j", "v")).select("p_size", (j % 5 * 0.5 - 75).alias("lon"), (10 - F.floor(j / 5) * 0.5).alias("lat"), (F.coalesce("v", F.lit(0)) / 8).alias("mmi"))
    return readers.xml_points(writers.xml_grid(points, "p_size"))


@register("s14_grib2_messages", f"WITH {GRID} SELECT p_size, (j % 5) * 0.5 - 75 AS lon, 10 - (j // 5) * 0.5 AS lat, v / 10 AS value FROM g")
def s14_grib2_messages(s, d):
    """Grids written as GRIB2 messages with a bitmap and read back; points that the bitmap leaves out are null."""
    content = writers.grib2_message(F.col("v"), 5, 4, 10_000_000, 285_000_000, 500_000, 2, 3, ten=1)
    found = readers.grib2_values(_slots(s, d).select(F.col("p_size").cast("string").alias("path"), content.alias("content")))
    return found.select(F.col("file").cast("int").alias("p_size"), "lon", "lat", F.when(~F.isnan("value"), F.col("value")).alias("value"))
