"""Event, quality, text and set queries on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lahar.functions import geo, text
from lahar.operators import assets, events, quality
from lahar.plans import adapter as a
from lahar.plans.impact_queries import HIT_SQL, hit
from lahar.plans.shared import shared_cut
from lahar.session import table

Q, SQL = {}, {}
NOW = "TIMESTAMP '2024-01-30 00:00:00'"


def now():
    return F.lit("2024-01-30 00:00:00").cast("timestamp")


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


QUAKES = f"""quakes AS (SELECT event_id AS event, CASE event_type WHEN 'error' THEN 'quarry blast' ELSE 'earthquake' END AS kind, CASE WHEN event_id % 97 = 0 THEN NULL ELSE 4 + value / 100 END AS mag,
  CASE WHEN event_id % 13 = 0 THEN 10.0 ELSE {a.lon_sql("event_id")} END AS lon, {a.lat_sql("user_id")} AS lat, user_id, ts FROM events)"""


def quakes(s, d):
    k = F.col("event_id")
    return table(s, d, "events").select(
        k.alias("event"), F.when(F.col("event_type") == "error", "quarry blast").otherwise("earthquake").alias("kind"), F.when(k % 97 == 0, None).otherwise(F.lit(4) + F.col("value") / 100).alias("mag"),
        F.when(k % 13 == 0, 10.0).otherwise(a.lon(k)).alias("lon"), a.lat(F.col("user_id")).alias("lat"), "user_id", "ts",
    )


_WHY = "CASE WHEN kind <> 'earthquake' THEN 'not an earthquake' WHEN mag IS NULL OR mag < {m} THEN 'too small' WHEN NOT (lon BETWEEN -119 AND -32 AND lat BETWEEN -57.5 AND 33) THEN 'outside the region' END"


@register("f1_relevance", a.with_ctes(QUAKES) + f"SELECT event, {_WHY.format(m=5.5)} AS reason FROM quakes")
def f1_relevance(s, d):
    return quakes(s, d).select("event", events.irrelevance(*[F.col(c) for c in ("kind", "mag", "lon", "lat")]).alias("reason"))


@register("f2_only_too_small", a.with_ctes(QUAKES) + f"SELECT event FROM quakes WHERE {_WHY.format(m=5.5)} IS NOT NULL AND {_WHY.format(m=0)} IS NULL")
def f2_only_too_small(s, d):
    return quakes(s, d).where(events.only_too_small(*[F.col(c) for c in ("kind", "mag", "lon", "lat")])).select("event")


BEST = a.with_ctes(a.PRODUCTS_SQL, """live AS (SELECT * FROM products WHERE status <> 'DELETE'), who AS (SELECT event, contributor AS b FROM live QUALIFY row_number() OVER (PARTITION BY event ORDER BY weight DESC, contributor) = 1),
best AS (SELECT event, contributor, weight, version, updated FROM live JOIN who USING (event) WHERE contributor = b QUALIFY row_number() OVER (PARTITION BY event ORDER BY updated DESC, version DESC) = 1)""")  # fmt: skip


@register("r8_w5_preferred_products", BEST + "SELECT * FROM best")
def r8_w5_preferred_products(s, d):
    return events.preferred_products(a.products(s, d))


@register("r10_version_changed", BEST + """SELECT event, version > 0 AND (coalesce(o.contributor, '') <> coalesce(best.contributor, '') OR version > coalesce(o.old, 0)) AS changed
FROM best LEFT JOIN (SELECT n_nationkey AS event, 'Brand#' || (n_nationkey % 5 + 1) || '1' AS contributor, n_nationkey % 12 AS old FROM nation) o USING (event)""")  # fmt: skip
def r10_version_changed(s, d):
    k = F.col("n_nationkey")
    old = table(s, d, "nation").select(k.cast("long").alias("event"), F.concat(F.lit("Brand#"), (k % 5 + 1).cast("string"), F.lit("1")).alias("old_by"), (k % 12).alias("old"))
    both = events.preferred_products(a.products(s, d)).join(old, "event", "left")
    return both.select("event", events.version_changed(F.col("old_by"), F.col("old"), F.col("contributor"), F.col("version")).alias("changed"))


@register("r9_content_fallback", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'new' || p_size WHEN p_size % 3 = 1 THEN 'old' || p_size END AS content FROM part")
def r9_content_fallback(s, d):
    size = F.col("p_size")
    p = table(s, d, "part").withColumn("contents", F.map_filter(F.create_map(F.lit("cont_mmi"), F.when(size % 3 == 0, F.concat(F.lit("new"), size)), F.lit("mmi_old"), F.when(size % 3 < 2, F.concat(F.lit("old"), size))), lambda k, v: v.isNotNull()))
    return p.select("p_partkey", events.first_content(F.col("contents"), "cont_mmi", "mmi_old").alias("content"))


@register("r11_known_alerts", "SELECT p_partkey, CASE WHEN x IN ('green','yellow','orange','red') THEN x ELSE '' END AS alert FROM (SELECT p_partkey, ['green','pending','RED','red'][p_partkey % 4 + 1] AS x FROM part)")
def r11_known_alerts(s, d):
    names = F.array(*[F.lit(x) for x in ("green", "pending", "RED", "red")])
    return table(s, d, "part").select("p_partkey", events.known_alert(F.element_at(names, (F.col("p_partkey") % 4 + 1).cast("int"))).alias("alert"))


DECIDE = "SELECT event_id, event_id % 3 = 0 AS has, event_id % 5 = 0 AS changed, event_id % 13 = 0 AS discarded, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 11 END AS age, event_id % 100 AS attempts, event_id % 31 = 0 AS force FROM events"


@register("t6_t7_decision", f"""SELECT event_id, CASE WHEN force AND has THEN 'full' WHEN discarded THEN 'omit' WHEN has AND changed THEN 'full' WHEN has THEN 'omit'
  WHEN age >= 6 OR (age IS NULL AND attempts >= 72) THEN 'exhausted' ELSE 'preliminary' END AS decision FROM ({DECIDE})""")  # fmt: skip
def t6_t7_decision(s, d):
    k = F.col("event_id")
    return table(s, d, "events").select("event_id", events.decide(k % 3 == 0, k % 5 == 0, k % 13 == 0, F.when(k % 7 != 0, k % 11), k % 100, k % 31 == 0).alias("decision"))


@register("t5_redispatch_floor", f"SELECT event_id, CASE WHEN event_id % 4 = 0 THEN true ELSE {NOW} - (ts + INTERVAL 29 DAY) >= INTERVAL 15 MINUTE END AS may FROM events")
def t5_redispatch_floor(s, d):
    last = F.when(F.col("event_id") % 4 != 0, F.col("ts") + F.make_interval(days=F.lit(29)))
    return table(s, d, "events").select("event_id", events.may_dispatch(last, now()).alias("may"))


_STATES = ("detectado", "preliminar", "publicado", "degradado", "descartado")
#: The allowed moves, written out apart from the operator's table.
_MOVES = """('detectado','preliminar'),('detectado','publicado'),('detectado','degradado'),('detectado','descartado'),
('preliminar','preliminar'),('preliminar','publicado'),('preliminar','degradado'),('preliminar','descartado'),
('publicado','publicado'),('publicado','degradado'),('publicado','descartado'),
('degradado','preliminar'),('degradado','publicado'),('degradado','descartado')"""
_ALL_STATES = "(VALUES " + ", ".join(f"('{x}')" for x in _STATES) + ")"


@register("t3_allowed_transitions", f"SELECT o.x AS old, n.x AS new, (o.x, n.x) IN ({_MOVES}) AS ok FROM {_ALL_STATES} o(x), {_ALL_STATES} n(x)")
def t3_allowed_transitions(s, d):
    both = s.createDataFrame([(o, n) for o in _STATES for n in _STATES], "old string, new string")
    return both.withColumn("ok", events.allowed(F.col("old"), F.col("new")))


@register("j20_t2_state_by_any_id", """WITH i AS (SELECT o_orderkey AS event, [o_custkey, o_orderkey % 700, o_custkey + 5] AS ids FROM orders), e AS (SELECT event, unnest(ids) AS known_id, generate_subscripts(ids, 1) AS place FROM i),
h AS (SELECT event, c_mktsegment AS state FROM e JOIN customer ON known_id = c_custkey AND c_custkey % 6 = 0 QUALIFY row_number() OVER (PARTITION BY event ORDER BY place, known_id) = 1)
SELECT event, state FROM i LEFT JOIN h USING (event)""")  # fmt: skip
def j20_t2_state_by_any_id(s, d):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    states = table(s, d, "customer").where("c_custkey % 6 = 0").select(F.col("c_custkey").alias("known_id"), F.col("c_mktsegment").alias("state"))
    return events.by_any_id(table(s, d, "orders").select(o.alias("event"), F.array(c, o % 700, c + 5).alias("ids")), states)


_SOL = "SELECT c_custkey AS event, 5 + (c_custkey % 17) / 10.0::DOUBLE + {dm} AS mag, (c_custkey % 90)::DOUBLE + {dd} AS depth, " + a.lon_sql("c_custkey") + " + {dl} AS lon, " + a.lat_sql("c_custkey") + " AS lat, c_custkey * 37.0::DOUBLE + {dp} AS people FROM customer"
_KM = "asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(n.lat) - radians(o.lat)) / 2), 2) + cos(radians(o.lat)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - o.lon) / 2), 2)))) * 2 * 6371.0::DOUBLE"


@register("r4_change_log", f"""WITH o AS ({_SOL.format(dm=0, dd=0, dl=0, dp=0)}), n AS ({_SOL.format(dm="0.1 * (c_custkey % 2)", dd="0.3 * (c_custkey % 3)", dl="0.02 * (c_custkey % 4 = 0)::INT", dp="(c_custkey % 5) * 1000")}),
b AS (SELECT n.event, round(abs(n.mag - o.mag), 6) >= 0.05 AS m, round(abs(n.depth - o.depth), 6) >= 0.5 AS dp, {_KM} >= 1 AS ep, n.event % 5 <> 0 AS pe FROM o JOIN n ON o.event = n.event)
SELECT event, 'magnitude' AS change FROM b WHERE m UNION ALL SELECT event, 'depth' FROM b WHERE dp UNION ALL SELECT event, 'epicentre' FROM b WHERE ep UNION ALL SELECT event, 'people' FROM b WHERE pe""")  # fmt: skip
def r4_change_log(s, d):
    k = F.col("c_custkey")

    def solution(dm, dd, dl, dp):
        return table(s, d, "customer").select(k.alias("event"), (F.lit(5) + (k % 17) / 10 + dm).alias("mag"), ((k % 90).cast("double") + dd).alias("depth"), (a.lon(k) + dl).alias("lon"), a.lat(k).alias("lat"), (k * 37.0 + dp).alias("people"))

    zero = F.lit(0.0)
    return events.change_log(solution(zero, zero, zero, zero), solution((k % 2) * 0.1, (k % 3) * 0.3, F.when(k % 4 == 0, 0.02).otherwise(0.0), (k % 5) * 1000))


@register("t8_preferred_revisions", BEST + """, states AS (SELECT n_nationkey::BIGINT AS event, CASE WHEN n_nationkey % 7 <> 0 THEN TIMESTAMP '2024-06-01 00:00:00' - n_nationkey * INTERVAL 5 DAY END AS origin, 'Brand#' || (n_nationkey % 5 + 1) || '1' AS contributor, (n_nationkey % 12)::INT AS version FROM nation)
SELECT event, s.contributor || ' ' || s.version AS before, best.contributor || ' ' || best.version AS after FROM states s JOIN best USING (event)
WHERE origin >= TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 90 DAY AND best.version > 0 AND (best.contributor <> s.contributor OR best.version > s.version)""")  # fmt: skip
def t8_preferred_revisions(s, d):
    k = F.col("n_nationkey")
    at = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    origin = F.when(k % 7 != 0, at - F.make_interval(days=(k * 5).cast("int")))
    states = table(s, d, "nation").select(k.cast("long").alias("event"), origin.alias("origin"), F.concat(F.lit("Brand#"), (k % 5 + 1).cast("string"), F.lit("1")).alias("contributor"), (k % 12).cast("int").alias("version"))
    return events.preferred_revisions(states, a.products(s, d), at)


#: A fold by recursion: each solution is joined to the one before it, and a change of contributor starts the log anew.
_FOLD = """WITH RECURSIVE s AS (SELECT o_custkey AS event, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 8 < 6 THEN 'us' ELSE 'atlas' END AS contributor, (o_orderkey % 3)::INT AS version,
    5 + (o_orderkey % 4) * 0.03::DOUBLE AS mag, (o_orderkey % 5) * 0.2::DOUBLE AS depth, 10 + (o_orderkey % 2) * 0.5::DOUBLE AS lon, 5.0::DOUBLE AS lat, (o_orderkey % 6) * 1000.0::DOUBLE AS people FROM orders),
f AS (SELECT event, seq, contributor, version, mag, depth, lon, people, []::STRUCT(seq BIGINT, pos INT, change VARCHAR)[] AS log FROM s WHERE seq = 1 UNION ALL
  SELECT s.event, s.seq, coalesce(s.contributor, f.contributor), s.version, s.mag, s.depth, s.lon, s.people,
    CASE WHEN coalesce(s.contributor <> f.contributor, false) THEN []::STRUCT(seq BIGINT, pos INT, change VARCHAR)[] ELSE f.log END || list_filter([
      {'seq': s.seq, 'pos': 0, 'change': CASE WHEN coalesce(s.contributor <> f.contributor, false) OR s.version <> f.version THEN
        concat_ws(' ', f.contributor, 'v' || f.version) || ' → ' || concat_ws(' ', coalesce(s.contributor, f.contributor), 'v' || s.version) END},
      {'seq': s.seq, 'pos': 1, 'change': CASE WHEN round(abs(s.mag - f.mag), 6) >= 0.05 THEN 'magnitude' END},
      {'seq': s.seq, 'pos': 2, 'change': CASE WHEN round(abs(s.depth - f.depth), 6) >= 0.5 THEN 'depth' END},
      {'seq': s.seq, 'pos': 3, 'change': CASE WHEN s.lon <> f.lon THEN 'epicentre' END},
      {'seq': s.seq, 'pos': 4, 'change': CASE WHEN s.people <> f.people THEN 'people' END}], lambda x: x.change IS NOT NULL)
  FROM f JOIN s ON s.event = f.event AND s.seq = f.seq + 1),
e AS (SELECT event, unnest(log) AS x FROM f QUALIFY row_number() OVER (PARTITION BY event ORDER BY seq DESC) = 1)
SELECT event, row_number() OVER (PARTITION BY event ORDER BY x.seq DESC, x.pos)::INT AS place, x.change AS change FROM e"""


@register("r4_accumulated_log", _FOLD)
def r4_accumulated_log(s, d):
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    by = F.when(k % 9 == 0, None).when(k % 8 < 6, "us").otherwise("atlas")
    seq = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    figures = {"mag": 5 + (k % 4) * F.lit(0.03), "depth": (k % 5) * F.lit(0.2), "lon": 10 + (k % 2) * F.lit(0.5), "lat": F.lit(5.0), "people": (k % 6) * F.lit(1000.0)}
    rows = table(s, d, "orders").select(F.col("o_custkey").alias("event"), seq.alias("seq"), by.alias("contributor"), (k % 3).cast("int").alias("version"), *[v.alias(n) for n, v in figures.items()])
    return events.accumulated_log(rows)


@register("j21_o7_lagging_reports", "WITH l AS (SELECT p_partkey % 200 AS event, max(p_size)::INT AS live FROM part GROUP BY 1) SELECT c_custkey AS event, (c_custkey % 60)::INT AS version, live AS live_version, live - (c_custkey % 60)::INT AS gap FROM customer JOIN l ON c_custkey = event WHERE live > c_custkey % 60")
def j21_o7_lagging_reports(s, d):
    live = table(s, d, "part").groupBy((F.col("p_partkey") % 200).alias("event")).agg(F.max("p_size").alias("live_version"))
    return events.lagging(table(s, d, "customer").select(F.col("c_custkey").alias("event"), (F.col("c_custkey") % 60).cast("int").alias("version")), live)


@register("j22_a24_a25_latency", "SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 1) AS p50, round(quantile_cont(value, 0.95), 1) AS p95, round(max(value), 1) AS worst FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY 1")
def j22_a24_a25_latency(s, d):
    reports = table(s, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"))
    return events.latency(table(s, d, "events").join(reports, "user_id", "left_semi").withColumnRenamed("value", "minutes"), ["event_type"])


@register("a25_latency_by_clock", """WITH r AS (SELECT ts AS origin, CASE WHEN event_id % 7 <> 0 THEN ts + (event_id % 90) * INTERVAL 7 SECOND END AS detected, ts + (event_id % 83 - 2) * INTERVAL 11 SECOND AS published, event_id % 13 = 0 AS backtest FROM events),
m AS (SELECT 'origin' AS clock, date_diff('microsecond', origin, published) / 60e6 AS minutes FROM r WHERE NOT backtest UNION ALL SELECT 'detected', date_diff('microsecond', detected, published) / 60e6 FROM r WHERE NOT backtest)
SELECT clock, count(*) AS n, round(quantile_cont(minutes, 0.5), 1) AS p50, round(quantile_cont(minutes, 0.95), 1) AS p95, round(max(minutes), 1) AS worst FROM m WHERE minutes >= 0 GROUP BY clock""")
def a25_latency_by_clock(s, d):
    k, ts = F.col("event_id"), F.col("ts")
    after = lambda n: ts + F.make_interval(secs=n.cast("decimal(18,6)"))
    detected, published = F.when(k % 7 != 0, after(k % 90 * 7)), after((k % 83 - 2) * 11)
    return events.latency_by_clock(table(s, d, "events").select(ts.alias("origin"), detected.alias("detected"), published.alias("published"), (k % 13 == 0).alias("backtest")))


@register("a26_w2_cadence", """WITH g AS (SELECT user_id AS source, date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 60e6 AS gap, greatest(event_id % 4, 1) AS polls FROM events),
e AS (SELECT source, gap / polls AS each FROM g WHERE gap > 0 AND gap <= 1440)
SELECT source, count(*) AS n, round(quantile_cont(each, 0.5), 1) AS p50, round(quantile_cont(each, 0.9), 1) AS p90, round(max(each), 1) AS worst FROM e GROUP BY 1""")  # fmt: skip
def a26_w2_cadence(s, d):
    return events.cadence(table(s, d, "events").select(F.col("user_id").alias("source"), "ts", F.col("event_id").alias("id"), (F.col("event_id") % 4).alias("polls")))


@register("w6_islands", "SELECT event_id, sum(CASE WHEN h AND NOT coalesce(p, false) THEN 1 ELSE 0 END) OVER (ORDER BY event_id)::BIGINT AS run FROM (SELECT event_id, event_type = 'view' AS h, lag(event_type = 'view') OVER (ORDER BY event_id) AS p FROM events)")
def w6_islands(s, d):
    return events.islands(table(s, d, "events"), [F.col("event_id")], F.col("event_type") == "view", shared_cut(s)).select("event_id", "run")


@register("w3_numbered_posts", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) || '/' || count(*) OVER (PARTITION BY conv_id) AS label FROM conversations")
def w3_numbered_posts(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id")
    place = F.row_number().over(w.orderBy("turn", "role", "text"))
    return table(s, d, "conversations").select("conv_id", "turn", F.concat_ws("/", place, F.count("*").over(w)).alias("label"))


@register("f13_t9_o10_recent_first", f"SELECT event_id AS id, ts FROM events WHERE ts >= {NOW} - INTERVAL 5 DAY")
def f13_t9_o10_recent_first(s, d):
    return events.recent_first(table(s, d, "events").select(F.col("event_id").alias("id"), "ts"), now(), 5, "ts")


@register("u3_upserted", "SELECT k, v, x FROM (SELECT c_custkey AS k, c_custkey % 9 AS v, 'old' AS x, 0 AS side FROM customer UNION ALL SELECT s_suppkey, s_suppkey % 7, 'new', 1 FROM supplier) QUALIFY row_number() OVER (PARTITION BY k ORDER BY v DESC, side DESC) = 1")
def u3_upserted(s, d):
    old = table(s, d, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 9).alias("v"), F.lit("old").alias("x"))
    new = table(s, d, "supplier").select(F.col("s_suppkey").alias("k"), (F.col("s_suppkey") % 7).alias("v"), F.lit("new").alias("x"))
    return events.upserted(old, new, "k", "v")


@register("u4_j23_missing_ids", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders")
def u4_j23_missing_ids(s, d):
    return table(s, d, "customer").select(F.col("c_custkey").alias("id")).subtract(table(s, d, "orders").select(F.col("o_custkey").alias("id")))


LIC = "src AS (SELECT p_size AS asset, p_name || p_partkey AS source, ['public-domain-usgov','public-domain','CC0-1.0','CC-BY-4.0','EC-reuse-attribution','CC-BY-IGO','gov-open-co','ODbL-1.0','CC-BY-SA-4.0','CC-BY-NC-4.0','CC-BY-NC-SA-4.0','WTF'][CASE WHEN p_partkey % 50 = 0 THEN 12 WHEN p_size < 10 THEN 1 + p_partkey % 8 ELSE 1 + p_partkey % 11 END] AS license, CASE WHEN p_partkey % 9 = 0 THEN 'Latest' ELSE '2024' END AS vintage FROM part)"
DIM = """dim AS (SELECT * FROM (VALUES ('public-domain-usgov', 0), ('public-domain', 0), ('CC0-1.0', 0), ('CC-BY-4.0', 0), ('EC-reuse-attribution', 0), ('CC-BY-IGO', 0), ('gov-open-co', 0),
('ODbL-1.0', 1), ('CC-BY-SA-4.0', 1), ('CC-BY-NC-4.0', 2), ('CC-BY-NC-SA-4.0', 2)) t(license, severity))"""


def _licences(s, d):
    k, names = F.col("p_partkey"), F.array(*[F.lit(x) for x, _ in events.LICENCES], F.lit("WTF"))
    at = F.when(k % 50 == 0, 12).when(F.col("p_size") < 10, 1 + k % 8).otherwise(1 + k % 11).cast("int")
    return table(s, d, "part").select(F.col("p_size").alias("asset"), F.concat("p_name", k.cast("string")).alias("source"), F.element_at(names, at).alias("license"), F.when(k % 9 == 0, "Latest").otherwise("2024").alias("vintage"))


@register("r12_licence_bucket", a.with_ctes(LIC, DIM) + "SELECT asset, max(coalesce(severity, 9))::INT AS severity, arg_max(license, (coalesce(severity, 9), license)) AS license FROM src LEFT JOIN dim USING (license) GROUP BY asset")
def r12_licence_bucket(s, d):
    return events.licence_bucket(_licences(s, d), s)


@register("q16_licence_lint", a.with_ctes(LIC, DIM) + """, b AS (SELECT * FROM src LEFT JOIN dim USING (license)) SELECT asset, source, 'unknown licence' AS finding FROM b WHERE severity IS NULL UNION ALL SELECT asset, source, 'non-commercial' FROM b WHERE severity = 2
UNION ALL SELECT asset, source, 'floating vintage' FROM b WHERE lower(vintage) IN ('latest','current') UNION ALL SELECT asset, NULL, 'incompatible share-alike' FROM b WHERE severity = 1 GROUP BY asset HAVING count(DISTINCT license) > 1""")  # fmt: skip
def q16_licence_lint(s, d):
    return events.licence_lint(_licences(s, d), s)


@register("q20_damage_gate", "SELECT p_partkey, CASE WHEN (p_partkey % 100) / 100.0 >= 0.75 AND p_size / 50.0 >= 0.75 THEN 'publish' ELSE 'hold' END AS gate FROM part")
def q20_damage_gate(s, d):
    return table(s, d, "part").select("p_partkey", events.damage_gate((F.col("p_partkey") % 100) / 100, F.col("p_size") / 50).alias("gate"))


@register("q1_q4_impact_assertions", HIT_SQL + """SELECT * FROM (SELECT 'negative_population' AS name, count(*) FILTER (pop_total < 0) AS broken, true AS blocking, count(*) FILTER (pop_total < 0) = 0 AS ok FROM hit
UNION ALL SELECT 'null_keys', count(*) FILTER (pop_total IS NULL OR adm2_id IS NULL), true, count(*) FILTER (pop_total IS NULL OR adm2_id IS NULL) = 0 FROM hit
UNION ALL SELECT 'unnamed_municipality', count(*), false, count(*) = 0 FROM hit WHERE mmi >= 6 AND adm2_id NOT IN (SELECT adm2_id FROM lookup WHERE adm1_id <> '0')
UNION ALL SELECT 'cannot_run', NULL, false, false)""")  # fmt: skip
def q1_q4_impact_assertions(s, d):
    rows = hit(s, d)
    return quality.run(s, [*quality.impact_assertions(rows, a.lookup(s, d).where("adm1_id <> '0'")), ("cannot_run", lambda: quality.broken(rows, F.col("no_such_column") > 0), False)])


@register("q5_national_total", HIT_SQL + "SELECT t AS total, round((t - 1e9) * 100 / 1e9, 4) AS pct, abs(round((t - 1e9) * 100 / 1e9, 4)) <= 5.0 AS ok FROM (SELECT sum(pop_total::DECIMAL(28,6))::DOUBLE AS t FROM exposure)")
def q5_national_total(s, d):
    return quality.national_total(a.exposure(s, d), 1e9, 5.0)


@register("q6_layer_coverage", HIT_SQL + " UNION ALL ".join(f"SELECT '{c}' AS layer, sum({c}::DECIMAL(28,6))::DOUBLE AS total, coalesce(sum({c}) <> 0, false) AS ok FROM exposure" for c in ("pop_total", "bld_count", "road_km", "health_count")))
def q6_layer_coverage(s, d):
    return quality.layer_coverage(a.exposure(s, d), ["pop_total", "bld_count", "road_km", "health_count"])


@register("q7_not_finite", 'SELECT \'v\' AS "column", count(*) FILTER (event_id % 500 = 0) AS broken FROM events UNION ALL SELECT \'w\', 0 FROM range(1)')
def q7_not_finite(s, d):
    v = F.when(F.col("event_id") % 1000 == 0, float("nan")).when(F.col("event_id") % 500 == 0, float("inf")).otherwise(F.col("value"))
    return quality.not_finite(table(s, d, "events").select("event_id", v.alias("v"), F.col("value").alias("w")))


@register("q8_age_consistency", HIT_SQL + "SELECT count(*) FILTER (pop_0_14 > pop_total * (1 + 1e-6)) AS young_over, count(*) FILTER (pop_65p > pop_total * (1 + 1e-6)) AS old_over, count(*) FILTER (abs(pop_0_14 + pop_15_64 + pop_65p - pop_total) > pop_total * 1e-6) AS not_total FROM exposure")
def q8_age_consistency(s, d):
    return quality.age_consistency(a.exposure(s, d))


@register("q11_mixed_manifests", "SELECT count(DISTINCT p_brand) AS manifests, count(DISTINCT p_brand) <= 1 AS ok FROM part")
def q11_mixed_manifests(s, d):
    return quality.mixed_manifests(table(s, d, "part"), "p_brand")


@register("q12_q13_reach", HIT_SQL + "SELECT count(*) AS cells, CASE WHEN count(*) = 0 THEN 'wrong country' WHEN max(mmi) < 9 THEN 'below the floor' ELSE 'reached' END AS verdict FROM intensity")
def q12_q13_reach(s, d):
    return quality.reach(a.intensity(s, d), 9.0, False)


@register("q18_blind_sources", "SELECT user_id AS source, count(*) AS files, count(*) FILTER (event_type = 'purchase' AND value > 150) AS read, count(*) FILTER (event_type = 'purchase' AND value > 150) = 0 AS blind FROM events GROUP BY 1")
def q18_blind_sources(s, d):
    return quality.blind_sources(table(s, d, "events").select(F.col("user_id").alias("source"), ((F.col("event_type") == "purchase") & (F.col("value") > 150)).alias("ok")))


@register("q19_stale_files", f"SELECT * FROM (SELECT event_id AS name, CASE WHEN event_id % 10 = 0 THEN NULL ELSE round(date_diff('microsecond', ts, {NOW}) / 3.6e9, 3) END AS age_h, CASE WHEN event_id % 10 = 0 THEN 'undated' WHEN round(date_diff('microsecond', ts, {NOW}) / 3.6e9, 3) > event_id % 400 THEN 'stale' END AS finding FROM events) WHERE finding IS NOT NULL")
def q19_stale_files(s, d):
    e = table(s, d, "events").select(F.col("event_id").alias("name"), F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("dated"), (F.col("event_id") % 400).alias("most_h"))
    return quality.stale(e, now())


@register("q15_digest_findings", "SELECT n_nationkey AS source, CASE WHEN s IS NULL THEN 'no files' WHEN s <> n_nationkey THEN 'mismatch' END AS finding FROM nation LEFT JOIN (SELECT s_nationkey AS k, min(s_suppkey) % 25 AS s FROM supplier GROUP BY 1) ON k = n_nationkey WHERE s IS NULL OR s <> n_nationkey")
def q15_digest_findings(s, d):
    files = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("source")).agg((F.min("s_suppkey") % 25).cast("string").alias("digest"))
    return quality.digest_findings(table(s, d, "nation").select(F.col("n_nationkey").alias("source"), F.col("n_nationkey").cast("string").alias("pinned")), files)


@register("q17_tolerance_tightened", "SELECT c_custkey, least(3.0, greatest(round(abs(c_acctbal / 1000) + 0.5, 2), 0.5)) AS tolerance FROM customer")
def q17_tolerance_tightened(s, d):
    return table(s, d, "customer").select("c_custkey", quality.tightened(F.lit(3.0), text.proposed_tolerance(F.col("c_acctbal") / 1000)).alias("tolerance"))


@register("a29_a30_rollup", "SELECT c_mktsegment, count(*) AS n, count(DISTINCT c_nationkey) AS countries, count(*) FILTER (c_acctbal < 0) AS negative, round(max(abs(c_acctbal)), 2) AS worst FROM customer GROUP BY 1")
def a29_a30_rollup(s, d):
    c = table(s, d, "customer")
    return c.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.countDistinct("c_nationkey").alias("countries"), F.count_if(F.col("c_acctbal") < 0).alias("negative"), F.round(F.max(F.abs("c_acctbal")), 2).alias("worst"))


@register("a38_contour_fineness", a.with_ctes(QUAKES) + """, st AS (SELECT user_id, lon, lat, lag(lon) OVER w AS x, lag(lat) OVER w AS y FROM quakes WINDOW w AS (PARTITION BY user_id ORDER BY event)),
k AS (SELECT user_id, asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(lat) - radians(y)) / 2), 2) + cos(radians(y)) * cos(radians(lat)) * pow(sin(radians(lon - x) / 2), 2)))) * 2 * 6371.0::DOUBLE AS km FROM st)
SELECT user_id, count(*) AS vertices, round(quantile_cont(km, 0.5), 4) AS step_km FROM k GROUP BY 1""")  # fmt: skip
def a38_contour_fineness(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event")
    km = geo.haversine_km(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat"))
    return quakes(s, d).withColumn("km", km).groupBy("user_id").agg(F.count("*").alias("vertices"), F.round(F.percentile("km", F.lit(0.5)), 4).alias("step_km"))


@register("f20_o6_candidate_countries", a.with_ctes(QUAKES) + """, box AS (SELECT n_nationkey, n_name, -119.0::DOUBLE + n_nationkey * 3 AS west, -50.0::DOUBLE + n_nationkey AS south, 12.0::DOUBLE + n_nationkey % 7 AS side FROM nation)
SELECT event, n_name, row_number() OVER (PARTITION BY event ORDER BY (event % 25 = n_nationkey) DESC, side * side, n_name) AS place FROM quakes JOIN box ON lon BETWEEN west AND west + side AND lat BETWEEN south AND south + side""")  # fmt: skip
def f20_o6_candidate_countries(s, d):
    from pyspark.sql import Window

    k = F.col("n_nationkey")
    box = table(s, d, "nation").select(k, "n_name", (F.lit(-119.0) + k * 3).alias("west"), (F.lit(-50.0) + k).alias("south"), (F.lit(12.0) + k % 7).alias("side"))
    both = quakes(s, d).join(F.broadcast(box), F.col("lon").between(F.col("west"), F.col("west") + F.col("side")) & F.col("lat").between(F.col("south"), F.col("south") + F.col("side")))  # a fixed dimension of 25 rows
    w = Window.partitionBy("event").orderBy((F.col("event") % 25 == k).desc(), F.col("side") * F.col("side"), "n_name")
    return both.select("event", "n_name", F.row_number().over(w).alias("place"))


@register("depth_and_compass", "SELECT event_id, CASE WHEN event_id % 400 < 70 THEN 'shallow' WHEN event_id % 400 <= 300 THEN 'intermediate' ELSE 'deep' END AS depth, ['N','NE','E','SE','S','SO','O','NO'][(round((event_id % 360) / 45.0) % 8 + 1)::INT] AS compass, floor((event_id % 100 - 50) / 3.0) * 3 AS tile FROM events")
def depth_and_compass(s, d):
    k = F.col("event_id")
    return table(s, d, "events").select("event_id", geo.depth_class(k % 400).alias("depth"), geo.compass(k % 360).alias("compass"), geo.tile_floor(k % 100 - 50, 3.0).cast("double").alias("tile"))


@register("text_names", "SELECT n_nationkey, trim(split_part(n_name || ', near ' || r_name, ',', -1)) AS place, upper(split_part('col-v0.' || n_nationkey, '-', 1)) AS iso3, 'col-v0.' || (n_nationkey + 1) AS bumped, regexp_full_match(n_name, '[A-Za-z0-9_-]{1,64}') AS is_id, lpad((n_nationkey * 37)::VARCHAR, 4, '0')[1:2] || ':' || lpad((n_nationkey * 37)::VARCHAR, 4, '0')[3:4] AS clock FROM nation JOIN region ON n_regionkey = r_regionkey")
def text_names(s, d):
    both = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    v = F.concat(F.lit("col-v0."), F.col("n_nationkey").cast("string"))
    return both.select("n_nationkey", text.last_segment(F.concat_ws(", near ", "n_name", "r_name")).alias("place"), text.iso3_of(v).alias("iso3"), text.bumped(v).alias("bumped"), text.is_event_id(F.col("n_name")).alias("is_id"), text.clock(F.col("n_nationkey") * 37).alias("clock"))


@register("text_shortened", "SELECT conv_id, turn, CASE WHEN length(text) > 40 THEN rtrim(left(text, 39), ' ') || '…' ELSE text END AS short, length(text) AS n FROM conversations")
def text_shortened(s, d):
    return table(s, d, "conversations").select("conv_id", "turn", text.shortened(F.col("text"), 40).alias("short"), F.length("text").alias("n"))


@register("text_significant", "SELECT o_orderkey, CASE WHEN o_totalprice = 0 THEN 0 ELSE round_even(o_totalprice / pow(10.0, floor(log10(abs(o_totalprice))) - 1), 0) * pow(10.0, floor(log10(abs(o_totalprice))) - 1) END AS rounded, (o_totalprice >= 1000)::INT + (o_totalprice >= 50000)::INT + (o_totalprice >= 200000)::INT AS step FROM orders")
def text_significant(s, d):
    return table(s, d, "orders").select("o_orderkey", text.significant(F.col("o_totalprice")).alias("rounded"), text.step_class(F.col("o_totalprice"), [1000, 50000, 200000]).alias("step"))


@register("s17_links_in_pages", r"""SELECT page_id, x AS href, regexp_extract(x, '/([A-Za-z]+)', 1) AS word FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS x FROM pages)""")
def s17_links_in_pages(s, d):
    p = table(s, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("href"))
    return p.select("page_id", "href", F.regexp_extract("href", "/([A-Za-z]+)", 1).alias("word"))


@register("f14_defaulted_columns", a.with_ctes(a.EXPOSURE_SQL) + "SELECT cell, adm2_id, 0.0 AS pop_alt_worldpop, '' AS src_manifest, 'pop_alt_worldpop,src_manifest' AS substituted FROM exposure")
def f14_defaulted_columns(s, d):
    df, missing = assets.with_defaults(a.exposure(s, d), {"pop_total": F.lit(0.0), "pop_alt_worldpop": F.lit(0.0), "src_manifest": F.lit("")})
    return df.select("cell", "adm2_id", "pop_alt_worldpop", "src_manifest", F.lit(",".join(missing)).alias("substituted"))


@register("s11_s12_json_events", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def s11_s12_json_events(s, d):
    return table(s, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))
