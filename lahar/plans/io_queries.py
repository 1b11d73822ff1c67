"""Sources, sinks and streams on the test tables, with their SQL where a round trip has one."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lahar.operators import impact
from lahar.plans import adapter as a
from lahar.plans.impact_queries import ADM2_SQL, HIT_SQL, hit
from lahar.plans.shared import shared_folder
from lahar.session import table
from lahar.sources import catalog, partial, readers, writers
from lahar.streaming import observed, state

Q, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@register("k1_s1_partitioned_asset", a.with_ctes(a.EXPOSURE_SQL) + "SELECT cell, adm2_id, bld_count FROM exposure WHERE adm2_id = '00003'")
def k1_s1_partitioned_asset(s, d):
    path = folder(s, "asset")
    writers.asset(a.exposure(s, d).withColumn("iso3", F.concat(F.lit("N"), "adm2_id")).withColumn("layer", F.lit("exposure")), path)
    return s.read.parquet(path).where("iso3 = 'N00003'").select("cell", "adm2_id", "bld_count")


TAGS = {"adm2_id": "#adm2+code", "mmi_max": "#severity", "pop_total_6": "#affected+six", "empty": "#none"}


@register("k3_k4_tagged_csv", ADM2_SQL + "SELECT adm2_id, mmi_max, NULL AS empty FROM adm2")
def k3_k4_tagged_csv(s, d):
    path = folder(s, "csv")
    writers.tagged_csv(impact.by_municipality(hit(s, d)).select("adm2_id", "mmi_max", "pop_total_6"), TAGS, path)
    return writers.read_tagged_csv(s, path).select("adm2_id", F.col("mmi_max").cast("double").alias("mmi_max"), F.nullif("empty", F.lit("")).alias("empty"))


@register("k5_columnar_cells", HIT_SQL + "SELECT '[' || cell || ',\"' || adm2_id || '\",' || bld_count || ']' AS row FROM hit")
def k5_columnar_cells(s, d):
    return writers.columnar(hit(s, d), ["cell", "adm2_id", "bld_count"])


@register("k6_published_contours", a.with_ctes(a.INTENSITY_SQL) + "SELECT DISTINCT mmi AS value FROM intensity WHERE mmi = (SELECT max(mmi) FROM intensity)")
def k6_published_contours(s, d):
    return writers.published_contours(a.intensity(s, d).select(F.col("mmi").alias("value")).distinct(), 11.0)


@register("k7_report_documents", "SELECT c_custkey AS id, '{\"id\":' || c_custkey || ',\"name\":\"' || c_name || '\"}' AS json FROM customer")
def k7_report_documents(s, d):
    return writers.documents(table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), ["id", "name"])


@register("k8_report_index", "SELECT event_id AS id, ts, event_type FROM events")
def k8_report_index(s, d):
    return writers.index(table(s, d, "events").select(F.col("event_id").alias("id"), "ts", "event_type", F.array("value").alias("list")))


@register("k9_build_measurements", HIT_SQL + """SELECT count(*) AS cells, sum(pop_total::DECIMAL(28,6))::DOUBLE AS pop_total, sum(bld_count)::BIGINT AS bld_count, count(DISTINCT adm2_id) AS municipalities, 'col-v0.5' AS version, 0.5 AS rescued,
  (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 1) AS neighbours, 'CC-BY-4.0' AS licence FROM exposure""")
def k9_build_measurements(s, d):
    """The document is written, read again and taken apart."""
    near = table(s, d, "supplier").where("s_suppkey % 2 = 1").agg(F.count("*").alias("neighbours"))
    doc = writers.measurements(a.exposure(s, d), version="col-v0.5", sums=("bld_count",), sections={"rescue": s.range(1).select(F.lit(0.5).alias("rescued")), "neighbours": near, "licence": s.range(1).select(F.lit("CC-BY-4.0").alias("licence"))})
    path = folder(s, "measured")
    doc.write.text(path)
    parts = "version string, summary struct<cells:bigint,pop_total:double,bld_count:bigint,municipalities:bigint>, rescue struct<rescued:double>, neighbours struct<neighbours:bigint>, licence struct<licence:string>"
    return s.read.text(path).select(F.from_json("value", parts).alias("j")).select("j.summary.*", "j.version", "j.rescue.*", "j.neighbours.*", "j.licence.*")


@register("s9_s10_fire_csv", a.with_ctes(a.DETECTIONS_SQL) + "SELECT event_id % 2 AS sensor, count(*) FILTER (event_id % 10 <> 0) AS good, count(*) FILTER (event_id % 10 = 0) AS bad FROM detections GROUP BY 1")
def s9_s10_fire_csv(s, d):
    e = a.detections(s, d)
    text = {c: F.lit("") for c in readers.FIRE_COLUMNS}
    text |= {"latitude": F.when(F.col("event_id") % 10 == 0, "broken").otherwise(F.col("lat").cast("string")), "longitude": F.col("lon").cast("string"), "acq_date": F.date_format("ts", "yyyy-MM-dd"), "acq_time": F.date_format("ts", "Hmm"), "satellite": F.col("sensor").cast("string"), "confidence": F.upper("confidence")}
    path = folder(s, "fires")
    e.select(*[v.alias(c) for c, v in text.items()]).write.option("header", True).csv(path)
    return readers.fires(s, path).groupBy(F.col("sensor").cast("long").alias("sensor")).agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"))


@register("s11_event_feed", "SELECT event_id::VARCHAR AS id, value AS mag, date_trunc('millisecond', ts) AS ts, len(['a' || event_id, 'b' || event_id]) AS ids FROM events WHERE event_id % 7 <> 0")
def s11_event_feed(s, d):
    k = F.col("event_id").cast("string")
    at = F.when(F.col("event_id") % 7 != 0, F.array(F.lit(-75.0), F.lit(4.0), F.lit(10.0)))
    props = F.struct(F.col("value").alias("mag"), F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), F.concat(F.lit(",a"), k, F.lit(",b"), k, F.lit(",")).alias("ids"))
    feature = F.struct(k.alias("id"), props.alias("properties"), F.struct(at.alias("coordinates")).alias("geometry"))
    texts = table(s, d, "events").select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))).alias("value"))
    return readers.assert_some_good(readers.feed(texts)).select("id", "mag", F.col("ts").cast("timestamp_ntz").alias("ts"), F.size("ids").cast("long").alias("ids"))


@register("s12_product_versions", a.with_ctes(a.PRODUCTS_SQL) + "SELECT event::VARCHAR AS event, contributor, status, weight, version, updated FROM products")
def s12_product_versions(s, d):
    v = F.struct("status", F.col("weight").alias("preferredWeight"), F.col("updated").alias("updateTime"), F.create_map(F.lit("eventsource"), F.col("contributor"), F.lit("version"), F.col("version").cast("string")).alias("properties"))
    lists = a.products(s, d).groupBy("event").agg(F.collect_list(v).alias("list"))
    texts = lists.select(F.to_json(F.struct(F.col("event").cast("string").alias("id"), F.struct(F.struct(F.col("list").alias("shakemap")).alias("products")).alias("properties"))).alias("value"))
    return readers.product_versions(texts).select("event", "contributor", "status", "weight", "version", "updated")


@register("s13_contour_reader", "SELECT 4.0::DOUBLE + s_suppkey % 5 AS value, s_suppkey + 0.5 AS x FROM supplier WHERE s_suppkey % 4 <> 0")
def s13_contour_reader(s, d):
    k = F.col("s_suppkey")
    point = lambda x: F.array(x, F.lit(1.0))
    line = F.array(point(k + 0.5), point(k + 1.0), point(k + 1.5), point(k + 0.5))
    feature = F.struct(F.struct((F.lit(4.0) + k % 5).alias("value"), F.when(k % 4 == 0, "pga").when(k % 4 == 1, "mmi").alias("units")).alias("properties"), F.struct(F.array(line).alias("coordinates")).alias("geometry"))
    texts = table(s, d, "supplier").select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("value"))
    return readers.contours(texts).select("value", F.col("ring")[0]["x"].alias("x"))


MESSAGES = "CASE event_type WHEN 'signup' THEN 'detect' WHEN 'error' THEN 'retract' WHEN 'purchase' THEN 'product' ELSE 'tick' END"


def messages(s, d):
    e = F.col("event_type")
    kind = F.when(e == "signup", "detect").when(e == "error", "retract").when(e == "purchase", "product").otherwise("tick")
    return table(s, d, "events").select((F.col("event_id") % 300).alias("event"), F.col("event_id").alias("id"), kind.alias("kind"), (F.col("event_id") % 5).cast("int").alias("version"), F.col("ts").cast("timestamp").alias("ts"))


@register("t3_t4_event_states", f"""WITH RECURSIVE m AS (SELECT event_id % 300 AS event, ts, {MESSAGES} AS kind, event_id % 5 AS v, row_number() OVER (PARTITION BY event_id % 300 ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT event, 0::BIGINT AS n, 'detectado' AS state, 0::BIGINT AS version, ts AS detected, 0::BIGINT AS changes FROM m WHERE n = 1
UNION ALL SELECT event, n, next, CASE WHEN rises THEN v ELSE version END, detected, changes + (next <> state OR rises)::INT FROM (
  SELECT f.event, m.n, f.state, f.version, f.detected, f.changes, m.v, f.state <> 'descartado' AND m.kind = 'product' AND m.v > f.version AS rises,
    CASE WHEN f.state = 'descartado' OR m.kind = 'retract' THEN 'descartado' WHEN m.kind = 'product' AND m.v > f.version THEN 'publicado'
      WHEN m.kind = 'tick' AND f.state IN ('detectado', 'preliminar') THEN CASE WHEN m.ts - f.detected >= INTERVAL 6 HOUR THEN 'degradado' ELSE 'preliminar' END ELSE f.state END AS next
  FROM f JOIN m ON m.event = f.event AND m.n = f.n + 1))
SELECT event, state, version, detected, changes FROM f QUALIFY row_number() OVER (PARTITION BY event ORDER BY n DESC) = 1""")  # fmt: skip
def t3_t4_event_states(s, d):
    return state.batch_states(messages(s, d)).withColumn("detected", F.col("detected").cast("timestamp_ntz"))


@register("t1_tumbling_windows", "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n, sum(value::DECIMAL(28,6))::DOUBLE AS value FROM events GROUP BY 1, 2")
def t1_tumbling_windows(s, d):
    rows = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return state.tumbling(rows, "6 hours", by=("event_type",)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@register("t12_capped_history", "SELECT user_id AS source, ts, event_id AS id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 20")
def t12_capped_history(s, d):
    return state.capped_history(table(s, d, "events").select(F.col("user_id").alias("source"), "ts", F.col("event_id").alias("id")), 20)


@register("s10_audited_files", "SELECT f AS file, CASE WHEN f = 3 THEN 'failed' WHEN f = 2 THEN 'empty' ELSE 'read' END AS status, CASE WHEN f = 2 THEN (SELECT count(*) FROM events WHERE event_id % 3 = 2) WHEN f = 3 THEN 0 ELSE (SELECT count(*) FROM events WHERE event_id % 3 = f AND event_id % 10 = 0) END AS skipped FROM range(4) t(f)")
def s10_audited_files(s, d):
    k = F.col("event_id")
    rows = table(s, d, "events").select((k % 3).alias("file"), ((k % 3 != 2) & (k % 10 != 0)).alias("ok"))
    return readers.audit(rows, s.range(4).select(F.col("id").alias("file")))


@register("s19_json_directory", "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END AS name, n_nationkey % 5 = 0 AS unreadable FROM nation")
def s19_json_directory(s, d):
    k = F.col("n_nationkey")
    path = folder(s, "states")
    body = F.to_json(F.struct(k.alias("id"), F.col("n_name").alias("name")))
    table(s, d, "nation").select(F.when(k % 5 == 0, F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "name": '))).otherwise(body).alias("value")).repartition(25, k).write.text(path)
    rows = readers.json_directory(s, path, "id long, name string", whole=False)
    broken = F.regexp_extract("raw", r"(\d+)", 1).cast("long")
    return rows.select(F.coalesce("id", broken).alias("id"), "name", (~F.col("ok")).alias("unreadable"))


@register("s5_geojson_shapes", """SELECT s_suppkey AS shape, CASE WHEN s_suppkey % 2 = 0 THEN 12 ELSE 8 END AS edges, CASE WHEN s_suppkey % 2 = 0 THEN 24.0 ELSE 15.0 END AS area FROM supplier""")
def s5_geojson_shapes(s, d):
    """Polygons with a hole, and multipolygons with two parts of which one has a hole."""
    from lahar.operators import polygons

    k = F.col("s_suppkey")
    square = lambda x, y, w: F.array(*[F.array(F.lit(float(x + a_ * w)), F.lit(float(y + b_ * w))) for a_, b_ in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    one, hole, other = square(0, 0, 4), square(1, 1, 1), square(10, 0, 3)
    single = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(one, hole).alias("coordinates")))
    several = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(one, hole), F.array(other)).alias("coordinates")))
    geometry = F.when(k % 2 == 0, several).otherwise(single)
    feature = F.concat(F.lit('{"type":"Feature","properties":{"code":"'), k.cast("string"), F.lit('"},"geometry":'), geometry, F.lit("}"))
    texts = table(s, d, "supplier").select(F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}")).alias("value"))
    rings = readers.geojson_rings(texts).select(F.element_at("properties", "code").cast("long").alias("shape"), "ring")
    edges = polygons.closed_edges(rings)
    counts = edges.groupBy("shape").agg(F.count("*").cast("int").alias("edges"))
    # outer rings and holes turn the same way here, so the even-odd area is that of the fill
    filled = polygons.polyfill(edges, 1).groupBy("shape").agg((F.count("*") / 4).alias("area"))
    return counts.join(filled, "shape").select("shape", "edges", "area")


@register("s23_arrow_relation", "SELECT n_regionkey AS k, count(*) AS n, sum(n_regionkey * 10) AS v FROM nation GROUP BY 1")
def s23_arrow_relation(s, d):
    import pyarrow as pa

    side = readers.from_arrow(s, pa.table({"k": pa.array(range(5), pa.int64()), "v": pa.array([10 * i for i in range(5)], pa.int64())}))
    return table(s, d, "nation").join(side, F.col("n_regionkey") == F.col("k")).groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v"))


@register("k2_admin_lookup", a.with_ctes(a.LOOKUP_SQL) + "SELECT * FROM lookup")
def k2_admin_lookup(s, d):
    path = folder(s, "lookup")
    writers.admin_lookup(a.lookup(s, d), path)
    return s.read.parquet(path)


@register("k7_closed_documents", "SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 1 THEN 'alert outside its values' WHEN c_custkey % 4 = 2 THEN 'name missing' END AS finding FROM customer")
def k7_closed_documents(s, d):
    k = F.col("c_custkey")
    rows = table(s, d, "customer").select(k.alias("id"), F.when(k % 4 != 2, F.col("c_name")).alias("name"), F.when(k % 4 == 1, "purple").when(k % 4 == 3, "red").otherwise("").alias("alert"))
    return rows.select("id", writers.schema_finding({"id": None, "name": None, "alert": ("", "green", "yellow", "orange", "red")}, rows.columns).alias("finding"))


@register("k10_fire_document", HIT_SQL + """SELECT count(*) AS celdas, least(count(*), 50) AS listadas, true AS announced, sum(bld_count)::BIGINT AS edificios FROM exposure""")
def k10_fire_document(s, d):
    from lahar.operators import fires as f

    cells = a.exposure(s, d).select("cell", F.lit(1).cast("long").alias("detecciones"), F.lit(0).cast("long").alias("detecciones_baja"), "pop_total", "bld_count", "health_count", "edu_count", F.col("built_m2").alias("frp_suma"))
    doc = f.document(cells, s.range(1).select(F.lit(3).cast("long").alias("celdas"), F.lit(7).cast("long").alias("detecciones")), 50)
    j = doc.select(F.from_json("json", "totals struct<celdas:bigint,celdas_publicadas:bigint,edificios:bigint>, cap bigint, cells array<struct<cell:bigint>>").alias("j"))
    return j.select("j.totals.celdas", F.size("j.cells").cast("long").alias("listadas"), ((F.col("j.cap") == 50) & (F.col("j.totals.celdas_publicadas") == F.size("j.cells"))).alias("announced"), "j.totals.edificios")


@register("t1_polled_feeds", """SELECT 'good' AS feed, 'read' AS status, count(*) AS events FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'blind', 'nothing usable', 0 FROM range(1) UNION ALL SELECT 'gone', 'failed', 0 FROM range(1)""")
def t1_polled_feeds(s, d):
    k = F.col("event_id")
    feature = lambda at: F.concat(F.lit('{"features":[{"id":"'), k.cast("string"), F.lit('","properties":{"time":1000},"geometry":{"coordinates":'), at, F.lit("}}]}"))
    even = table(s, d, "events").where(k % 2 == 0)
    feeds = {"good": lambda: even.select(feature(F.lit("[1,2,3]")).alias("value")), "blind": lambda: even.select(feature(F.lit("null")).alias("value")), "gone": lambda: s.read.text(f"{d}/no_such_feed.json")}
    _, report = readers.polled(s, feeds)
    return report


@register("t9_rolling_observed", """WITH best AS (SELECT user_id AS id, max(event_id)::BIGINT AS version, arg_max(ts, event_id) AS ts, arg_max(value, event_id)::DOUBLE AS value FROM events GROUP BY user_id)
SELECT * FROM best WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 5 DAY""")
def t9_rolling_observed(s, d):
    """A stream over the events with a timer for each user; what its changes leave."""
    schema = s.read.parquet(f"{d}/events.parquet").schema
    rows = lambda own: own.readStream.schema(schema).parquet(f"{d}/events.parquet*").select(F.col("user_id").alias("id"), F.col("event_id").alias("version"), "ts", "value")
    changes = s.read.schema(observed.CHANGE).parquet(observed.run_changes(s, lambda own: observed.rolling(rows(own), 5)))
    return observed.standing(changes).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("t13_merged_files", "SELECT o_custkey AS id, max(o_orderkey)::BIGINT AS version, arg_max(o_totalprice, o_orderkey)::DOUBLE AS price FROM orders GROUP BY o_custkey")
def t13_merged_files(s, d):
    """Orders written as four files that diverge, merged file by file: the newest order of each customer."""
    rows = table(s, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").cast("long").alias("version"), F.col("o_totalprice").cast("double").alias("price"))
    place = folder(s, "divergent")
    rows.repartition(4, F.col("version") % 4).write.parquet(place)
    stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(place)
    return observed.merge_files(s, stream, "id", "version")


@register("s10_partial_files", """SELECT status, count(*) AS files, sum(n)::BIGINT AS lines FROM (
  SELECT 'read' AS status, count(*) AS n FROM customer GROUP BY c_nationkey UNION ALL SELECT 'failed', 0 FROM (SELECT DISTINCT c_nationkey FROM customer) UNION ALL SELECT 'failed', 0) GROUP BY status""")
def s10_partial_files(s, d):
    """A packed file of each country's customers, the same lines under a name that says packed and isn't, and one that is not there."""
    place = folder(s, "partial")
    rows = table(s, d, "customer").select("c_nationkey", F.col("c_name").alias("value")).repartition("c_nationkey")
    rows.write.partitionBy("c_nationkey").option("compression", "gzip").text(f"{place}/good")
    rows.write.partitionBy("c_nationkey").text(f"{place}/bad")
    jvm, paths = s.sparkContext._jvm, []
    for kind in ("good", "bad"):
        path = jvm.org.apache.hadoop.fs.Path(f"{place}/{kind}/*/part-*")
        fs = path.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
        for found in fs.globStatus(path):
            name = found.getPath().toString()
            if kind == "bad":
                fs.rename(found.getPath(), jvm.org.apache.hadoop.fs.Path(name + ".gz"))
            paths.append(name + (".gz" if kind == "bad" else ""))
    paths.append(f"{place}/nowhere.txt.gz")
    told = partial.outcome(s, partial.lines_of(s, paths), paths)
    return told.groupBy("status").agg(F.count("*").alias("files"), F.sum("lines").alias("lines"))


_SPOT = f"SELECT c_custkey AS id, {a.lon_sql('c_custkey')} AS x, {a.lat_sql('c_custkey')} AS y, c_custkey % 5 AS w FROM customer"


@register("s2_s3_catalog_scan", f"SELECT id FROM ({_SPOT}) WHERE x <= -60 AND x + w >= -80 AND y <= 10 AND y + w >= -20")
def s2_s3_catalog_scan(s, d):
    """Boxes in files by strips of ten degrees, of which the catalogue names the extents: the union first, then one for each half."""
    x, y, w = F.col("lon"), F.col("lat"), F.col("id") % 5
    rows = a.customer_points(s, d).select("id", F.struct(x.alias("xmin"), y.alias("ymin"), (x + w).alias("xmax"), (y + w).alias("ymax")).alias("bbox"), F.floor(x / 10).alias("strip"), (y > 0).alias("half"))
    place = folder(s, "catalog")
    rows.repartition("strip").write.partitionBy("strip").parquet(place)
    box = lambda: F.array(F.min("bbox.xmin"), F.min("bbox.ymin"), F.max("bbox.xmax"), F.max("bbox.ymax"))
    whole = rows.groupBy("strip").agg(box().alias("union"))
    parts = rows.groupBy("strip", "half").agg(box().alias("part")).groupBy("strip").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    listed = whole.join(parts, "strip").select(F.concat(F.lit(f"{place}/strip="), F.col("strip").cast("string")).alias("file"), F.concat(F.array("union"), "parts").alias("extents"))
    return catalog.scan(s, listed, (-80.0, -20.0, -60.0, 10.0), "id long, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>").select("id")
