"""Edge cases on hand-made frames: nulls, NaN, ties, empty tables, and rules that generic data doesn't reach."""

import math
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lahar.functions import geo, grid, text
from lahar.operators import assets, events, fires, impact, polygons, quality
from lahar.sources import readers, writers
from lahar.streaming import state


def one(spark, col):
    return spark.range(1).select(col.alias("x")).head().x


def test_grid_round_trip_and_parents(spark):
    df = spark.createDataFrame([(-75.3, 4.2), (179.9, -89.9), (-180.0, 0.0)], "lon double, lat double")
    cell = grid.cell_of(F.col("lon"), F.col("lat"), 3)
    rows = df.select("lon", "lat", cell.alias("c"), grid.lon_of(cell, 3).alias("x"), grid.lat_of(cell, 3).alias("y"), grid.parent(cell).alias("p"), grid.cell_of(F.col("lon"), F.col("lat"), 2).alias("p2"), grid.from_hex(grid.to_hex(cell)).alias("h")).collect()
    for r in rows:
        assert abs(r.x - r.lon) <= 1 / 16 and abs(r.y - r.lat) <= 1 / 16 and r.p == r.p2 and r.h == r.c
    assert one(spark, F.size(grid.neighbours(F.lit(5 << 20 | 5)))) == 8 and one(spark, F.size(grid.neighbours(F.lit(5 << 20 | 5), 1, False))) == 4


def test_geometry(spark):
    assert one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(111.19, abs=0.01)
    assert one(spark, geo.wind_direction(F.lit(0.0), F.lit(-5.0))) == 0
    assert one(spark, geo.compass(F.lit(350))) == "N"
    assert one(spark, geo.tile_floor(F.lit(-1.0), 3.0)) == -3.0
    for x, fine in ((1.0, True), (float("nan"), False), (float("-inf"), False)):
        assert one(spark, geo.is_finite(F.lit(x))) is fine


@pytest.mark.parametrize(("x", "want"), [(0.0, "0"), (9450.0, "9.400"), (9550.0, "9.600"), (-341332.0, "-340 mil"), (341332.0, "340 mil"), (4836557.0, "4,8 millones"), (1000000.0, "1 millón")])
def test_prose(spark, x, want):
    assert one(spark, text.prose(F.lit(x))) == want


def test_names(spark):
    assert one(spark, text.title_case(F.lit("SAN JOSÉ DE LA MAR a.b."))) == "San José de la Mar A.B."
    assert one(spark, text.title_case(F.lit("BOGOTÁ, D.C. dos ríos ST. en"))) == "Bogotá, D.C. dos Ríos St. en"
    for x, want in ((345000.0, 340000.0), (125.0, 120.0), (347129.0, 350000.0), (0.0432, 0.043), (1e6, 1e6), (-125.0, -120.0)):
        assert one(spark, text.significant(F.lit(x))) == want
    assert one(spark, text.es_number(F.lit(1234567.8), 1)) == "1.234.567,8"
    assert one(spark, text.linked(F.lit("2 millones"), "personas")) == "2 millones de personas"


def test_discrepancy_without_alternative_is_null(spark):
    assert one(spark, impact.discrepancy_pct(F.lit(5.0), F.lit(0.0))) is None


def test_bands_are_cumulative_and_municipal_sums_are_national(spark):
    rows = [(i, f"{i % 3:05d}", 10.0 * i, 1.0, 8.0, 1.0, 9.0 * i, i, 5.0, 1, 1, 0.5, None) for i in range(1, 40)]
    names = "cell long, adm2_id string, pop_total double, pop_0_14 double, pop_15_64 double, pop_65p double, pop_alt double, bld_count long, built_m2 double, health_count long, edu_count long, road_km double, flags_calidad string"
    mmi = spark.createDataFrame([(i, 5.0 + i % 8 / 2) for i in range(1, 40)], "cell long, mmi double")
    gf = spark.createDataFrame([(1, 0.10, None), (2, 0.0999, 0.5)], "cell long, ls_prob double, lq_prob double")
    hit = impact.join_impact(spark.createDataFrame(rows, names), mmi, gf)
    adm, nat = impact.by_municipality(hit), impact.national(hit).head()
    sums = adm.agg(*[F.sum(c).alias(c) for c in adm.columns if "_" in c and c[-1].isdigit()]).head()
    for c, v in sums.asDict().items():
        assert nat[c] == pytest.approx(v)
    assert nat.pop_total_6 >= nat.pop_total_7 >= nat.pop_total_8 > 0
    assert impact.national(hit.where("false")).head().pop_total_6 == 0


def test_window_keeps_unstamped_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "2024-01-02 00:00:00"), (2, "2023-12-31 23:59:59"), (3, None)], "id int, s string").withColumn("ts", F.col("s").cast("timestamp"))
    assert sorted(r.id for r in fires.recent(df).collect()) == [1, 3]
    assert fires.recent(df.limit(0)).collect() == []


def test_clusters_of_a_long_line(spark, tmp_path):
    from lahar.plans.shared import shared_cut

    cells = spark.createDataFrame([((100 + i) << 20 | 7,) for i in range(30)] + [(5,)], "cell long")
    got = fires.clusters(cells, cut=shared_cut(spark)).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in got) == [1, 30]


def test_point_dedupe_rules(spark):
    d = assets.DEGREES_PER_M
    first = spark.createDataFrame([(1, 0.0, 0.0), (2, 5 * d, 0.0)], "id int, lon double, lat double")
    later = spark.createDataFrame([(3, 2 * d, 0.0), (4, 200 * d, 0.0), (5, -19 * d, 19 * d)], "id int, lon double, lat double")
    assert sorted(r.id for r in assets.dedupe_points(first, later, 20).collect()) == [1, 2, 4]
    assert len(assets.dedupe_points(first, later, 0).collect()) == 5


def test_road_length_is_conserved(spark):
    seg = spark.createDataFrame([(1, -75.0, 4.0, -74.9, 4.0, None), (2, 0.0, 0.0, float("nan"), 1.0, "primary"), (3, 1.0, 1.0, 1.0, 1.0, "primary")], "id int, x1 double, y1 double, x2 double, y2 double, class string")
    r = assets.road_km(seg.withColumn("class", assets.road_class(F.col("class"))), 4).agg(F.sum("road_km_other").alias("o"), F.sum("road_km_primary").alias("p")).head()
    assert r.o == pytest.approx(11.09, abs=0.05) and r.p == 0


def test_age_bands_and_flags(spark):
    bands = spark.range(1).select(*[b.alias(n) for b, n in zip(assets.age_bands(F.lit(120.0), F.lit(0.0), F.lit(3.0), F.lit(1.0)), "ymo", strict=True)]).head()
    assert (bands.y, bands.m, bands.o) == (0.0, 120.0, 0.0)
    assert one(spark, assets.quality_flags(F.lit(600.0), F.lit(600.0), F.lit(0), F.lit(5.0))) == "sin_edificios"
    assert one(spark, assets.quality_flags(F.lit(1.0), F.lit(1.0), F.lit(3), F.lit(5.0))) is None


def test_even_odd_fill_and_open_rings(spark):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    rings = spark.createDataFrame([(1, square(0.0, 4.0)), (1, square(1.0, 3.0)), (2, square(4.0, 8.0)), (3, square(0.0, 9.0)[:-1])], "shape int, ring array<struct<x:double,y:double>>")
    edges = polygons.closed_edges(rings)
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 4.0, 4.0), (4, 8.5, 8.5)], "id int, lon double, lat double")
    assert sorted((r.id, r.shape) for r in polygons.containing(points, edges).collect()) == [(1, 1), (3, 2)]
    inner = polygons.closed_edges(spark.createDataFrame([(7, square(0.0, 9.0)), (8, square(2.0, 3.0))], "shape int, ring array<struct<x:double,y:double>>"))
    assert [(r.inner, r.outer) for r in polygons.within_shape(inner).collect()] == [(8, 7)]


def test_rescue_order(spark):
    square = lambda a, b, c, d: [(a, c), (b, c), (b, d), (a, d), (a, c)]
    shape = "shape int, ring array<struct<x:double,y:double>>"
    own = polygons.closed_edges(spark.createDataFrame([(1, square(0.0, 1.0, 0.0, 1.0))], shape))
    other = polygons.closed_edges(spark.createDataFrame([(9, square(1.0, 2.0, 0.0, 1.0))], shape))
    sea_land = spark.createDataFrame([(1, -0.005, 0.5), (2, 1.005, 0.5), (3, -0.5, 0.5)], "id int, lon double, lat double")
    assert [r.id for r in polygons.rescue(sea_land, own, other, 0.02).collect()] == [1]
    assert sorted(r.id for r in polygons.rescue(sea_land, own, other.limit(0), 0.02).collect()) == [1, 2]


def test_failed_assertion_keeps_its_severity(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    got = {r.name: r for r in quality.run(spark, [("a", lambda: quality.broken(df, F.col("x") < 0), True), ("b", lambda: quality.broken(df, F.col("nope") > 0), False)]).collect()}
    assert not got["a"].ok and got["a"].broken == 1 and got["a"].blocking and not got["b"].ok and not got["b"].blocking


def test_decisions(spark):
    t, f = F.lit(True), F.lit(False)
    none = F.lit(None).cast("double")
    assert one(spark, events.decide(f, f, f, none, F.lit(72), f)) == "exhausted"
    assert one(spark, events.decide(f, f, f, none, F.lit(71), f)) == "preliminary"
    assert one(spark, events.decide(f, f, f, F.lit(5.9), F.lit(99), f)) == "preliminary"
    assert one(spark, events.decide(t, f, t, none, F.lit(0), t)) == "full"
    assert one(spark, events.decide(f, t, t, none, F.lit(0), t)) == "omit"
    assert one(spark, events.decide(t, f, f, none, F.lit(0), f)) == "omit"
    assert one(spark, events.allowed(F.lit("preliminar"), F.lit("preliminar"))) is True
    assert one(spark, events.allowed(F.lit("degradado"), F.lit("preliminar"))) is True
    assert one(spark, events.known_alert(F.lit("RED"))) == "" and one(spark, events.known_alert(F.lit("red"))) == "red"
    assert one(spark, events.irrelevance(F.lit("earthquake"), F.lit(5.5), F.lit(-119.0), F.lit(33.0))) is None
    assert one(spark, events.allowed(F.lit("descartado"), F.lit("publicado"))) is False


def test_fire_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(readers.FIRE_COLUMNS) + "\n4.1,-75.2,300,1,1,2024-01-02,406,N,H,2,280,,D\nbad,-75,1,1,1,2024-01-02,0,N,L,2,1,3,D\n4,-75,1,1,1,2024-01-02,0,N,L,2,1,3.5,D\n")
    rows = readers.fires(spark, f"file://{tmp_path}/a.csv").collect()
    good = [r for r in rows if r.ok]
    assert len(rows) == 3 and sorted((r.ts.strftime("%H:%M"), r.frp, r.confidence) for r in good) == [("00:00", 3.5, "l"), ("04:06", 0.0, "h")]


def test_feed_without_good_features_fails(spark):
    bad = spark.createDataFrame([('{"features":[{"id":null}]}',)], "value string")
    with pytest.raises(Exception, match="no feature"):
        readers.assert_some_good(readers.feed(bad)).collect()


def grib_message(values, width=8, two=0, ten=1, bitmap=None):
    ni, nj = 3, 2
    section = lambda n, body: struct.pack(">IB", len(body) + 5, n) + body
    s1 = section(1, bytes(16))
    grid_body = bytearray(67)
    struct.pack_into(">BIBBH", grid_body, 0, 0, ni * nj, 0, 0, 0)
    struct.pack_into(">II", grid_body, 25, ni, nj)
    struct.pack_into(">I", grid_body, 41, 10_000_000)
    struct.pack_into(">I", grid_body, 45, 285_000_000)
    struct.pack_into(">II", grid_body, 58, 1_000_000, 1_000_000)
    s3 = section(3, bytes(grid_body))
    s4 = section(4, bytes([0, 0, 0, 0, 2, 3]))
    s5 = section(5, struct.pack(">IHfHHBB", len(values), 0, 1.0, two, ten, width, 0))
    s6 = section(6, bytes([255]) if bitmap is None else bytes([0]) + np.packbits(bitmap).tobytes())
    s7 = section(7, bytes(values))
    body = s1 + s3 + s4 + s5 + s6 + s7 + b"7777"
    return b"GRIB" + bytes([0, 0, 0, 2]) + struct.pack(">Q", len(body) + 16) + body


def test_grib2(spark, tmp_path):
    (df,) = readers.decode_grib2(grib_message([0, 10, 20, 30, 40, 50]))
    assert df["value"].round(6).tolist() == [0.1, 1.1, 2.1, 3.1, 4.1, 5.1]
    assert df["lon"].tolist()[:3] == [-75.0, -74.0, -73.0] and df["lat"].tolist() == [10.0] * 3 + [9.0] * 3
    (gap,) = readers.decode_grib2(grib_message([7, 9], bitmap=[1, 0, 0, 1, 0, 0]))
    assert [math.isnan(v) for v in gap["value"]] == [False, True, True, False, True, True]
    (tmp_path / "x.grib2").write_bytes(grib_message([1] * 6) * 2)
    assert readers.grib2(spark, f"file://{tmp_path}/x.grib2").count() == 12


def test_raster_windows_and_xml_grid(spark, tmp_path):
    (tmp_path / "r.asc").write_text("ncols 2\nnrows 3\nxllcorner -75\nyllcorner 4\ncellsize 1\nnodata_value -200\n10 -200\n-200 30\n1 2\n")
    spark.dataSource.register(readers.AsciiRaster)
    px = spark.read.format("ascii_raster").option("rows", 2).load(f"file:{tmp_path}/r.asc")
    assert sorted((r.lon, r.lat, r.value) for r in px.collect()) == [(-74.5, 4.5, 1.0), (-74.5, 6.5, 10.0), (-73.5, 4.5, 2.0), (-73.5, 5.5, 30.0)]
    (tmp_path / "g.xml").write_text('<shakemap_grid><grid_specification lon_min="-75" lat_min="4" lon_max="-74" lat_max="4" nlon="2" nlat="1"/><grid_field index="1" name="LON"/><grid_field index="2" name="LAT"/><grid_field index="3" name="mmi"/><grid_data>\n-75 4 5.5\n-74 4 6.1\n</grid_data></shakemap_grid>')
    assert sorted((r.lon, r.mmi) for r in readers.xml_grid(spark, f"file://{tmp_path}/g.xml").collect()) == [(-75.0, 5.5), (-74.0, 6.1)]


def test_contract_refuses_unknown_columns(spark):
    with pytest.raises(ValueError, match="outside"):
        writers.contract(spark.createDataFrame([(1, 2)], "a int, b int"), ["a"])


def test_hrefs(spark):
    df = spark.createDataFrame([('<a href="x_f_15_2020.tif">a</a><a href="y.txt">b</a>',)], "v string")
    assert [(r.href, r.age) for r in readers.hrefs(df, "v").collect()] == [("x_f_15_2020.tif", 15)]


def test_stream_equals_batch(spark, tmp_path):
    start = pd.Timestamp("2024-01-01")
    rows = [(e, i, k, v, start + pd.Timedelta(hours=3 * i)) for e in range(6) for i, (k, v) in enumerate([("detect", 0), ("tick", 0), ("tick", 0), ("product", 1 + e % 3), ("product", 2), ("retract", 0) if e % 2 else ("tick", 0)])]
    df = spark.createDataFrame([(*r[:4], r[4].to_pydatetime()) for r in rows], "event long, id long, kind string, version int, ts timestamp")
    want = sorted(map(tuple, state.batch_states(df).collect()))
    for part in range(2):
        df.where(F.col("id") % 6 < 3 if part == 0 else F.col("id") % 6 >= 3).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = state.stream_states(stream).writeStream.format("memory").queryName("states").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    last = {r.event: tuple(r) for r in spark.table("states").orderBy("changes", "version").collect()}
    assert {r[0] for r in want} == set(last)
    assert state.step(("descartado", 1, start, 2), "product", 5, start) == ("descartado", 1, start, 2)
    assert state.step(None, "detect", 0, start) == ("detectado", 0, start, 0)


def test_stream_dedupe_and_windows(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.5, "2024-01-01 00:01:00"), ("a", 1, 2.5, "2024-01-01 00:02:00"), ("b", 2, 1.0, "2024-01-01 00:09:00")], "alias string, user_id int, value double, s string").withColumn("ts", F.col("s").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = state.first_sight(stream).writeStream.format("memory").queryName("sight").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.alias for r in spark.table("sight").collect()) == ["a", "b"]
    assert state.tumbling(df, "5 minutes").count() == 2 and state.sessions(df, "3 minutes").count() == 2


def test_cells_of_another_grid_are_opaque_keys(spark):
    """The impact join takes ready-made cell names as they are."""
    names = "cell string, adm2_id string, pop_total double, pop_0_14 double, pop_15_64 double, pop_65p double, pop_alt double, bld_count long, built_m2 double, health_count long, edu_count long, road_km double, flags_calidad string"
    rows = [(f"88{i:013x}", f"{i % 2:05d}", 10.0 * i, 1.0, 8.0, 1.0, 9.0 * i, i, 5.0, 1, 1, 0.5, None) for i in range(1, 9)]
    mmi = spark.createDataFrame([(r[0], 5.5 + k / 2) for k, r in enumerate(rows[:6])], "cell string, mmi double")
    gf = spark.createDataFrame([(rows[2][0], 0.2, None)], "cell string, ls_prob double, lq_prob double")
    hit = impact.join_impact(spark.createDataFrame(rows, names), mmi, gf)
    assert hit.count() == 6
    assert {r.adm2_id: r.pop_total_6 for r in impact.by_municipality(hit).collect()} == {"00000": 120.0, "00001": 80.0}
    assert [r.cell for r in fires.with_exposure(spark.createDataFrame([(rows[0][0], 3)], "cell string, detecciones long"), spark.createDataFrame(rows, names).select("cell", F.col("adm2_id").alias("country"), "pop_total")).collect()] == [rows[0][0]]
