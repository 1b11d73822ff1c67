"""Rules of reports behind their sources, lists and formats that the whole tables don't show."""

import pytest
from pyspark.sql import functions as F

from lahar.operators import assets, events, fires
from lahar.plans.shared import shared_cut
from lahar.sources import readers, writers


def test_report_lag_tells_unknown_from_current(spark):
    reports = spark.createDataFrame(
        [("same", "CO", "m1", "us", 3, "us", 1), ("number", "CO", "m1", "us", 2, "us", 1), ("who", "CO", "m1", "atlas", 9, "us", 1), ("asset", "EC", "m1", "us", 3, "us", 1)]
        + [("gone", "CO", "m0", "us", 3, "us", 1), ("unasked", "CO", "m1", "us", 3, "us", 1), ("nocountry", "PE", "m1", "us", 3, "us", 1), ("bare", "PE", None, "us", 3, "us", 1), ("old", None, "", None, None, None, None)],
        "event string, country string, manifest string, shake_by string, shake int, ground_by string, ground int",
    )
    live = spark.createDataFrame([(e, "us", 0 if e == "gone" else 3, "us", 1) for e in ("same", "number", "who", "asset", "gone", "nocountry", "bare", "old")], "event string, shake_by string, shake int, ground_by string, ground int")
    manifests = spark.createDataFrame([("CO", "m1"), ("EC", "m2")], "country string, current string")
    got = {r.event: (r.outcome, r.behind, r.shake_gap) for r in events.report_lag(reports, live, manifests).collect()}
    assert got == {
        "same": ("current", "", 0), "number": ("behind", "shake", 1), "who": ("behind", "shake", -6), "asset": ("behind", "manifest", 0), "gone": ("gone", "manifest", -3),
        "unasked": ("unknown", None, None), "nocountry": ("unknown", None, None), "bare": ("current", "", 0), "old": ("behind", "shake,ground", 3),
    }
    assert events.report_lag(reports.limit(0), live, manifests).count() == 0


def _grid(spark, n, lat=4, spec=True):
    said = f'<grid_specification lon_min="-75" lat_min="4" lon_max="-74" lat_max="4" nlon="{n}" nlat="1"/>' if spec else ""
    return spark.createDataFrame([(f'<g>{said}<grid_field index="1" name="LON"/><grid_field index="2" name="LAT"/><grid_field index="3" name="MMI"/><grid_data>\n-75 {lat} 5.5\n-74 4 6.1\n</grid_data></g>',)], "value string")


@pytest.mark.parametrize(("text", "error"), [({"n": 3}, "not as many"), ({"n": 2, "lat": 5}, "not in the order"), ({"n": 2, "spec": False}, "no grid_specification")])
def test_grids_that_contradict_themselves(spark, text, error):
    with pytest.raises(Exception, match=error):
        readers.xml_points(_grid(spark, **text)).collect()
    assert readers.xml_points(_grid(spark, 2)).count() == 2


def test_grib_round_trip_at_odd_widths(spark):
    rows = spark.createDataFrame([("a", [None, 65535, 0, 7, None, 1, 2, 3, 4]), ("b", [None] * 9)], "path string, v array<int>")
    content = writers.grib2_message(F.col("v"), 3, 3, 10_000_000, 285_000_000, 250_000, 2, 3)
    got = readers.grib2_values(rows.select("path", content.alias("content"))).toPandas()
    a = got[got.file == "a"].sort_values(["lat", "lon"], ascending=[False, True])
    assert a.value.fillna(-1).tolist() == [-1, 65535, 0, 7, -1, 1, 2, 3, 4] and a.lat.tolist()[::3] == [10.0, 9.75, 9.5]
    assert got[got.file == "b"].value.isna().all() and set(got.category) == {2} and set(got.number) == {3}


def test_projected_rasters_are_refused(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    with pytest.raises(ValueError, match="geographic"):
        assets.sampled_layers(points, {"x": None}, 0, 0, 1, 1, crs="EPSG:3857")
    assert assets.sampled_layers(points, {"x": None}, 0, 0, 1, 1).first().x == 0.0


def test_lists_hold_ties_and_missing_figures(spark):
    rows = spark.createDataFrame([(k, None if k == 5 else float(k // 2)) for k in range(70)], "cluster long, people double")
    got = fires.listed(rows, "people").orderBy("place").collect()
    assert [r.cluster for r in got[:4]] == [68, 69, 66, 67] and len(got) == 60 and {r.of for r in got} == {70}
    quakes = spark.createDataFrame([(1, None, 0.0), (2, -1.0, 0.0), (3, 2.0, None)], "event long, mag double, people double")
    assert [r.event for r in events.listed(quakes, "magnitude", shared_cut(spark)).orderBy("place").collect()] == [3, 1, 2]
    assert [r.event for r in events.listed(quakes, "people", shared_cut(spark)).orderBy("place").collect()] == [1, 2, 3]


def test_coverage_of_unmeasured_countries(spark):
    rows = spark.createDataFrame([("A", 110, 100), ("B", 0, 100), ("C", 50, None), ("D", 80, 100)], "country string, measured long, reference long")
    covered = events.coverage(rows)
    assert {r.country: r.deviation_pct for r in covered.collect()} == {"A": 10.0, "B": None, "C": None, "D": -20.0}
    assert tuple(events.coverage_summary(covered).first()) == (4, 3, 240, 20.0)
    assert tuple(events.coverage_summary(covered.limit(0)).first()) == (0, 0, 0, None)
