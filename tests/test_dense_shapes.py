"""Shapes that lie over one another: rows tried follow what is found, sides that grow are not broadcast, results are plain ones."""

import random

import pytest

from lahar.operators import polygons, prepared
from lahar.plans.shared import shared_cut


def crossed(lon, lat, es):
    return sum((y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in es) % 2 == 1


def d2(lon, lat, e):
    x1, y1, x2, y2 = e
    vx, vy = x2 - x1, y2 - y1
    t = max(0.0, min(1.0, ((lon - x1) * vx + (lat - y1) * vy) / (vx * vx + vy * vy)))
    return (lon - x1 - t * vx) ** 2 + (lat - y1 - t * vy) ** 2


@pytest.fixture(scope="module")
def dense(spark):
    rng = random.Random(11)
    at = lambda: round(rng.uniform(-8, 8) * 8) / 8  # noqa: E731 corners, points and the lines of cells fall together
    shapes = {}
    for k in range(60):
        x, y, r = at(), at(), rng.choice([0.25, 1.0, 4.0])
        ring = [(x + r, y), (x, y + r), (x - r, y), (x, y - r)]
        shapes[k] = [(*p, *q) for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
    points = [(i, at(), at()) for i in range(400)] + [(400 + i, rng.uniform(-9, 9), rng.uniform(-9, 9)) for i in range(400)] + [(900, 100.0, 50.0), (901, None, 1.0)]
    edges = spark.createDataFrame([(k, *e) for k, es in shapes.items() for e in es], "shape long, x1 double, y1 double, x2 double, y2 double")
    return shapes, points, edges, spark.createDataFrame(points, "id long, lon double, lat double")


def test_containing_and_prepared_equal_every_pair(spark, dense):
    shapes, points, edges, df = dense
    want = sorted((i, k) for i, lon, lat in points if lon is not None for k, es in shapes.items() if crossed(lon, lat, es))
    assert sorted(map(tuple, polygons.containing(df, edges).collect())) == want
    cut = shared_cut(spark)
    cover = prepared.cover(cut(edges), cut)
    assert sorted(map(tuple, prepared.holding(df, cover).collect())) == want


def test_few_shapes_are_tried_from_a_border_cell(spark, dense):
    """Squares of few long edges: a cover as coarse as the edges would be all border, and each point try all near shapes."""
    shapes, points, edges, _ = dense
    big = edges.where("abs(x2 - x1) > 2")
    table = prepared.cover(big, shared_cut(spark))[0]
    assert table.where("inside AND NOT border").count() > 40 * big.select("shape").distinct().count()


@pytest.mark.parametrize("bound", [0.05, 0.7, 6.0])
def test_nearest_equals_every_pair(spark, dense, bound):
    shapes, points, edges, df = dense
    want = {}
    for i, lon, lat in points:
        if lon is not None:
            far, k = min((min(d2(lon, lat, e) for e in es), k) for k, es in shapes.items())
            if far <= bound * bound:
                want[i] = (k, far)
    got = {r.id: (r.shape, r.d2) for r in polygons.nearest_within(df, edges, bound, cut=shared_cut(spark)).collect()}
    assert set(got) == set(want)
    for i, (k, far) in want.items():
        assert got[i][1] == pytest.approx(far, abs=1e-9) and (got[i][0] == k or d2(*points[i][1:], min(shapes[got[i][0]], key=lambda e: d2(*points[i][1:], e))) == pytest.approx(far, abs=1e-12))


def test_no_exploded_side_is_broadcast(dense):
    _, _, edges, df = dense
    for found in (polygons.nearest_within(df, edges, 0.5), polygons.containing(df, edges)):
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_dedupe_and_wind_broadcast_nothing(spark):
    """Exploded points grow past what a task holds; duplicates and points without coordinates stay as they are."""
    from lahar.operators import assets, fires

    first = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, None, 1.0)], "id long, lon double, lat double")
    later = spark.createDataFrame([(4, 0.001, 0.0), (5, 0.5, 0.5), (5, 0.5, 0.5), (6, None, 0.0), (7, 1.0, 1.02)], "id long, lon double, lat double")
    kept = assets.dedupe_points(first, later, 2000)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 5, 5, 6, 7]
    near = fires.wind_near(first.where("lon IS NOT NULL"), later.where("lon IS NOT NULL").select("lon", "lat", "id").withColumnRenamed("id", "speed"))
    assert sorted((r.id, r.speed) for r in near.collect()) == [(1, 4), (2, 7)]
    for found in (kept, near):
        assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()


def test_vertices_meet_only_shapes_that_may_hold_them(dense):
    """Of each shape one vertex is looked up; the others meet only shapes whose box holds the shape's box."""
    shapes, _, edges, _ = dense
    want = sorted((i, o) for i, es in shapes.items() for o, fs in shapes.items() if i != o and all(crossed(e[0], e[1], fs) for e in es))
    found = polygons.within_shape(edges)
    assert sorted(map(tuple, found.collect())) == want and want
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().sparkPlan().toString()
