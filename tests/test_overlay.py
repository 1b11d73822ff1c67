"""Overlay against areas by hand, and against random sampling of the fills."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lahar.operators import overlay, polygons
from lahar.plans.shared import shared_cut


def edges(spark, shapes):
    rows = [(n, float(p[0]), float(p[1]), float(q[0]), float(q[1])) for n, rings in shapes for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
    return spark.createDataFrame(rows, "shape long, x1 double, y1 double, x2 double, y2 double")


def box(w, s, e, n):
    return [(w, s), (e, s), (e, n), (w, n)]


def area(df, *keys):
    return {tuple(r[k] for k in keys): r.area for r in overlay.areas(df, *keys).collect()}


OTHERS = [
    (box(1, 1, 3, 3), 1.0), (box(2, 0, 4, 2), 0.0), (box(0, 0, 2, 2), 4.0), (box(0.5, 0.5, 1, 1), 0.25), (box(-1, 0, 3, 2), 4.0), (box(1, 0, 3, 2), 2.0),
    (list(reversed(box(1, 1, 3, 3))), 1.0), ([(1, -1), (3, 1), (1, 3), (-1, 1)], 4.0), ([(0, 0), (2, 0), (1, 1)], 1.0),
]


@pytest.mark.parametrize("fill", list(overlay.FILLS))
def test_squares(spark, fill):
    """One square with others that touch, share borders, hold it, lie in it, or turn the other way."""
    a, b = edges(spark, [(1, [box(0, 0, 2, 2)])]), edges(spark, [(i, [ring]) for i, (ring, _) in enumerate(OTHERS)])
    got = area(overlay.overlay(a, b, fill, level=0), "b")
    for i, (ring, both) in enumerate(OTHERS):
        size = abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
        want = {"intersection": both, "difference": 4 - both, "union": 4 + size - both, "symmetric": 4 + size - 2 * both}[fill]
        assert got.get((i,), 0.0) == pytest.approx(want), i


def test_random_shapes_with_holes_add_up(spark):
    rng = random.Random(3)

    def star(n):
        ring = [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(n)]
        x, y = (sum(p[i] for p in ring) / n for i in (0, 1))
        from math import atan2

        return sorted(ring, key=lambda p: atan2(p[1] - y, p[0] - x))

    def small(r):
        x, y = (sum(p[i] for p in r) / len(r) for i in (0, 1))
        return [(x + (p[0] - x) / 3, y + (p[1] - y) / 3) for p in r]

    shapes = [star(rng.randrange(3, 14)) for _ in range(16)]
    a = edges(spark, [(i, [r, small(r)]) for i, r in enumerate(shapes[:8])]).cache()
    b = edges(spark, [(i, [list(reversed(r))]) for i, r in enumerate(shapes[8:])]).cache()
    own = {r.shape: r.area for r in polygons.signed_areas(edges(spark, [(i, [r]) for i, r in enumerate(shapes[:8])])).collect()}
    inter, diff = (area(overlay.overlay(a, b, f), "a", "b") for f in ("intersection", "difference"))
    assert len(diff) > 50  # pairs whose boxes touch
    for (i, j), x in diff.items():
        assert x + inter.get((i, j), 0.0) == pytest.approx(own[i] * 8 / 9, abs=1e-5)
    at = [(k, rng.uniform(-4, 4), rng.uniform(-4, 4)) for k in range(300)]
    points = spark.createDataFrame(at, "id long, lon double, lat double")
    in_a = {(r.id, r.shape) for r in polygons.containing(points, a).collect()}
    in_b = {(r.id, r.shape) for r in polygons.containing(points, b).collect()}
    result = overlay.overlay(a, b, "intersection").select(F.struct("a", "b").alias("shape"), *overlay.XY)
    got = {(r.id, r.shape.a, r.shape.b) for r in polygons.containing(points, result).collect()}
    assert got == {(k, i, j) for k, i in in_a for m, j in in_b if m == k}


def test_buffer_of_a_square_and_of_crossing_lines(spark):
    e = edges(spark, [(1, [box(0, 0, 2, 2)]), (2, [box(0, 0, 6, 6), box(1, 1, 5, 5)]), (3, [box(0, 0, 0.001, 0.001)])])
    got = area(overlay.buffered(e, 1.0, corners=4), "shape")
    assert got[(1,)] == pytest.approx(4 + 4 * 2 + 2)  # diamonds at the corners
    assert got[(2,)] == pytest.approx(36 + 4 * 6 + 2 - 2 * 2)  # of the hole, a square of side 2 is left
    assert got[(3,)] == pytest.approx(2, abs=0.01)


def test_simplify(spark):
    def plain(p, tol):
        def d(q, a, b):
            vx, vy = b[0] - a[0], b[1] - a[1]
            s = vx * vx + vy * vy
            t = max(0.0, min(1.0, ((q[0] - a[0]) * vx + (q[1] - a[1]) * vy) / s)) if s else 0.0
            return (q[0] - a[0] - t * vx) ** 2 + (q[1] - a[1] - t * vy) ** 2

        if len(p) < 3:
            return p
        m = max(range(1, len(p) - 1), key=lambda i: (d(p[i], p[0], p[-1]), -i))
        return [p[0], p[-1]] if d(p[m], p[0], p[-1]) <= tol * tol else plain(p[: m + 1], tol)[:-1] + plain(p[m:], tol)

    rng = random.Random(5)
    lines = [[(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(n)] for n in (1, 2, 3, 40, 200)] + [[(float(x), 0.0) for x in range(50)]]
    lines.append([*lines[3], lines[3][0]])
    df = spark.createDataFrame([(i, [(float(x), float(y)) for x, y in p]) for i, p in enumerate(lines)] + [(99, []), (98, None)], "shape long, ring array<struct<x: double, y: double>>")
    got = {r.shape: [tuple(p) for p in r.ring] for r in overlay.simplified(df, 2.0, shared_cut(spark)).collect()}
    assert got == {i: plain(p, 2.0) for i, p in enumerate(lines)}


def test_simplify_decides_ties_of_a_lattice_as_sql_does(spark, tmp_path):
    """Two vertices are exactly as far from their chord; squares by v * v take the other one and keep a vertex less."""
    import duckdb

    from lahar.plans import shape_queries

    duck = duckdb.connect()
    duck.execute(f"COPY (SELECT k::BIGINT AS c_custkey, 24 AS c_nationkey, 0.0::DOUBLE AS c_acctbal FROM (SELECT unnest([231785, 231822, 231865, 231872, 231909]) AS k)) TO '{tmp_path}/customer.parquet'")
    duck.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    want = duck.execute(shape_queries.SQL["overlay_simplify"]).fetchall()
    assert [tuple(r) for r in shape_queries.Q["overlay_simplify"](spark, str(tmp_path)).collect()] == want
    # a vertex without coordinates is never the farthest, as in SQL
    line = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 9.0), (2.0, None), (3.0, 0.0)])], "shape long, ring array<struct<x: double, y: double>>")
    assert sorted(r.i for r in overlay.kept_vertices(line, 2.0, shared_cut(spark)).collect()) == [0, 1, 3]


def test_lengths_on_the_ellipsoid(spark):
    """A degree of the equator, and of meridians at the equator, at 45 degrees and at the pole, in both axis orders."""
    rows = [(1, 0.0, 0.0, 1.0, 0.0, 111.31949), (2, 0.0, -0.5, 0.0, 0.5, 110.57428), (3, 9.0, 44.5, 9.0, 45.5, 111.13178), (4, 0.0, 89.0, 0.0, 90.0, 111.69387)]
    df = spark.createDataFrame([r[:5] for r in rows], "shape long, x1 double, y1 double, x2 double, y2 double")
    want = {r[0]: r[5] for r in rows}
    turned = df.select("shape", F.col("y1").alias("x1"), F.col("x1").alias("y1"), F.col("y2").alias("x2"), F.col("x2").alias("y2"))
    for got in (polygons.outline_km(df), polygons.outline_km(turned, flipped=True)):
        for r in got.collect():
            assert r.km == pytest.approx(want[r.shape], abs=2e-3)


def test_a_line_that_passes_a_point_twice_keeps_its_places(spark):
    ring = [(0.0, 0.0), (5.0, 5.0), (9.0, 0.0), (5.0, 5.0), (0.0, 9.0), (0.1, 8.9), (0.0, 0.0)]
    df = spark.createDataFrame([(1, ring)], "shape long, ring array<struct<x: double, y: double>>")
    kept = overlay.kept_vertices(df, 1.0, shared_cut(spark)).collect()
    assert sorted(r.i for r in kept) == [0, 1, 2, 4, 6] and all(tuple(r.p) == ring[r.i] for r in kept)


def test_small_buildings_beside_a_cell_border(spark):
    """Squares of 20 m whose middle lies 5 m east of a meridian between cells: all belong east of it."""
    from lahar.functions import grid
    from lahar.operators import assets

    shapes = [(k, [box(-100.00005, k * 0.873 - 40, -99.99985, k * 0.873 - 40 + 0.0002)]) for k in range(80)]
    got = assets.building_area(edges(spark, shapes), -2).select(grid.ix_of(F.col("cell")).alias("ix"), "buildings").groupBy("ix").agg(F.sum("buildings")).collect()
    assert [tuple(r) for r in got] == [(20, 80)]


def test_pair_areas_are_those_of_outlines(spark, monkeypatch):
    """Stars with holes, crossing and doubled rings, shapes in several parts, many tiles, spikes without an inside."""
    rng = random.Random(11)
    ring = lambda: [(rng.randrange(80) / 8, rng.randrange(80) / 8) for _ in range(rng.randrange(3, 12))]
    spike = [(2.0, 2.0), (5.0, 5.0)]
    shapes = [[ring() for _ in range(rng.randrange(1, 3))] for _ in range(14)]
    shapes += [[spike], [box(1, 1, 4, 4)] * 2, [box(20, 20, 21, 21)], [box(0, 0, 9, 9), box(0, 0, 3, 3)]]
    a, b = edges(spark, list(enumerate(shapes))[::2]).cache(), edges(spark, list(enumerate(shapes))[1::2]).cache()
    monkeypatch.setattr(overlay, "PART", 4)
    pairs = {tuple(r) for r in overlay.meeting(a, b).collect()}
    want = area(overlay.overlay(a, b, "intersection"), "a", "b")
    own = {r.shape: r.area for e in (a, b) for r in overlay.areas(overlay.outlined(e), "shape").collect()}
    plain = {"intersection": lambda x, p, q: x, "difference": lambda x, p, q: p - x, "union": lambda x, p, q: p + q - x, "symmetric": lambda x, p, q: p + q - 2 * x}
    found = overlay._shared(a, b, shared_cut(spark), tile=3).cache()
    for fill, of in plain.items():
        got = overlay.filled(found, fill).collect()
        assert len(got) == len(pairs) and {(r.a, r.b) for r in got} == pairs
        for r in got:
            assert r.area == pytest.approx(of(want.get((r.a, r.b), 0.0), own.get(r.a, 0.0), own.get(r.b, 0.0)), abs=3e-6)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()  # pairs meet in tiles, and no edges of pairs are shuffled


def test_edges_and_pieces_are_shuffled_once(spark):
    """Pairs of edges and counted pieces stay where they were made."""
    e = edges(spark, [(k, [box(k, 0, k + 2, 2), box(k + 1, 1, k + 3, 3)]) for k in range(9)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = overlay.arranged(e.select(F.col("shape").alias("g"), *overlay.XY, F.lit(1).alias("wa"), F.lit(0).alias("wb")), 0)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(found.where("ra = 2 OR la = 2").collect()) == 9 * 4  # both squares' sides around what they share
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(g" in plan
    for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):  # by (g, e) or (g, row), never by coordinates
        assert len(keys.split(", ")) == 3, keys
