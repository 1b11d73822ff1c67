"""Rings of cell sets, and aliases over several polls."""

import random

from lahar.operators import events, outline, polygons
from lahar.plans.shared import shared_cut


def at(x, y):
    return x * (1 << 20) + y


def test_rings_of_small_sets(spark):
    frame = [(x, y) for x in range(10, 15) for y in range(10, 15) if (x, y) not in ((12, 12), (11, 11))]
    cells = [*frame, (12, 12), (20, 20), (21, 21), (30, 30), (31, 30), (30, 31)]  # a hole, two that touch at a corner, an L
    df = spark.createDataFrame([(at(*c),) for c in cells] * 2 + [(None,)], "cell long")
    corners = outline.outlines(df, shared_cut(spark))
    got = {r.polygon: [[(p.x, p.y) for p in ring] for ring in r.rings] for r in outline.multipolygons(corners).collect()}
    assert set(got) == {at(10, 10), at(20, 20), at(21, 21), at(30, 30)}
    outer, hole = got[at(10, 10)]
    assert set(outer) == {(10, 10), (15, 10), (15, 15), (10, 15)} and set(hole) == {(11, 11), (12, 11), (12, 12), (11, 12)}
    assert len(got[at(20, 20)]) == 1 and len(got[at(20, 20)][0]) == 5 and len(got[at(30, 30)][0]) == 7
    for rings in got.values():
        for k, ring in enumerate(rings):
            turn = sum(p[0] * q[1] - p[1] * q[0] for p, q in zip(ring, ring[1:], strict=False))
            assert ring[0] == ring[-1] and (turn > 0) == (k == 0)


def test_fill_of_the_outline_gives_the_cells_back(spark):
    rng = random.Random(7)
    cells = {(rng.randrange(100, 140), rng.randrange(60, 90)) for _ in range(900)}
    df = spark.createDataFrame([(at(*c),) for c in cells], "cell long")
    corners = shared_cut(spark)(outline.outlines(df, shared_cut(spark)))
    filled = polygons.polyfill(outline.edges_of(corners, 0), 0)
    assert sorted(r.cell for r in filled.collect()) == sorted(at(*c) for c in cells)
    assert outline.outlines(df.limit(0), shared_cut(spark)).collect() == []


def test_aliases_chain_over_polls(spark):
    feed = lambda rows: spark.createDataFrame([(r,) for r in rows], "ids array<string>")
    cut = shared_cut(spark)
    one = events.resolved(None, feed([["b", "a"], ["x"], ["p", "", None], [None], []]), cut)
    assert {r.alias: r.event for r in one.collect()} == {"a": "a", "b": "a", "x": "x", "p": "p"}
    two = events.resolved(one, feed([["b", "c"], ["c", "x"], ["n", "m"]]), cut)
    want = {"a": "a", "b": "a", "c": "a", "x": "a", "p": "p", "m": "m", "n": "m"}
    assert {r.alias: r.event for r in two.collect()} == want and two.count() == len(want)
    again = events.resolved(two, feed([["b", "c"], ["c", "x"], ["n", "m"]]), cut)
    assert sorted(map(tuple, again.collect())) == sorted(want.items())
