"""Components and clusters against a plain search."""

import random

import pytest

from lahar.operators import fires, graph
from lahar.plans.shared import shared_cut


def plain(edges):
    to = {}
    for x, y in edges:
        to.setdefault(x, set()).add(y)
        to.setdefault(y, set()).add(x)
    root = {}
    for n in sorted(to):
        todo = [n] if n not in root else []
        while todo:
            m = todo.pop()
            if m not in root:
                root[m] = n
                todo += to[m]
    return root


@pytest.mark.parametrize("kind", ["path", "star", "random", "loops"])
def test_components(spark, kind):
    rng = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 200)] + [(i, 1000 + i) for i in range(1, 200)],
        "random": [(rng.randrange(600), rng.randrange(600)) for _ in range(280)],
        "loops": [(1, 1), (2, 2), (2, 3), (None, 4), (5, None)],
    }[kind]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "x long, y long")
    got = [(r.node, r.root) for r in graph.components(df, shared_cut(spark)).collect()]
    assert len(got) == len(set(got)) and dict(got) == plain([e for e in edges if None not in e])


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "x long, y long"), shared_cut(spark)).collect() == []


@pytest.mark.parametrize("diagonal", [True, False])
def test_clusters_across_blocks(spark, diagonal):
    rng = random.Random(4)
    cells = {(rng.randrange(60, 200), rng.randrange(60, 200)) for _ in range(6500)}
    steps = [(1, 0), (0, 1)] + ([(1, 1), (1, -1)] if diagonal else [])
    at = lambda x, y: x * (1 << 20) + y
    edges = [(at(x, y), at(x + i, y + j)) for x, y in cells for i, j in [(0, 0), *steps] if (x + i, y + j) in cells]
    df = spark.createDataFrame([(at(x, y),) for x, y in cells] * 2 + [(None,)], "cell long")
    got = [(r.cell, r.cluster) for r in fires.clusters(df, diagonal, shared_cut(spark)).collect()]
    assert len(got) == len(cells) and dict(got) == plain(edges)
    assert 20 < len(set(dict(got).values())) < 3000


def test_rows_of_each_round_fall(spark):
    seen = []

    def counted(df):
        out = shared_cut(spark)(df)
        if set(out.columns) == {"x", "y"}:
            seen.append(out.count())
        return out

    rng = random.Random(6)
    df = spark.createDataFrame([(rng.randrange(3000), rng.randrange(3000)) for _ in range(4000)], "x long, y long")
    graph.components(df, counted).count()
    assert len(seen) <= 6 and all(b < 0.6 * a for a, b in zip(seen, seen[1:], strict=False))
