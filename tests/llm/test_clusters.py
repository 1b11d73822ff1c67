"""Clustering against measuring everything, in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from lahar.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def brute(rows, k, rounds, seed, dim, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min(range(len(c)), key=lambda j: (far(v, c[j]), j)) for _, v in kept]
    for _ in range(rounds):
        own = assign()
        for j in range(len(c)):
            some = [v for (_, v), a in zip(kept, own, strict=True) if a == j]
            if some:
                c[j] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    own = assign()
    d = [far(v, c[a]) for (_, v), a in zip(kept, own, strict=True)]
    sha = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c]
    return [(i, a, x, sum(y for y, b in zip(d, own, strict=True) if b == a), sum(d), sha[a]) for (i, _), a, x in zip(kept, own, d, strict=True)]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize(("k", "rounds"), [(40, 5), (7, 9), (3, 2), (2, 3), (1, 2), (12, 0)])
def test_matches_measuring_everything(spark, k, rounds):
    rng = np.random.default_rng(k)
    middle = rng.normal(size=(9, 6)) * 3
    rows = [(i, [float(x) for x in middle[i % 9] + rng.normal(size=6)]) for i in range(600)]
    df = spark.createDataFrame([(i, v, "n", 1) for i, v in rows], SCHEMA).repartition(5)
    assert in_order(clusters.clustered(df, k, rounds, 2, 6).collect()) == in_order(brute(rows, k, rounds, 2, 6))


def test_ties_repeats_nulls_and_other_lengths(spark):
    rows = [(i % 11, [float(i % 3) / 256, float(i % 2) / 256]) for i in range(90)]  # many ties, shared ids, equal vectors
    rows += [(None, [0.5, 0.5]), (90, None), (91, [1.0]), (92, [None, 1.0]), (93, [float("nan"), 1.0]), (94, [float("inf"), 1.0]), (95, [-0.001, 3000.0])]
    df = spark.createDataFrame([(i, v, "n", 1) for i, v in rows], SCHEMA)
    for k in (5, 40, 200):
        assert in_order(clusters.clustered(df, k, 4, 2, 2).collect()) == in_order(brute(rows, k, 4, 2, 2))
    assert clusters.clustered(df.limit(0), 5, 4, 2, 2).collect() == []


def test_large_components_are_exact_and_held(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-(1 << 18), 1 << 18, 4) * rng.choice([1, 1e-3])]) for i in range(80)]
    df = spark.createDataFrame([(i, v, "n", 1) for i, v in rows], SCHEMA)
    assert in_order(clusters.clustered(df, 6, 3, 2, 4).collect()) == in_order(brute(rows, 6, 3, 2, 4))
    got = clusters.clustered(spark.createDataFrame([(1, [1e300, 0.0], "", 1), (2, [-1e300, 0.0], "", 1)], SCHEMA), 1, 1, 2, 2).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(1, 1 << 54), (2, 1 << 54)]


def test_bounds_spare_work_and_stay_true():
    rng = np.random.default_rng(2)
    x = rng.integers(-99, 99, (500, 8)) + 400 * rng.integers(0, 9, (500, 1))
    c = x[:24].copy()
    b = clusters.Bounds.measured(x, c, 6)
    new = c + rng.integers(-2, 3, c.shape)
    drift = np.sqrt(clusters.apart(new, c).astype(float)) * (1 + 1e-12)
    looked = (b.high + drift[b.cluster] >= b.low[:, 0] - drift.max()).mean()
    depth = b.moved(x, new, drift)
    assert looked < 0.9 and depth <= 7
    d = clusters.between(x, new)
    assert (b.cluster == d.argmin(1)).all()
    assert (b.high.astype(float) ** 2 >= d.min(1)).all()
    for z in range(6):
        assert (b.low[:, z].astype(float) <= np.sqrt(d[np.arange(500), b.near[:, z]])).all()
    slim = b.narrowed(3)
    rest = np.array([[j not in (a, *n) for j in range(24)] for a, n in zip(slim.cluster, slim.near, strict=True)])
    assert (slim.low[:, 3].astype(float) <= np.sqrt(np.where(rest, d, 1 << 60).min(1))).all()
