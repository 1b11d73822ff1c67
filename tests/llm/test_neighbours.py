import numpy as np

from lahar.llm import neighbours


def brute(rows, is_query, k):
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)]
    out = []
    for qi, q in ok:
        if is_query(qi):
            near = sorted((-float(q @ v), i) for i, v in ok if i != qi and len(v) == len(q))[:k]
            out += [(qi, r, i, round(-s, 9)) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=12) * rng.choice([0.01, 1, 100])]) for i in range(300)]
    rows[20] = (20, rows[0][1])
    rows[21] = (21, rows[0][1])
    rows[40], rows[41], rows[60], rows[80] = (40, None), (41, [0.0] * 12), (60, [float("nan")] + [1.0] * 11), (80, [None] + [1.0] * 11)
    rows += [(1000, [1.0, 2.0]), (1001, [1.0, 3.0]), (1020, [float("inf"), 1.0])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == brute(rows, lambda i: i % 20 == 0, 20)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert neighbours.nearest(df, df).collect() == []


def test_extreme_magnitudes_and_ties(spark):
    """Products beyond a double are infinite and tie, subnormal vectors take part, and equal vectors go by id."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6) * 10.0 ** rng.integers(-3, 3)]) for i in range(100)]
    rows += [(100 + i, [1e200 * (1 + i), 1e190, 0.0, 0.0, 0.0, 1.0]) for i in range(8)]
    rows += [(200 + i, [5e-324 * (1 + i), 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(8)]
    rows += [(300 + i, [3.0, 1.0, 4.0, 1.0, 5.0, 9.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert len(got) == len(want)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(w[:3] for w in want)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(40, 9)) * 1e150, rng.normal(size=(50, 9)) * 1e-200
    parts = [neighbours.quantised(v) for v in (x, y)]
    (q8, qr, qs, qp, q1), (c8, cr, cs, cp, c1) = parts
    qi, ci, low, high = neighbours.tile_bounds((np.arange(40), q8, qr, qs, qp, q1), (np.arange(100, 150), c8, cr, cs, cp, c1), 5)
    true = x @ y.T
    assert (low <= true[qi, ci]).all() and (true[qi, ci] <= high).all()
    for i in range(40):
        assert set(np.argsort(-true[i])[:5]) <= set(ci[qi == i].tolist())
    assert len(qi) < 40 * 8


def test_shared_ids_and_equal_vectors(spark):
    """Rows of one id don't crowd out other ids of the same vector."""
    rows = [(0, [2.0, 1.0])] * 21 + [(1, [2.0, 1.0]), (2, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id = 0"), k=20).collect()
    assert sorted({(r.rank, r.vec_id, r.score) for r in got}) == [(1, 1, 5.0), (2, 2, 1.5)]
    rng = np.random.default_rng(8)
    for _ in range(3):
        some = rng.integers(-2, 3, (9, 3)).astype(float)
        rows = [(int(rng.integers(12)), [float(x) for x in some[rng.integers(9)]]) for _ in range(150)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        queries = [(i, v) for i, v in rows if i % 5 == 0 and any(v)]
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(df, df.where("vec_id % 5 = 0"), k=4).collect())
        want = []
        for i, v in queries:
            near = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i and any(w))[:4]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(near, 1)]
        assert got == sorted(want)
