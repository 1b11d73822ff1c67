import random
import re
from collections import defaultdict

from lahar.llm import mixing


def corpus():
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 80)), rng.choice(["a", "a", "a", "b", "c", "Ω", None])) for i in range(900)]
    return [*rows, (1000, None, "a"), (1001, "", "zero"), (7, rows[7][1], rows[7][2]), (None, "x y", "b")]


def test_targets_bounds_and_quotas(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, s, 3) for i, t, s in rows], "doc_id long, text string, source string, size int").repartition(4)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(2)).collect()))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            open_.discard(s)
        left = 1.5 * sum(sizes.values()) - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    source, taken = {i: s for i, _, s in rows}, defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 and 0 <= r.taken <= 2 * r.size and len(r.shards) * r.size == r.taken
        taken[s] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 80
    assert mixing.mix(df.limit(0)).collect() == []


def test_tree_keeps_quotas_exact(spark):
    quotas = spark.createDataFrame([(1, 1000), (2, 37), (3, 0), (4, 500)], "rank int, draws long")
    rows = mixing.split_quotas(quotas, 3).collect()
    by_rank, by_shard = defaultdict(int), defaultdict(int)
    for r in rows:
        by_rank[r["rank"]] += r.quota
        by_shard[r.shard] += r.quota
    assert dict(by_rank) == {1: 1000, 2: 37, 3: 0, 4: 500} and len(by_shard) == 8
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    share = [r.quota for r in rows if r["rank"] == 1]
    assert min(share) > 90 and max(share) < 160  # hypergeometric: near 125 in each of eight


def test_mixed_rows(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r.doc_id: len(r.shards) for r in mixing.mix(df).collect()}
    out = mixing.mixed_rows(df).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, n in taken.items() for _ in range(n))


def test_hypergeometric_quantiles(spark):
    """Against exact sums of binomials, from small numbers to large."""
    from fractions import Fraction
    from math import comb

    from pyspark.sql import functions as F

    cases = [(own, total, need, u) for own, total, need in [(0, 5, 2), (5, 5, 2), (1, 2, 1), (3, 10, 5), (40, 100, 50), (500, 8000, 4000), (7999, 8000, 1), (30000, 50000, 25000)] for u in (0.0, 0.001, 0.3, 0.5, 0.77, 0.9999)]
    df = spark.createDataFrame(cases, "own long, total long, need long, u double")
    got = df.select("*", mixing.hypergeometric(F.col("own"), F.col("total"), F.col("need"), F.col("u")).alias("x")).collect()
    for r in got:
        low, high = max(0, r.need - r.total + r.own), min(r.own, r.need)
        assert low <= r.x <= high
        if r.total > 10000:
            continue
        whole = comb(r.total, r.need)
        below = sum(comb(r.own, x) * comb(r.total - r.own, r.need - x) for x in range(low, r.x))
        upto = below + comb(r.own, r.x) * comb(r.total - r.own, r.need - r.x)
        assert float(Fraction(below, whole)) <= r.u + 1e-9 and (r.u < float(Fraction(upto, whole)) + 1e-9)


def test_taken_is_what_shards_draw(spark, monkeypatch):
    """Many shards and small blocks: every shard's rows are its quotas' blocks, disjoint within a pass."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    rows = mixing.mix(df, cap=2.0).collect()
    per = defaultdict(int)
    for r in rows:
        assert len(r.shards) * r.size == r.taken
        for x in r.shards:
            per[x] += r.size
    words = sum(per.values())
    assert len(per) == 32 and max(per.values()) < 2.2 * words / len(per)


def test_clashing_shard_column(spark):
    import pytest

    df = spark.createDataFrame([(i, "w w", "a", 5, 6, 7) for i in range(20)], "doc_id long, text string, source string, shard int, size int, _time int")
    assert mixing.mixed_rows(df, shard_col=None).columns == df.columns
    with pytest.raises(ValueError):
        mixing.mixed_rows(df)
