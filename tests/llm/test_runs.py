"""Periodic runs against every period and start tried by hand."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lahar.llm import queries, runs

DIR = "/root/testdata/sf0.001"


def brute(w, min_length=6, min_power=4):
    """All runs, by trying every period at every place."""
    n, best = len(w), {}
    for q in range(1, n // min_power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_power * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in best.items())


def digest(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{a},{m},{q}\n" for a, m, q in found)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(lines.encode()), sha(kept))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(300):
        w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            block = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
            at = rng.randrange(len(w) + 1)
            w[at:at] = (block * 9)[: rng.randrange(1, 9 * len(block))]
        texts.append(w)
    size = np.array([len(w) for w in texts])
    codes = np.array([x for w in texts for x in w], np.int64)
    for length, power in ((6, 4), (4, 2), (9, 3)):
        start, end, q = runs.runs_of(codes, np.repeat(np.arange(len(texts)), size), length, power)
        first = np.cumsum(size) - size
        doc = np.searchsorted(np.cumsum(size), start, "right")
        got = sorted(zip(doc.tolist(), (start - first[doc]).tolist(), (end - start).tolist(), q.tolist(), strict=True))
        assert got == sorted((d, *r) for d, w in enumerate(texts) for r in brute(w, length, power))


def test_masking_loses_nothing_and_drops_something():
    assert runs.least_overlap(6, 4) == 5
    w = np.array([*range(100), *[7, 8] * 5, *range(200, 300)], np.int64)
    inside = runs.in_repeated(w, np.zeros(len(w), np.int64), 5)
    assert inside[100:110].all() and inside.sum() == 10


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.QUERIES["op13_word_runs"](spark, DIR).collect()]
    assert sorted(got) == sorted(digest(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in got) >= len(docs) // 20


def test_nulls_repeats_long_texts_and_other_columns(spark):
    rows = [(None, "a b " * 20), (1, None), (2, ""), (3, "x " * 6), (3, "x " * 6), (3, "x " * 5), (4, "w1 w2 w3 w4 " * 400 + "end"), (5, " \t\n "), (10, "one two"), (6, "  ".join("abc" * 9))]
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, runs string, id int")
    got = runs.digest(runs.word_runs(runs.looped(df))).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r[:6]) + tuple(r[6:])
    assert sorted((tuple(r) for r in got), key=key) == sorted((digest(i, t) for i, t in rows), key=key)
    assert runs.digest(runs.word_runs(runs.looped(df.limit(0)))).collect() == []


def test_one_long_text(spark):
    """Trying every period by hand would take hours here; the answer is known."""
    df = spark.createDataFrame([(7, "start " + "w1 w2 w3 w4 " * 50_000 + "end")], "doc_id long, text string")
    r = runs.word_runs(df).head()
    assert r.n_words == 200_002 and [tuple(x) for x in r.runs] == [(1, 200_000, 4)] and r.kept == "start w1 w2 w3 w4 end"


def test_blocks_beyond_the_end_equal_no_others():
    """Numbers of two halves, one of them beyond the end, could be those of a block that is there: an index error in ahead()."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(8, 60))
        s = rng.integers(0, int(rng.integers(1, 5)), n)
        s[0], s[-1] = -1, -2
        blocks = runs._Blocks(s, n - 2)
        i, j = (x + 1 for x in np.triu_indices(n - 2, 1))
        got = blocks.ahead(i, j)
        for a, b, k in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
            want = next((d for d in range(n - b) if s[a + d] != s[b + d]), n - b)
            assert k == want
