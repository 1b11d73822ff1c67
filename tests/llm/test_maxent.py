import math
import random
import zlib
from collections import Counter

import numpy as np

from lahar.llm import maxent


def corpus():
    rng = random.Random(3)
    nxt = {w: rng.choices([f"w{j}" for j in range(60)], k=2) for w in [f"w{j}" for j in range(60)]}
    rows = []
    for i in range(400):
        w = [f"w{rng.randrange(60)}"]
        for _ in range(rng.randint(5, 60)):
            w.append(rng.choice(nxt[w[-1]]))
        rows.append((i, " ".join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return [*rows, (900, None), (901, ""), (901, ""), (902, "never seen words " * 300)]


def test_base_counts_and_held_out_gain(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = maxent.score(df).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    n, v = sum(count.values()), len(count)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        own = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(count[x] > 0 for x in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in own), rel_tol=1e-9)
        assert r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert maxent.score(df.limit(0)).collect() == []


def test_classes_sum_to_one_and_features_stop_at_texts():
    rng = np.random.default_rng(1)
    w, b = rng.normal(size=(3 * maxent.CELLS, maxent.CLASSES)).astype(np.float32), np.zeros(maxent.CLASSES, np.float32)
    rows = maxent.features(rng.integers(0, 1 << 32, 50).astype(np.uint32), np.array([0, 20]))
    assert np.allclose(np.exp(maxent._log_softmax(w, b, rows)).sum(1), 1, atol=1e-5)
    assert (rows[0] == rows[20]).all()


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 20, 5000).astype(np.uint32)
    rows, y = maxent.features(h, np.array([0])), np.roll(h, 1).astype(np.int64) % 5
    w, b, power = np.zeros((3 * maxent.CELLS, maxent.CLASSES), np.float32), np.zeros(maxent.CLASSES, np.float32), np.zeros(3 * maxent.CELLS, np.float32)
    loss = lambda: -maxent._log_softmax(w, b, rows)[np.arange(len(y)), y].mean()
    before = loss()
    maxent.descend(w, b, power, rows, y)
    assert loss() < before - 0.5


def test_gain_over_unigrams_on_the_test_table(spark):
    got = maxent.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    tokens = sum(r.n_tokens for r in got)
    assert (sum(r.score for r in got) - sum(r.base_score for r in got)) / tokens > 0.2


def test_a_context_sums_to_one():
    """In-class shares of a context over the whole vocabulary, never-seen words as one."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(200)).encode() for _ in range(5)]
    words, flat, sizes = maxent.word_counts(texts)
    names, first = list(words), np.cumsum(sizes) - sizes
    kinds = maxent._kinds(names)
    long = np.arange(2, len(names) + 2).astype(np.uint64)
    context, pair = maxent.pair_keys(long, kinds, flat, first, 60)
    counts, tokens = Counter(pair.tolist()), Counter(context.tolist())
    unigram = np.bincount(flat, minlength=len(names))
    for k in set(kinds.tolist()):
        own = np.flatnonzero(kinds == k)
        share = (unigram[own] + 1) / (unigram[own].sum() + len(own) + 1)
        for before in range(len(names)):
            row = np.array([before, *own.tolist()])
            keys = [maxent.pair_keys(long, kinds, np.array([before, w]), np.array([0]), 60) for w in own.tolist()]
            n = np.array([counts[int(p[1])] for _, p in keys])
            total = tokens[int(keys[0][0][1])]
            assert n.sum() == total, row
            p = (n + maxent.LEAN * share) / (total + maxent.LEAN)
            assert math.isclose(p.sum() + maxent.LEAN * (1 / (unigram[own].sum() + len(own) + 1)) / (total + maxent.LEAN), 1)
