import hashlib
import random
import re
from collections import Counter

from lahar.llm import common, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[a : a + width]) for _, w in words for a in range(len(w) - width + 1))
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - width + 1):
            if seen[tuple(w[a : a + width])] > 1:
                gone |= set(range(a, a + width))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"w{j}é" for j in range(400)]
    passage = rng.choices(vocab, k=60)
    rows = []
    for i in range(n):
        w = rng.choices(vocab, k=rng.randint(0, 150))
        if i % 4 == 0:
            w[10:10] = passage
        if i % 10 == 0:
            w = w * 2
        rows.append((i, rng.choice([" ", "\n", "\t ", " x "]).join(w)))
    rows += [(n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, rows[5][1]), (n + 3, rows[5][1]), (n + 4, "same " * 500)]
    return rows


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(common, "BUCKET_BYTES", 10000)
    rows = corpus(1)
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, n_words int").repartition(5)
    for width in (5, 35):
        got = substrings.digest(substrings.repeated_words(df, width=width)).collect()
        assert sorted(map(tuple, got)) == brute(rows, width)


def test_small_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_cells", lambda a, b, row, size, f=substrings._cells: f(a, b, row, 50))
    rows = corpus(2, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substrings.digest(substrings.repeated_words(df)).collect())) == brute(rows, 35)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.repeated_words(df).collect() == []
