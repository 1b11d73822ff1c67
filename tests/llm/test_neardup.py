import random
import re
from pathlib import Path

import numpy as np

from lahar.llm import neardup
from lahar.llm.common import recorded

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(rows, width=5, percent=85):
    sets = []
    for i, t in rows:
        w = WORDS.findall(lower(t or ""))
        sets.append((i, {tuple(w[a : a + width]) for a in range(max(1, len(w) - width + 1))} if w else set()))
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and sets[a][0] is not None and sets[b][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        r = root(a)
        least[r] = min(least.get(r, i), i) if i is not None else i
    return sorted(((i, len(s), least[root(a)], i is None or i == least[root(a)]) for a, (i, s) in enumerate(sets)), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{j}" for j in range(3000)]
    passage = rng.choices(vocab, k=60)
    rows, base = [], []
    for _ in range(n):
        kind = rng.random()
        if base and kind < 0.55:
            w = list(rng.choice(base))
            for _ in range(rng.randint(0, 1 + len(w) // 60)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = rng.choices(vocab, k=rng.choice([0, 1, 3, 5, 6, 20, 60, 200, 400]))
            if rng.random() < 0.5:
                w[5:5] = passage
        base.append(w)
        rows.append((len(rows), rng.choice([" ", "\n"]).join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return [*rows, (1000, None), (1001, "  \t"), (1002, "Hi there"), (1003, "hi THERE"), (None, "hi there")]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(3)
        got = sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str)
        assert got == brute(rows)


def test_lists_with_many_components(spark, monkeypatch):
    """A small sketch, so that a common passage makes lists of unlike documents, and small groups."""
    monkeypatch.setattr(neardup, "K", 12)
    monkeypatch.setattr(neardup, "MISSED", 1e-4)
    monkeypatch.setattr(neardup, "FANOUT", 3)
    monkeypatch.setattr(neardup, "SALTS", 2)
    rows = corpus(3, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str) == brute(rows)


def test_chains_of_edits_and_bad_leaders(spark):
    """Copies of copies, each with one more edit: links only between neighbours of a chain, through long components."""
    rng = random.Random(5)
    w = [f"v{j}" for j in range(120)]
    rows = []
    for i in range(40):
        w = list(w)
        w[(7 * i) % 120] = f"edit{i}"
        rows.append((i, " ".join(w)))
    base = [f"b{j}" for j in range(200)]
    for i in range(60):  # edits of one text, of which many link with the text alone and some with none
        c = list(base)
        for _ in range(rng.randint(0, 5)):
            c[rng.randrange(200)] = f"z{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(c)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str) == brute(rows)


def test_unlike_documents_of_one_passage_make_no_pairs(spark, monkeypatch):
    """5,000 documents of 40 common and 16 own words: nearly all values of a sketch are shared, and no two link."""
    met = []
    plain = neardup._possible
    monkeypatch.setattr(neardup, "_possible", lambda pairs, *a: met.append(pairs.count()) or plain(pairs, *a))
    common = " ".join(f"c{j}" for j in range(40))
    rows = [(i, common + " " + " ".join(f"own{i}x{j}" for j in range(16))) for i in range(5000)]
    rows += [(9000 + i, f"own{i}x{0} " + rows[i][1]) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
    assert got == {i: i for i in range(5000)} | {9000 + i: i for i in range(3)}
    assert sum(met) <= 3 * len(rows)


def test_forms_of_one_template_make_few_pairs(spark, monkeypatch):
    """Each form has up to six edits, most of them some other form's too: hardly any link, and all share rare values."""
    met = []
    plain = neardup._possible
    monkeypatch.setattr(neardup, "_possible", lambda pairs, *a: met.append(pairs.count()) or plain(pairs, *a))
    rng = random.Random(8)
    rows = []
    for i in range(400):
        w = [f"w{j}" for j in range(150)]
        for j in rng.sample(range(0, 150, 6), rng.choice([2, 4, 5, 6])):
            w[j] = rng.choice(["", f"alt{j}", f"own{i}x{j}"])
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str) == brute(rows)
    assert sum(met) <= 10 * len(rows)


def test_parities_differ_in_no_more_bits_than_sets_in_values():
    rng = np.random.default_rng(3)
    for n in (0, 1, 20, 300, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        b = np.unique(np.concatenate([a[: len(a) * 9 // 10], rng.integers(0, 1 << 63, n // 10, np.uint64)]))
        differ = sum(int(x).bit_count() for x in (neardup.parities(a) ^ neardup.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))
        assert not len(a) or differ > 0


def test_very_long_text(spark):
    long = " ".join(f"t{j % 70000}x{j}" for j in range(150_000))
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "x" * 700_000), (4, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(df).collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_one_of_each_and_repeated_rows(spark):
    text = " ".join(f"x{i}" for i in range(40))
    df = spark.createDataFrame([(4, text, "a"), (4, text, "a"), (9, text + " y", "b"), (7, "", "c"), (8, None, "c")], "doc_id long, text string, kept string")
    assert sorted(r.doc_id for r in neardup.one_of_each(df).collect()) == [4, 7, 8]
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_rounds_leave_only_the_last_labels(spark):
    nodes = spark.createDataFrame([(b"%03d" % i, i) for i in range(30)], "node binary, id long")
    pairs = spark.createDataFrame([(b"%03d" % (i + 1), b"%03d" % i) for i in range(29)], "x binary, y binary")
    with recorded() as made:
        labels = neardup.components(neardup._grouped(pairs), nodes)
    rounds = [Path(x.removeprefix("file://")) for x in made if "neardup-labels" in x]
    assert len(rounds) > 3 and [x.exists() for x in rounds] == [False] * (len(rounds) - 1) + [True]
    assert {r.label.id for r in labels.collect()} == {0} and labels.count() == 30
