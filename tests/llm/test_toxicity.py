import random
import zlib

import numpy as np
import pytest

from lahar.llm import toxicity


def corpus(n=600):
    rng = random.Random(4)
    syllables = ["an", "ti", "re", "sho", "the", "ou", "er", "lin"]
    bad = ["worthless", "disgusting", "pathetic"]
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.4)
        if toxic:
            for _ in range(1 + len(w) // 12):
                word = rng.choice(bad)
                if i % 5 == 0:  # only held-out style misspellings
                    j = rng.randrange(1, len(word) - 1)
                    word = word[:j] + word[j + 1] + word[j] + word[j + 2 :]
                w[rng.randrange(len(w))] = word
        rows.append((i, " ".join(w), 9))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_accuracy(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 20)
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (9000, None, 1), (9001, "", 1), (9001, "", 1)], "doc_id long, text string, score int")
    known = spark.createDataFrame([*labels, (1, None), (77777, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, known, "toxic")
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + 3
    by = {r.doc_id: r.score for r in got}
    assert all(0 <= r.score <= 1 for r in got) and by[9000] == by[9001]
    import zlib

    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((by[i] >= 0.5) == bool(y) for i, y in held) / len(held) > 0.85


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), "toxic")
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5]
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_labels_without_documents_do_not_use_up_the_sample(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    orphans = spark.range(10_000, 18_000).selectExpr("id AS doc_id", "1 AS toxic")
    score = lambda k: [r.score for r in toxicity.score(docs, toxicity.train(docs, k, "toxic", max_rows=300)).orderBy("doc_id").collect()]
    assert score(known) == score(known.union(orphans))


def test_bounded_bytes(spark):
    docs = spark.createDataFrame([(i, "word " * 1000) for i in range(20)], "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    model = toxicity.train(docs, known, "toxic", max_bytes=12_000)
    assert model.weight.shape == (toxicity.SUBWORDS,)
    long = spark.createDataFrame([(1, "plain words " * 200_000)], "doc_id long, text string")
    assert 0 <= toxicity.score(long, model).head().score <= 1


def test_scores_are_means_of_means(spark):
    """score() against the model's definition, word by word and n-gram by n-gram."""
    import numpy as np

    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(size=toxicity.SUBWORDS).astype(np.float32), 0.3)
    texts = ["some words here", "MIXED case Mixed", "a", "", None, "ünïcode wörd", "twice twice once"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(docs, model).collect():
        words = (texts[r.doc_id] or "").encode().split()
        means = []
        for w in words:
            _, cells = toxicity.subwords([w])
            marked = f"<{w.decode().lower()}>"
            assert len(cells) == 1 + sum(max(0, len(marked) - n + 1) for n in range(3, 7))
            means.append(np.mean([model.weight[c] for c in cells], dtype=np.float64))
        want = 1 / (1 + np.exp(-(0.3 + (np.mean(means) if means else 0))))
        assert abs(r.score - want) < 1e-6


@pytest.mark.parametrize("texts", ["one", "many"])
def test_documents_of_one_id_are_one_row_each(spark, monkeypatch, tmp_path, texts):
    """40 documents of a labelled id are 40 rows of the fit, and the bound on bytes holds for them."""
    seen = str(tmp_path / "rows")

    def noted(rows, labels):
        with open(seen, "w") as f:
            f.write(f"{len(rows)} {sum(map(len, rows))}")
        return toxicity.Model(np.zeros(toxicity.SUBWORDS, np.float32), 0.0)

    monkeypatch.setattr(toxicity, "fit", noted)
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5 != 0][:10]
    docs = [(ids[0], f"word{0 if texts == 'one' else i} " * 10) for i in range(40)] + [(i, "other words") for i in ids[1:]]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in ids] * 2, "doc_id long, toxic int")
    toxicity.train(d, labels, "toxic")
    rows, size = map(int, open(seen).read().split())
    assert rows == 49 and size == sum(len(t) for _, t in docs)
    toxicity.train(d, labels, "toxic", max_bytes=200)
    assert int(open(seen).read().split()[1]) < 200 + 80
    toxicity.train(d, labels, "toxic", max_rows=7)
    assert open(seen).read().split()[0] == "7"
