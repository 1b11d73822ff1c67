"""Messages between chunks and buckets grow with the input, not with chunks times buckets."""

import zlib

import numpy as np

from lahar.llm import common


def test_messages_grow_with_the_input(spark):
    per_text = []
    for size in (400, 1600, 6400):
        docs = spark.range(size).selectExpr("id", "concat_ws(' ', transform(sequence(0, 9), k -> concat('w', (id * 7919 + k * k * 31) % 100000))) AS text")
        buckets = size // 2  # grows with the input, as do the chunks

        def ask(ids, texts, buckets=buckets):
            words = sorted({w for t in texts for w in t.split()})
            place = np.array([zlib.crc32(w) % buckets for w in words])
            return len(words), [(b, [words[i] for i in at.tolist()]) for b, at in common.dealt(place)]

        parts = common.cut_up(docs.repartition(4), ask, limit=1000)
        chunks = parts.where("bucket < 0").count()
        messages = parts.where("bucket >= 0").count()
        assert messages <= 10 * size and chunks > size / 12
        per_text.append((messages + chunks) / size)
    assert max(per_text) < 12 and max(per_text) / min(per_text) < 1.4


def test_answers_come_back_to_their_chunk(spark):
    docs = spark.createDataFrame([(i, f"a{i % 7} b{i % 11}" if i % 5 else None) for i in range(200)], "id long, text string")

    def ask(ids, texts):
        words = sorted({w for t in texts for w in (t or b"").split()})
        counts = {w: sum((t or b"").split().count(w) for t in texts) for w in words}
        place = np.array([zlib.crc32(w) % 3 for w in words], np.int64)
        return (ids, place, words), [(b, [(words[i], counts[words[i]]) for i in at.tolist()]) for b, at in common.dealt(place)]

    def answer(questions):
        total: dict = {}
        for q in questions:
            for w, c in q:
                total[w] = total.get(w, 0) + c
        return [[total[w] for w, _ in q] for q in questions]

    def finish(kept, got):
        import pyarrow as pa

        ids, place, words = kept
        told = {words[i]: c for b, at in common.dealt(place) for i, c in zip(at.tolist(), got[b], strict=True)}
        yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([min([*told.values(), 99])])], ["n", "least"])

    got = common.answered(common.cut_up(docs, ask, limit=500), 5, answer, finish, "n long, least long").collect()
    assert sum(r.n for r in got) == 200
    assert {r.least for r in got} <= {*range(12, 30), 99} and len(got) > 3


def test_no_shared_folder_on_a_cluster_is_an_error():
    import pytest

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: "spark://host:7077" if key == "spark.master" else default)

    with pytest.raises(RuntimeError):
        common.shared_folder(Session)
