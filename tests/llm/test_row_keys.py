"""Null and shared ids through the pipeline's stages."""

from collections import Counter

import corpus_pipeline
from lahar.llm import mixing, neardup


def test_mixed_rows_with_null_and_shared_ids(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(60)]
    rows += [(None, "null " * k, "a") for k in range(1, 9)] + [(7, "shared " * k, "b") for k in range(1, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.mix(df).collect()
    out = mixing.mixed_rows(df).collect()
    assert {r.doc_id for r in taken if r.shards} == {r.doc_id for r in out} and None in {r.doc_id for r in out}
    size = lambda r: (r.doc_id, len(r.text.split()))
    assert Counter(map(size, out)) == Counter((r.doc_id, r.size) for r in taken for _ in r.shards)
    assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in taken)


def test_rows_of_one_id_are_judged_apart(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(1, text("a")), (5, text("a") + " y"), (5, text("b")), (5, text("c")), (6, text("b")), (None, text("b")), (None, text("d"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted(((r.doc_id, r.text) for r in neardup.one_of_each(df).collect()), key=str)
    assert left == sorted([rows[0], rows[2], rows[3], rows[5], rows[6]], key=str)


def test_stages_carry_null_and_shared_ids(spark, tmp_path):
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(None, text("n"), "en", "s"), (2, text("p"), "en", "s"), (2, text("q"), "en", "s"), (3, text("q") + " r", "en", "s")]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        if name == "near_dedup":
            assert docs.count() == 3
    assert {(r.doc_id, r.text) for r in docs.collect()} == {r[:2] for r in rows[:3]}


def test_stages_with_clashing_columns(spark, tmp_path):
    """Columns named like the operators' own, through every stage."""
    extra = ["letters", "posterior", "language", "text_language", "host", "kept", "n_removed", "n_lines", "shard", "shards", "size", "taken", "target", "component", "node", "value", "id", "row", "_time", "_order", "ids", "decoded"]
    text = lambda x: " ".join(f"{x}{chr(97 + i)}" for i in range(24)) + "\nshared line of many documents"
    rows = [(i, text("abcdefgh"[i % 8]), "en", "st"[i % 2], 9, *range(len(extra))) for i in range(16)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert {tuple(r)[5:] for r in docs.collect()} == {tuple(range(len(extra)))}
    assert corpus_pipeline.byte_bpe(spark, docs, str(tmp_path)).count() == docs.count()
