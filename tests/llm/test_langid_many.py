from pyspark.sql import functions as F

from lahar.llm import langid


def test_languages_after_the_256th_count(spark):
    name = lambda k: f"l{k:03d}"
    words = lambda k: " ".join(chr(0x4E00 + 40 * k + j) * 3 for j in range(12))
    docs = spark.createDataFrame([(k, words(k), name(k)) for k in range(300)], "doc_id long, text string, lang string")
    model = langid.text_model(docs)
    assert model[0] == [name(k) for k in range(300)]
    rows = spark.createDataFrame([(1, words(299), None), (2, "", "l298"), (3, words(5), None)], "doc_id long, text string, declared string")
    got = langid.identify(rows, model, ["doc_id"], F.col("text"), F.col("declared"), F.lit("h.example.com")).collect()
    assert {r.doc_id: r.language for r in got} == {1: "l299", 2: "l298", 3: "l005"}
