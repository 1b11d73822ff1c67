from lahar.llm import lines


def test_fields_are_fields_at_two_sizes(spark):
    name = lambda k: "".join(chr(97 + int(c)) for c in f"{k:03d}")
    for n in (6, 40):
        rows = [(n * i + j, f"Posted in section {name(i)} by editor {name(j)}") for i in range(n) for j in range(n)]
        copies = [(10000 + k, "Posted in section q what else is there") for k in range(3)]
        df = spark.createDataFrame(rows + copies, "doc_id long, text string").repartition(3)
        left = {r.doc_id for r in lines.dedup_lines(df, leaf_shares=lines.SHARES).collect() if r.kept}
        assert left == {0, 10000}  # copies go though their words are rare in the leaf


def test_without_a_share_nothing_changes(spark):
    df = spark.createDataFrame([(i, f"one two three {'abc'[i % 3] * 3} five") for i in range(90)], "doc_id long, text string")
    assert sorted(r.doc_id for r in lines.dedup_lines(df).collect() if r.kept) == [0, 1, 2]
