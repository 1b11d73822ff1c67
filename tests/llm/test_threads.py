"""Two queries beside each other keep their own folders."""

import threading

from lahar.llm import mixing, neardup
from lahar.llm.common import cut, recorded

DIR = "/root/testdata/sf0.001"


def test_recorders_belong_to_their_thread(spark):
    seen = {}

    def other():
        with recorded() as made:
            cut(spark.range(1), "threads")
            seen["other"] = list(made)

    with recorded() as outer, recorded() as inner:
        cut(spark.range(1), "threads")
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert len(outer) == len(inner) == 1 and len(seen["other"]) == 1 and seen["other"] != inner
        with recorded() as same:
            pass
        assert same == [] and len(outer) == 1


def test_near_duplicates_and_mixing_side_by_side(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    want = {n: sorted(map(tuple, f(docs).select(*c).collect())) for n, f, c in (("near", neardup.near_duplicates, ("doc_id", "component_id")), ("mix", mixing.mix, ("doc_id", "taken")))}
    got, failed = {}, []

    def run(name, f, columns):
        try:
            got[name] = sorted(map(tuple, f(docs).select(*columns).collect()))
        except Exception as e:
            failed.append((name, e))

    both = [threading.Thread(target=run, args=x) for x in (("near", neardup.near_duplicates, ("doc_id", "component_id")), ("mix", mixing.mix, ("doc_id", "taken")))]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert not failed and got == want
