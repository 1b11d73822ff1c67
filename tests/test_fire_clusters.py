"""Clusters of every fire cell."""

import os

from pyspark.sql import functions as F

from lahar.plans import adapter as a
from lahar.plans import fire_queries, registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_no_fire_cell_is_left_out(spark):
    found = registry.queries()
    want = {r.cell for r in fire_queries._fires(spark, DIR, a.FINE).select("cell").collect()}
    labels = {r.cell: r.cluster for r in found["graph_fire_clusters"](spark, DIR).collect()}
    assert set(labels) == want and any(c % 3 == 0 for c in want)
    for c, k in labels.items():
        for step in (1, (1 << 20) - 1, 1 << 20, (1 << 20) + 1):
            assert labels.get(c + step, k) == k
    sums = found["a34_a35_cluster_summary"](spark, DIR).agg(F.sum("celdas").alias("n"), F.sum("detecciones").alias("seen")).head()
    assert sums.n == len(want)
    assert sums.seen == a.detections(spark, DIR).where("confidence <> 'low'").count()
