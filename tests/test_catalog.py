"""Files by extent, rows by a filter that the scan sees."""

import pytest
from pyspark.sql import functions as F

from lahar.sources import catalog

SCHEMA = "id long, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def listing(spark, rows):
    return spark.createDataFrame(rows, "file string, extents array<array<double>>")


def test_extents(spark):
    rows = [("in", [[0.0, 0.0, 5.0, 5.0]]), ("out", [[20.0, 0.0, 25.0, 5.0]]), ("edge", [[10.0, 0.0, 12.0, 5.0]]), ("high", [[0.0, 0.0, -3.0, 5.0, 5.0, 9.0]]), ("unknown", None), ("none", []),
            ("union_only", [[0.0, 0.0, 50.0, 50.0], [20.0, 20.0, 50.0, 50.0], [0.0, 40.0, 5.0, 50.0]]), ("union", [[0.0, 0.0, 50.0, 50.0], [40.0, 40.0, 50.0, 50.0], [1.0, 1.0, 2.0, 2.0]]), ("date_line", [[170.0, 0.0, 3.0, 5.0]])]
    assert catalog.selected(listing(spark, rows), (2.0, 2.0, 10.0, 10.0)) == ["date_line", "edge", "high", "in", "none", "union", "unknown"]
    for bad in ([[1.0, 2.0, 3.0]], [[0.0, 0.0, 1.0, None]], [[]]):
        with pytest.raises(Exception, match="neither four nor six"):
            catalog.selected(listing(spark, [("x", bad)]), (0.0, 0.0, 1.0, 1.0))


def test_scan_reads_few_files_and_pushes_the_filter(spark, tmp_path):
    rows = []
    for k in range(8):
        some = [(10 * k + i, (10.0 * k + i, 0.0, 10.0 * k + i + 0.5, 1.0)) for i in range(10)]
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.parquet(f"file:{tmp_path}/f{k}")
        rows.append((f"file:{tmp_path}/f{k}", [[10.0 * k, 0.0, 10.0 * k + 9.5, 1.0]]))
    found = catalog.scan(spark, listing(spark, rows), (15.2, 0.5, 21.0, 3.0), SCHEMA)
    assert sorted(r.id for r in found.collect()) == [15, 16, 17, 18, 19, 20, 21]
    assert len(found.inputFiles()) == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "bbox.xmin" in pushed and "bbox.ymax" in pushed
    assert catalog.scan(spark, listing(spark, rows), (500.0, 0.0, 600.0, 1.0), SCHEMA).collect() == []
    assert found.select(F.col("bbox.xmin")).schema.fieldNames() == ["xmin"]
