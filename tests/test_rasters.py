"""Text rasters in any number of splits, overviews, and cells that nothing is known of."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lahar.sources import rasters


@pytest.fixture
def file(tmp_path):
    rng = random.Random(1)
    grid = [[rng.choice([-9, 1, 2, 30, 444]) for _ in range(40)] for _ in range(300)]
    head = "ncols 40\nnrows 300\nxllcorner -70\nyllcorner 5\ncellsize 0.5\nNODATA_value -9\n"
    (tmp_path / "r.asc").write_text(head + "\n".join(" ".join(map(str, r)) for r in grid) + "\n")
    return f"file:{tmp_path}/r.asc", grid


@pytest.mark.parametrize("split", [1 << 27, 5000, 611])
def test_any_number_of_splits(spark, file, split):
    path, grid = file
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = {(r.row, r.col): (r.lon, r.lat, r.value) for r in rasters.text_raster(spark, path).collect()}
        parts = rasters.numbered_lines(spark, path).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {(r, c): (-70 + (c + 0.5) / 2, 155 - (r + 0.5) / 2, float(v)) for r, row in enumerate(grid) for c, v in enumerate(row) if v != -9}
    assert parts > 1 or split == 1 << 27


def test_windows_heads_and_overview(spark, file, tmp_path):
    path, grid = file
    assert {r.row for r in rasters.text_raster(spark, path, (7, 9)).collect()} == {7, 8}
    (tmp_path / "bad.asc").write_text("ncols 1\nnrows 1\n5\n")
    with pytest.raises(ValueError, match="xllcorner"):
        rasters.text_raster(spark, f"file:{tmp_path}/bad.asc")
    px = rasters.text_raster(spark, path).select("row", "col", F.col("value").cast("int").alias("code"))
    got = {(r.row, r.col): (r.code, r["class"]) for r in rasters.overview(px, 4, {1: "a", 2: "b", 30: "a"}).collect()}
    want = {}
    for r in range(75):
        for c in range(10):
            n = Counter(v for row in grid[4 * r : 4 * r + 4] for v in row[4 * c : 4 * c + 4] if v != -9)
            if n:
                code = min(n, key=lambda v: (-n[v], v))
                want[r, c] = (code, {1: "a", 2: "b", 30: "a"}.get(code))
    assert got == want
    cells = spark.createDataFrame([(1,), (2,), (13,)], "cell long")
    out = rasters.class_counts(cells, spark.createDataFrame([(1, "x"), (1, "x"), (99, "y")], "cell long, class string"), spark.createDataFrame([(0,), (0,)], "tile long"), F.floor(F.col("cell") / 10))
    assert sorted(map(tuple, out.collect())) == [(1, "x", 2, "measured"), (2, None, 0, "ocean"), (13, None, 0, "missing")]
