"""Files that fail in every way, and Mollweide there and back."""

import gzip

from pyspark.sql import functions as F

from lahar.functions import geo
from lahar.sources import partial


def test_failures_are_rows(spark, tmp_path):
    whole = gzip.compress("\n".join(f"line {i}" for i in range(1000)).encode())
    files = {"plain.txt": b"a\nb\n", "whole.gz": whole, "cut.gz": whole[:-9], "two.gz": gzip.compress(b"x\n") + gzip.compress(b"y\n"), "noise.gz": b"not packed", "latin.txt": b"\xff\xfe\xff", "empty.txt": b"", "vanishes.txt": b"z\n"}
    for n, data in files.items():
        (tmp_path / n).write_bytes(data)
    paths = [str(tmp_path / n) for n in [*files, "nowhere.txt"]]
    lines = partial.lines_of(spark, paths)
    (tmp_path / "vanishes.txt").unlink()
    got = {r.file.rsplit("/", 1)[1]: (r.status, r.lines) for r in partial.outcome(spark, lines, paths).collect()}
    assert got == {"plain.txt": ("read", 2), "whole.gz": ("read", 1000), "cut.gz": ("failed", 0), "two.gz": ("read", 2), "noise.gz": ("failed", 0), "latin.txt": ("failed", 0), "empty.txt": ("silent", 0), "vanishes.txt": ("silent", 0), "nowhere.txt": ("failed", 0)}
    assert [r.line for r in lines.where("file LIKE '%plain%'").orderBy("place").collect()] == ["a", "b"]
    assert partial.outcome(spark, partial.lines_of(spark, paths[-1:]), paths[-1:]).head().error == "missing"


def test_mollweide_there_and_back(spark):
    at = [(float(lon), float(lat)) for lon in (-180, -77.3, 0, 12.5, 179.9) for lat in (-89.99, -89, -60.001, -60, -1e-9, 0, 33.3, 59.9, 75, 89.9)]
    df = spark.createDataFrame([*at, (5.0, 90.0), (0.0, 91.0), (None, 1.0)], "lon double, lat double")
    rows = df.withColumn("p", geo.mollweide(F.col("lon"), F.col("lat"))).withColumn("q", geo.from_mollweide(F.col("p.x"), F.col("p.y"))).collect()
    for r in rows[: len(at)]:
        most = 1e-9 if abs(r.lat) <= 89.9 else 1e-8  # y no longer tells latitudes apart any finer there
        assert abs(r.q.lon - r.lon) < most and abs(r.q.lat - r.lat) < most, r
    assert abs(rows[-3].q.lat - 90) < 1e-6 and rows[-2].p is None and rows[-1].p.x is None
    assert spark.range(1).select(geo.from_mollweide(F.lit(1.8e7), F.lit(8e6)).alias("q")).head().q is None
