"""The rolling set as a stream against the table form, over several files; merges of divergent files."""

import datetime
import random

from pyspark.sql import functions as F

from lahar.streaming import observed

DAY = datetime.datetime(2024, 3, 1)


def write(spark, folder, n, rows):
    spark.createDataFrame(rows, "id long, version long, ts timestamp, value double").coalesce(1).write.parquet(f"{folder}/in-{n}")


def test_stream_equals_table(spark, tmp_path):
    rng = random.Random(5)
    folder, rows = str(tmp_path), []
    schema = "id long, version long, ts timestamp, value double"
    source = lambda s: observed.rolling(s.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in-*"), 5)
    place = None
    for n in range(3):
        some = [(rng.randrange(12), 10 * n + rng.randrange(10), DAY + datetime.timedelta(days=2.5 * n, hours=rng.randrange(60)), float(rng.randrange(99))) for _ in range(15)]
        some += [(100 + n, 1, DAY + datetime.timedelta(days=2.5 * n), 1.0), (None, 1, DAY, 0.0)]
        write(spark, folder, n, some)
        rows += some
        place = observed.run_changes(spark, source, f"file://{folder}/out")
        table = spark.createDataFrame(rows, schema)
        got = observed.standing(spark.read.schema(observed.CHANGE).parquet(place))
        key = lambda df: sorted((r.id, r.version, r.ts) for r in df.collect())
        assert key(got) == key(observed.rolled(table, 5))
    changes = spark.read.schema(observed.CHANGE).parquet(place)
    assert changes.where("gone").count() > 0 and not any(r.id == 100 for r in observed.standing(changes).collect())
    before = changes.count()
    observed.run_changes(spark, source, f"file://{folder}/out")
    assert spark.read.schema(observed.CHANGE).parquet(place).count() == before


def test_merge_of_divergent_files_and_replay(spark, tmp_path):
    folder = f"file://{tmp_path}/merged"
    merge = observed.merger(folder, "id", "version")
    frame = lambda rows: spark.createDataFrame(rows, "id long, version long, note string")
    merge(frame([(1, 1, "a"), (2, 5, "b"), (2, 4, "old"), (None, 1, "x")]), 0)
    merge(frame([(1, 2, "c"), (2, 3, "late"), (3, 1, "d"), (3, 1, "e")]), 1)
    want = [(1, 2, "c"), (2, 5, "b"), (3, 1, "e")]
    read = lambda: sorted(map(tuple, spark.read.parquet(f"{folder}/snapshot-{observed.snapshots(spark, folder)[-1]}").collect()))
    assert read() == want
    merge(frame([(1, 2, "c"), (2, 3, "late"), (3, 1, "d"), (3, 1, "e")]), 1)
    assert read() == want and observed.snapshots(spark, folder) == [0, 1]
    merge(frame([(2, 5, "tie")]), 2)
    assert read()[1] == (2, 5, "tie")
