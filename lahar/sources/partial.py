"""Many text files of which some fail: what can be read is read, and every failure is a row, not an exception.

A file may be missing when the plan is made, vanish before it is read, or turn out damaged while it is read. Files come
as whole binary rows, so that decompression happens in a task that can say what went wrong; a damaged file gives no lines
at all, rather than those before the damage. Meant for feeds and listings: a file has to fit a row (2 GB).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = "file string, place long, line string, error string"
SLICE = 1 << 20


def _plain(name: str, data: bytes) -> bytes:
    """The file's bytes, unpacked if its name ends in .gz, however many members it has."""
    if not name.endswith(".gz"):
        return data
    out = []
    while data:
        d = zlib.decompressobj(31)
        out.append(d.decompress(data))
        if not d.eof:
            raise ValueError("truncated")
        data = d.unused_data
    return b"".join(out)


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, place, line, error): the lines of each file, or one row with an error and neither place nor line."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        found.append((p, path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString(), fs.exists(path)))
    there = [q for _, q, ok in found if ok]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    lines, error = _plain(name, data).decode("utf-8").splitlines(), None
                except (zlib.error, ValueError) as e:
                    lines, error = [], f"{type(e).__name__}: {e}"[:200]
                if error:
                    yield _batch([name], [None], [None], [error])
                for at in range(0, len(lines), SLICE):
                    some = lines[at : at + SLICE]
                    yield _batch([name] * len(some), list(range(at, at + len(some))), some, [None] * len(some))

    def _batch(file: list, place: list, line: list, error: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(file, pa.string()), pa.array(place, pa.int64()), pa.array(line, pa.string()), pa.array(error, pa.string())], ["file", "place", "line", "error"])

    names = spark.createDataFrame([(p, q) for p, q, _ in found], "file string, at string")
    if there:
        raw = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(there).select("path", "content")
        rows = raw.mapInArrow(read, LINES)
    else:
        rows = spark.createDataFrame([], LINES)
    named = rows.withColumnRenamed("file", "at").join(F.broadcast(names), "at").select("file", "place", "line", "error")  # one row a path
    gone = [(p, None, None, "missing") for p, _, ok in found if not ok]
    return named.unionByName(spark.createDataFrame(gone, LINES)) if gone else named


def outcome(spark: SparkSession, lines: DataFrame, paths: list[str]) -> DataFrame:
    """(file, status, lines, error) of each path asked for: read, failed with its error, or silent: empty, or vanished since."""
    seen = lines.groupBy("file").agg(F.count("line").alias("lines"), F.max("error").alias("error"))
    both = spark.createDataFrame([(p,) for p in paths], "file string").join(seen, "file", "left")
    status = F.when(F.col("error").isNotNull(), "failed").when(F.coalesce("lines", F.lit(0)) == 0, "silent").otherwise("read")
    return both.select("file", status.alias("status"), F.coalesce("lines", F.lit(0)).alias("lines"), "error")
