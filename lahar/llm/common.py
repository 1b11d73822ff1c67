"""What several corpus operators share: the shared folder, and the question-and-answer shuffle of text chunks."""

from __future__ import annotations

import gc
import hashlib
import json
import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word is a run of anything but these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 5 << 20
BUCKET_BYTES = 16 << 20
MOST_PARTITIONS = 50_000
PIECES = "key long, chunk long, bucket int, data binary"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session may name none: then one under /tmp."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.conf.get("spark.master", "local").split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (named or "file:///tmp/lahar-shared").rstrip("/")


#: Of this thread of control only: queries that run beside each other don't see each other's folders.
_recorders: ContextVar[tuple[list[str], ...]] = ContextVar("recorders", default=())


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that cut() writes inside, in order, so that they can be dropped when nothing reads them any more."""
    before = _recorders.set((*_recorders.get(), made := []))
    try:
        yield made
    finally:
        _recorders.reset(before)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that cut() wrote, and let Spark clean up the shuffles of plans that are no longer referred to."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    gc.collect()
    jvm.System.gc()


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends there and lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    for made in _recorders.get():
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_col).cast("long"))).head()[0] or 0


def small_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes: rows hold whole texts, and ten thousand long ones wouldn't fit a Python worker.

    Spark has this as a session setting only; plans built before keep what they were built with.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def pack(x) -> bytes:
    """Pickled, and compressed where that can pay."""
    data = pickle.dumps(x, 5)
    return b"\1" + zstandard.ZstdCompressor(level=3).compress(data) if len(data) > 256 else b"\0" + data


def unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data[1:]) if data[0] else data[1:])


def docs_in(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def chunks_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[bytes | None]]]:
    """Rows gathered until their texts reach limit bytes; a longer text is a chunk by itself."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t)
            size += len(t or b"") + 64
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _signed(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    key, chunk, bucket, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())],
        ["key", "chunk", "bucket", "data"],
    )


def dealt(place: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, positions dealt to it) for each bucket that has any, given the bucket of every position."""
    order = np.argsort(place, kind="stable")
    return [(b, order[run]) for b, run in runs(place[order])]


def runs(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """The same for buckets in ascending order: (bucket, its run)."""
    if not len(bucket):
        return []
    found, start = np.unique(bucket, return_index=True)
    return [(b, slice(i, j)) for b, i, j in zip(found.tolist(), start.tolist(), [*start[1:].tolist(), len(bucket)], strict=True)]


def _batches(rows: list[tuple], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of about limit bytes."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[3])
        if size > limit:
            yield _rows(some)
            some, size = [], 0
    if some:
        yield _rows(some)


def pieces(chunk: int, kept: object, asks: Iterable[tuple[int, object]]) -> list[tuple]:
    """The rows of one chunk: what it keeps, and what it asks of buckets."""
    return [(chunk, chunk, -1, pack(kept)), *((_signed(b"bucket%d" % b), chunk, b, pack(a)) for b, a in asks)]


def cut_up(docs: DataFrame, ask: Callable, limit: int = CHUNK_BYTES) -> DataFrame:
    """Texts (id, text) cut into chunks of about limit bytes. ask(ids, texts) -> (kept, [(bucket, question), ...]).

    A chunk asks only buckets that it has keys for, so messages are never more than keys: they grow with the input,
    not with chunks times buckets.

    A chunk's key is a hash of its place and content: should a task be run again on rows that come in another
    order, keys differ and the answers don't fit, which fails loudly instead of mixing two states.
    """

    small_batches(docs.sparkSession)

    def run(batches):
        part = TaskContext.get().partitionId()
        for n, (ids, texts) in enumerate(chunks_of(batches, limit)):
            seen = hashlib.blake2b(repr((part, n, ids)).encode())
            for t in texts:
                seen.update(b"%d," % (-1 if t is None else len(t)))
                seen.update(t or b"")
            yield from _batches(pieces(_signed(seen.digest()), *ask(ids, texts)))

    return docs.mapInArrow(run, PIECES)


def answered(parts: DataFrame, partitions: int, answer: Callable, finish: Callable, schema: str | StructType | None) -> DataFrame:
    """Each bucket answers the questions of all chunks; then each chunk goes on with what it kept and its answers.

    answer([question, ...]) -> [answer, ...] in the same order; finish(kept, {bucket: answer}) -> record batches.
    Without a schema, finish gives (kept, questions) like ask, for another round. What was kept is shuffled once: both
    sides below read the same exchange.
    """
    parts = parts.repartition(partitions, "key")

    def reply(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return pa.Table.from_batches([_rows([])])
        table = table.sort_by("chunk")
        chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
        got = answer([unpack(x.as_py()) for x in table.column("data")])
        return pa.Table.from_batches([_rows([(c, c, b, pack(g)) for c, b, g in zip(chunk, bucket, got, strict=True)])])

    replies = parts.groupBy("key").applyInArrow(reply, PIECES)

    def go_on(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            raise RuntimeError("answers without their chunk: the input changed while it was read")
        if left.column("bucket")[0].as_py() >= 0:
            return empty
        kept = unpack(left.column("data")[0].as_py())
        got = {b: unpack(x.as_py()) for b, x in zip(right.column("bucket").to_pylist(), right.column("data"), strict=True)}
        if schema is None:
            chunk = left.column("chunk")[0].as_py()
            return pa.Table.from_batches(list(_batches(pieces(chunk, *finish(kept, got)))))
        return pa.Table.from_batches(list(finish(kept, got)), empty.schema)

    schema_out = schema or PIECES
    empty = pa.Table.from_batches([], arrow_schema(schema_out))
    return parts.groupBy("key").cogroup(replies.groupBy("key")).applyInArrow(go_on, schema_out)


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def nullable(schema: StructType) -> StructType:
    """The schema with every field nullable, as what comes back from Python is."""
    return StructType.fromJson(json.loads(schema.json().replace('"nullable":false', '"nullable":true').replace('"containsNull":false', '"containsNull":true')))


def buckets_for(size: int) -> int:
    return max(1, ceil(size / BUCKET_BYTES))


def spread(spark: SparkSession, n: int) -> int:
    """Shuffle partitions for n buckets and their chunks: several for each, so that few share one.

    Buckets and chunks are read one at a time, so beyond MOST_PARTITIONS tasks take longer, but no more memory.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTITIONS, 3 * n))


class Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n
