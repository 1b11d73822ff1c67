"""A rolling set of observed rows as a stream with timers, and the merge of divergent files batch by batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lahar.operators.events import upserted
from lahar.plans.shared import shared_folder

ROW = "version long, ts timestamp, value double"
CHANGE = "id long, version long, ts timestamp, value double, gone boolean"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Rolling(StatefulProcessor):
    """One key's newest row by version; a timer lets it go when the watermark is `days` past its time."""

    def __init__(self, days: int):
        self.span = pd.Timedelta(days=days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", ROW)

    def _told(self, key, row: tuple, gone: bool) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *row, gone)], columns=["id", "version", "ts", "value", "gone"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.row.get() if self.row.exists() else None
        best = None if old is None else (old[0], pd.Timestamp(old[1]), old[2])
        for frame in rows:
            for version, ts, value in zip(frame["version"].tolist(), frame["ts"], frame["value"].tolist(), strict=True):
                if best is None or (version, ts) > best[:2]:
                    best = (version, ts, value)
        if old is None or best[:2] != (old[0], pd.Timestamp(old[1])):
            self.row.update((int(best[0]), best[1].to_pydatetime(), float(best[2])))
            self.handle.registerTimer(int((best[1].tz_localize("UTC") + self.span).timestamp() * 1000))
            yield self._told(key, best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.row.exists():
            row = self.row.get()
            # a timer of a row that a newer one has replaced lets nothing go
            if int((pd.Timestamp(row[1]).tz_localize("UTC") + self.span).timestamp() * 1000) <= expiredTimerInfo.getExpiryTimeInMs():
                self.row.clear()
                yield self._told(key, (row[0], pd.Timestamp(row[1]), row[2]), True)

    def close(self) -> None:
        pass


def rolling(rows: DataFrame, days: int = 5, late: str = "0 seconds") -> DataFrame:
    """Changes (id, version, ts, value, gone) of the set of rows of the last days, by key: upserts and expiries.

    rows: a stream of id, version, ts, value. A row replaces one of lower version, or of equal version and earlier time;
    repeated rows change nothing. Rows without a key, version or time are left out.
    """
    whole = rows.select(F.col("id").cast("long"), F.col("version").cast("long"), F.col("ts").cast("timestamp"), F.coalesce(F.col("value").cast("double"), F.lit(float("nan"))).alias("value"))
    live = whole.where("id IS NOT NULL AND version IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", late)
    return live.groupBy("id").transformWithStateInPandas(_Rolling(days), CHANGE, "Append", "EventTime")


def standing(changes: DataFrame) -> DataFrame:
    """What a table of changes leaves: each key's last row, unless it is gone."""
    last = changes.groupBy("id").agg(F.max(F.struct("version", "ts", "gone", "value")).alias("r"))
    return last.where("NOT r.gone").select("id", "r.version", "r.ts", "r.value")


def rolled(rows: DataFrame, days: int = 5) -> DataFrame:
    """The same set from a table: newest rows by version, of less than `days` before the newest time of all rows."""
    whole = rows.where("id IS NOT NULL AND version IS NOT NULL AND ts IS NOT NULL")
    newest = whole.agg(F.max("ts").alias("newest"))
    best = whole.groupBy("id").agg(F.max(F.struct("version", "ts", "value")).alias("r")).select("id", "r.*")
    kept = best.crossJoin(F.broadcast(newest)).where(F.col("ts") > F.col("newest") - F.make_interval(days=F.lit(days)))  # one row
    return kept.select("id", "version", "ts", "value")


def run_changes(spark: SparkSession, make: Callable[[SparkSession], DataFrame], folder: str | None = None) -> str:
    """Run a stream of changes over all that is there, into a folder of Parquet files; the folder, to be run again later.

    The state store is set for a session of the stream's own.
    """
    folder = folder or f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}"
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", "UTC")
    query = make(own).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start(f"{folder}/rows")
    query.awaitTermination()
    return f"{folder}/rows"


def snapshots(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the whole snapshots in a folder, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    whole = lambda n: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))
    return sorted(int(n.removeprefix("snapshot-")) for n in names if n.startswith("snapshot-") and whole(n))


def merger(folder: str, key: str, version: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the union of the last snapshot and a batch by key, the higher version winning, as a new snapshot.

    A batch that is run again starts from the snapshot before it, so it changes nothing. Within a batch the highest
    version of a key wins, too; a tie goes to the batch, and within it to the greatest row.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        cols = [c for c in batch.columns if c != key]
        order = F.struct(version, *[c for c in cols if c != version])
        new = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("r")).select(key, "r.*")
        before = [n for n in snapshots(spark, folder) if n < number]
        old = spark.read.parquet(f"{folder}/snapshot-{before[-1]}") if before else new.limit(0)
        upserted(old, new, key, version).write.mode("overwrite").parquet(f"{folder}/snapshot-{number}")

    return merge


def merge_files(spark: SparkSession, files: DataFrame, key: str, version: str, folder: str | None = None) -> DataFrame:
    """The last snapshot after all files of a stream have been merged."""
    folder = folder or f"{shared_folder(spark)}/merged-{uuid.uuid4().hex}"
    query = files.writeStream.foreachBatch(merger(folder, key, version)).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/snapshot-{snapshots(spark, folder)[-1]}")
