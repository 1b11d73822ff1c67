"""Event state as a stream: one pure transition function, run by Structured Streaming and by a batch fold alike."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lahar.operators.events import RETRY_H, TRANSITIONS

FIELDS = "event long, state string, version int, detected timestamp, changes int"
STATE = "state string, version int, detected timestamp, changes int"


def step(old: tuple | None, kind: str, version: int, ts: pd.Timestamp) -> tuple:
    """(state, version, detected, changes) after one message; time is always the message's own.

    Messages: detect, product (with a version), retract, tick. A product is published if its version is higher; a
    tick past the retry window without a product degrades; a retraction discards. Anything else changes nothing.
    """
    state, known, detected, changes = old or ("detectado", 0, ts, 0)
    new = state
    if kind == "product" and version > known:
        new, known = "publicado", version
    elif kind == "retract":
        new = "descartado"
    elif kind == "tick" and state in ("detectado", "preliminar"):
        new = "degradado" if ts - detected >= pd.Timedelta(hours=RETRY_H) else "preliminar"
    if new != state or (kind == "product" and new == "publicado" and known == version and known != (old or (0, 0))[1]):
        if new not in TRANSITIONS[state]:
            return state, (old or (0, 0))[1], detected, changes
        changes += 1
    return new, known, detected, changes


def fold(messages: Iterable[tuple[str, int, pd.Timestamp]], old: tuple | None = None) -> tuple | None:
    for kind, version, ts in messages:
        old = step(old, kind, version, ts)
    return old


def _ordered(rows: pd.DataFrame) -> list[tuple]:
    rows = rows.sort_values(["ts", "id"])
    return list(zip(rows["kind"], rows["version"].astype(int), rows["ts"], strict=True))


def batch_states(messages: DataFrame) -> DataFrame:
    """messages (event, id, kind, version, ts) folded in order of time, event by event.

    What fold() gives, from groups and one window: a retraction ends an event, products count as long as their version
    rises, and ticks before the first product tell early from late. Grouped parts combine before their shuffle; the
    window over an event spills, so no event has to fit a worker.
    """
    at = F.struct("ts", "id")
    firsts = messages.groupBy("event").agg(F.min("ts").alias("detected"), F.min(F.when(F.col("kind") == "retract", at)).alias("ends"))
    live = messages.join(firsts, "event").where(F.col("ends").isNull() | (at < F.col("ends")))
    before = Window.partitionBy("event").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    offered = F.when(F.col("kind") == "product", F.col("version")).otherwise(0)
    live = live.withColumn("known", F.greatest(F.coalesce(F.max(offered).over(before), F.lit(0)), F.lit(0)))
    rises, waiting = offered > F.col("known"), (F.col("kind") == "tick") & (F.col("known") == 0)
    late = F.unix_micros("ts") - F.unix_micros("detected") >= RETRY_H * 3_600_000_000
    sums = live.groupBy("event").agg(
        F.count_if(rises).alias("rises"),
        F.max(F.when(rises, offered)).alias("version"),
        F.max(F.when(waiting & ~late, 1).otherwise(0)).alias("early"),
        F.max(F.when(waiting & late, 1).otherwise(0)).alias("late"),
    )
    out = firsts.join(sums, "event", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("rises", "version", "early", "late")})
    state = F.when(F.col("ends").isNotNull(), "descartado").when(F.col("rises") > 0, "publicado").when(F.col("late") == 1, "degradado").when(F.col("early") == 1, "preliminar").otherwise("detectado")
    changes = F.col("rises") + F.col("early") + F.col("late") + F.col("ends").isNotNull().cast("int")
    return out.select("event", state.alias("state"), F.col("version").cast("int").alias("version"), "detected", changes.cast("int").alias("changes"))


def stream_states(messages: DataFrame) -> DataFrame:
    """The same as a stateful stream: each batch's messages of an event move its state, and the new one is sent."""

    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        old = tuple(state.get) if state.exists else None
        rows = pd.concat(list(frames))
        new = fold(_ordered(rows), (old[0], old[1], pd.Timestamp(old[2]), old[3]) if old else None)
        state.update((new[0], int(new[1]), new[2].to_pydatetime() if hasattr(new[2], "to_pydatetime") else new[2], int(new[3])))
        yield pd.DataFrame([(key[0], *new)], columns=["event", "state", "version", "detected", "changes"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    return messages.groupBy("event").applyInPandasWithState(run, FIELDS, STATE, "update", GroupStateTimeout.NoTimeout)


def first_sight(messages: DataFrame, late: str = "1 day") -> DataFrame:
    """Within the watermark, the first message of each alias."""
    return messages.withWatermark("ts", late).dropDuplicatesWithinWatermark(["alias"])


def tumbling(rows: DataFrame, width: str, late: str = "1 hour", slide: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and sums by tumbling or sliding window."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return rows.withWatermark("ts", late).groupBy(w, *by).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(28,6)")).cast("double").alias("value")).select(F.col("window.start").alias("start"), *by, "n", "value")


def sessions(rows: DataFrame, gap: str, late: str = "1 hour", by: tuple[str, ...] = ("user_id",)) -> DataFrame:
    return rows.withWatermark("ts", late).groupBy(F.session_window("ts", gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), *by, "n")


def capped_history(rows: DataFrame, keep: int = 200) -> DataFrame:
    """The newest heartbeats of each source."""
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy(F.desc("ts"), F.desc("id"))
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep).drop("_n")
