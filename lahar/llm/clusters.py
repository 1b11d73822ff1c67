"""Centroid clustering with Drake's adaptive bounds, in integers, so that every sum and tie is exact.

Each vector keeps its centroid, an upper bound of the distance to it, its `width` next nearest centroids in the order
of their lower bounds, and one remainder bound for all other centroids. When centroids have moved, bounds give way by
how far; a vector whose upper bound is under all lower bounds stays without a look at any centroid. Else its own
distance is made exact; if that doesn't settle it, only the centroids in front of the first lower bound above it are
measured and put in order anew; if even the remainder bound isn't above, all are. The width adapts: the next round
keeps as many bounds as the round needed, between an eighth and a quarter of the centroids. Bounds are rounded outward
and compared strictly, so the outcome is that of measuring everything, ties to the smaller number included.

Vectors and bounds are written to the shared folder once a round, together with what each partition's moved vectors
change in the sums of their clusters; only those changes, k rows a partition, are shuffled, in decimals. The driver holds
centroids and sums, k times the components. A round in which no centroid moved is the last, as others change nothing.

Vectors count if they have exactly `dim` components, none null or non-finite. A component x becomes floor(scale * x),
held within 2^27, so that a squared distance fits a long. A null id is a vector like others, and starts a centroid only if
too few have one; of rows that share an id, those of smaller components start first. With fewer vectors than
centroids there are as many centroids as vectors. A sum of distances beyond a long is null. An empty table gives an
empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import cut, drop, recorded, small_batches

MOST = 1 << 27
STATE = "id long, v binary, cluster int, high float, near binary, low binary, distance long, depth int, change array<long>"
KINDS = pa.schema(
    [("id", pa.int64()), ("v", pa.binary()), ("cluster", pa.int32()), ("high", pa.float32()), ("near", pa.binary()), ("low", pa.binary()), ("distance", pa.int64()), ("depth", pa.int32()), ("change", pa.list_(pa.int64()))]
)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def between(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) ** 2 * x.shape[1] * 4 < 1 << 53:  # every sum is a whole double
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    d = x - y
    return (d * d).sum(-1)


class Bounds:
    """Centroid, upper bound, next nearest centroids and lower bounds of many vectors."""

    def __init__(self, cluster: np.ndarray, high: np.ndarray, near: np.ndarray, low: np.ndarray):
        self.cluster, self.high, self.near, self.low = cluster, high, near, low

    @classmethod
    def measured(cls, x: np.ndarray, c: np.ndarray, width: int) -> Bounds:
        """All centroids measured; of those beyond the width, the nearest is the remainder bound."""
        d = between(x, c)
        order = np.argsort(d, 1, kind="stable")[:, : width + 2]
        far = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
        low = np.full((len(x), width + 1), np.inf, np.float32)
        low[:, : order.shape[1] - 1] = _down(far[:, 1:])
        return cls(order[:, 0].copy(), _up(far[:, 0]), order[:, 1 : width + 1].copy(), low)

    def narrowed(self, width: int) -> Bounds:
        """The same with fewer lower bounds: the remainder bound covers those dropped."""
        least = np.minimum.accumulate(self.low[:, ::-1], 1)[:, ::-1]
        return Bounds(self.cluster, self.high, self.near[:, :width], least[:, : width + 1].copy())

    def moved(self, x: np.ndarray, c: np.ndarray, drift: np.ndarray) -> int:
        """Bounds and centroids after centroids moved by drift to c; how many lower bounds were needed at most."""
        width = self.near.shape[1]
        self.high = _up(self.high.astype(np.float64) + drift[self.cluster])
        self.low[:, :width] = _down(self.low[:, :width].astype(np.float64) - drift[self.near])
        self.low[:, width] = _down(self.low[:, width].astype(np.float64) - drift.max())
        self.low = np.minimum.accumulate(self.low[:, ::-1], 1)[:, ::-1].copy()  # each now bounds all centroids behind it, too
        open_ = np.flatnonzero(self.high >= self.low[:, 0])
        self.high[open_] = _up(np.sqrt(apart(x[open_], c[self.cluster[open_]]).astype(np.float64)))
        depth = (self.low[open_] <= self.high[open_, None]).sum(1)
        for z in np.unique(depth).tolist():
            at = open_[depth == z]
            if z > width:
                new = Bounds.measured(x[at], c, width)
                self.cluster[at], self.high[at], self.near[at], self.low[at] = new.cluster, new.high, new.near, new.low
            elif z:
                ids = np.sort(np.concatenate([self.cluster[at, None], self.near[at, :z]], 1), 1)
                d = apart(x[at, None, :], c[ids])
                order = np.argsort(d, 1, kind="stable")
                ids, far = np.take_along_axis(ids, order, 1), np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
                self.cluster[at], self.high[at] = ids[:, 0], _up(far[:, 0])
                self.near[at, :z], self.low[at, :z] = ids[:, 1:], _down(far[:, 1:])
        return int(depth.max(initial=0))


def _change(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, total: np.ndarray) -> None:
    """Add to total (sums and a count for each cluster) what vectors that moved change."""
    at = np.arange(len(x)) if old is None else np.flatnonzero(old != new)
    for side, sign in ((new, 1), (old, -1)):
        if side is not None and len(at):
            order = at[np.argsort(side[at], kind="stable")]
            number, first = np.unique(side[order], return_index=True)
            total[number, :-1] += sign * np.add.reduceat(x[order], first, 0)
            total[number, -1] += sign * np.diff([*first.tolist(), len(order)])


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in KINDS], schema=KINDS)


def _written(ids, x: np.ndarray, b: Bounds, c: np.ndarray | None, depth: int) -> Iterator[pa.RecordBatch]:
    def cells(m: np.ndarray) -> list[bytes]:
        raw, step = np.ascontiguousarray(m).tobytes(), m.dtype.itemsize * m.shape[1]
        return [raw[i : i + step] for i in range(0, len(raw), step)] if step else [b""] * len(m)

    n = len(x)
    columns = {"id": ids, "v": cells(x.astype(np.int32)), "cluster": b.cluster.astype(np.int32)}
    if c is None:
        yield _rows(n, **columns, high=b.high, near=cells(b.near.astype(np.int16)), low=cells(b.low), depth=np.full(n, depth, np.int32))
    else:
        yield _rows(n, **columns, distance=apart(x, c[b.cluster]))


def _changes(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    some = np.flatnonzero(np.any(total != 0, 1))
    if len(some):
        yield _rows(len(some), cluster=some.astype(np.int32), change=total[some].tolist())


def starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of seed and id, in that order."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(place.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in first], np.int64)


def centroids(vectors: DataFrame, k: int, rounds: int, seed: int, dim: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that counts after `rounds` rounds, and the k centroids they lead to."""
    spark = vectors.sparkSession
    small_batches(spark)
    v = F.col(vector_col).cast("array<double>")
    fine = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int"))
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    c = starts(rows, k, seed)
    if not len(c):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), c
    k = len(c)
    width = max(1, min(k - 2, k // 4)) if k > 2 else k - 1
    least = max(1, min(width, k // 8)) if k > 1 else 0

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, last = shared.value[0], shared.value[2], shared.value[3]
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(-1, dim).astype(np.int64)
                b = Bounds.measured(x, at, w)
                _change(x, None, b.cluster, total)
                yield from _written(batch.column(0), x, b, at if last else None, 0)
        yield from _changes(total)

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, drift, w, last = shared.value
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                n, column = batch.num_rows, dict(zip(batch.schema.names, batch.columns, strict=True))
                flat = lambda name, kind, n=n, column=column: np.frombuffer(b"".join(column[name].to_pylist()), kind).reshape(n, -1)
                x = flat("v", np.int32).astype(np.int64)
                b = Bounds(column["cluster"].to_numpy().astype(np.int64), column["high"].to_numpy(), flat("near", np.int16).astype(np.int64), flat("low", np.float32).copy()).narrowed(w)
                old = b.cluster.copy()
                depth = b.moved(x, at, drift)
                _change(x, old, b.cluster, total)
                yield from _written(column["id"], x, b, at if last else None, depth)
        yield from _changes(total)

    total = np.zeros((k, dim + 1), object)  # whole numbers of any size
    drift, before, done = np.zeros(k), None, 0
    while True:
        last = done == rounds
        shared = spark.sparkContext.broadcast((c, drift, width, last))
        held = rows if before is None else before.where(F.col("v").isNotNull()).select("id", "v", "cluster", "high", "near", "low")
        with recorded() as made:
            after = cut(held.mapInArrow(first if before is None else later, STATE), "clusters")
        if before is not None:
            drop(spark, used)
        before, used = after, made
        if last:
            return after.where(F.col("v").isNotNull()).select("id", "cluster", "distance"), c
        found = after.where(F.col("change").isNotNull()).select("cluster", F.posexplode("change").alias("place", "x"))
        for r in found.groupBy("cluster", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
            total[r.cluster, r.place] += int(r.x)
        if done:
            width = max(least, min(width, after.agg(F.max("depth")).head()[0] or 0))
        new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(total.tolist(), c.tolist(), strict=True)], np.int64)
        drift, done = np.sqrt(apart(new, c).astype(np.float64)) * (1 + 1e-12), done + 1
        if np.array_equal(new, c):
            done = rounds
        c = new


def clustered(vectors: DataFrame, k: int, rounds: int, seed: int, dim: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each vector's cluster and squared distance, with the sums of its cluster and of all, and its centroid's hash."""
    found, c = centroids(vectors, k, rounds, seed, dim, scale, id_col, vector_col)
    spark, most = vectors.sparkSession, (1 << 63) - 1
    sums = {r.cluster: int(r.x) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    whole = sum(sums.values())
    fits = lambda x: x if x <= most else None
    table = [(j, fits(sums.get(j, 0)), fits(whole), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for j, row in enumerate(c.tolist())]
    named = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return found.join(F.broadcast(named), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
