"""Exact nearest neighbours by a block matrix join with int8 product tiles.

Each row is scaled by a power of two and held as int8 values with one step width, and the int8 rest of what that
rounds off. Rows are cut into blocks; a tile is one block of queries against one block of candidates, and gets only
these bytes, a quarter of the vectors. In a tile the int8 parts are multiplied; the rounding error of a product is
bounded, so pairs whose upper bound is under the k-th largest lower bound of their query can't be among its k nearest
and are dropped; what is left is bounded once more with the rests, 254 times as sharp. Across tiles the k-th largest
lower bound of each query drops more. Only then are the vectors of the surviving pairs fetched, multiplied in double
precision, and kept in heaps. The result is that of brute force.

Vectors that are null, zero, or hold null or non-finite components take no part. Vectors of different lengths are
never compared. Ties go to the smaller id, so of equal vectors only those of the k + 1 smallest ids can be found,
and k rows of each id, however many there are. Rows that share an id are candidates each; a query row never finds a
row of its own id. Repeated query rows are answered each. Products beyond the range of doubles are infinite and tie. An
empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.llm.common import cut, small_batches

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
#: int8 values, their int8 rests in 254ths of a step, the step, the power of two, and the sum of absolute values.
SMALL = "row long, id long, dim int, small binary, rest binary, step double, power int, size double"
BOUNDS = "q_row long, c_row long, low double, high double"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, int8 rests, steps, powers, sums of absolute values) of finite rows that aren't zero."""
    power = np.frexp(np.abs(x).max(1))[1]
    half = (-power) // 2
    y = np.ldexp(np.ldexp(x, half[:, None]), (-power - half)[:, None])  # in two moves: one may be beyond a double's range
    step = np.abs(y).max(1) / 127
    small = np.rint(y / step[:, None])
    rest = np.clip(np.rint((y / step[:, None] - small) * 254), -127, 127)
    return small.astype(np.int8), rest.astype(np.int8), step, power.astype(np.int32), np.abs(y).sum(1)


def _bounded(guess: np.ndarray, slack: np.ndarray, power: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of products in the vectors' own scale, with what subnormal numbers round off."""
    grain = dim * 5e-324
    with np.errstate(over="ignore", under="ignore"):
        return np.ldexp(guess - slack, power) - grain, np.ldexp(guess + slack, power) + grain


def tile_bounds(q: tuple, c: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, low, high) of the pairs of a tile that may be among a query's k nearest.

    q and c: ids, int8 values, rests, steps, powers, sums of absolute values.
    """
    (q_ids, q8, qr, qs, qp, q1), (c_ids, c8, cr, cs, cp, c1) = q, c
    dim = q8.shape[1]
    kind = np.float32 if dim <= 1000 else np.float64  # sums of products up to 127 * 127 stay exact
    guess = (q8.astype(kind) @ c8.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
    # |xy - x'y'| <= |x - x'||y| + |x'||y - y'| summed over components, with |x - x'| <= step / 2
    first = 0.5 * (qs[:, None] * c1[None, :] + cs[None, :] * (np.abs(q8).sum(1, dtype=np.float64) * qs)[:, None])
    slack = first * (1 + 1e-9) + 1e-14 * dim * q1[:, None] * c1[None, :]
    own = q_ids[:, None] == c_ids[None, :]

    def bar(low: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """The k-th largest low of each of n rows; minus infinity with fewer."""
        order = np.lexsort((-low, rows))
        start = np.searchsorted(rows[order], np.arange(n))
        count = np.bincount(rows, minlength=n)
        out = np.full(n, -np.inf)
        full = np.flatnonzero(count >= k)
        out[full] = low[order[start[full] + k - 1]]
        return out

    low, high = _bounded(guess, slack, qp[:, None] + cp[None, :], dim)
    low[own] = -np.inf
    m = min(k, low.shape[1])
    edge = np.partition(low, low.shape[1] - m, axis=1)[:, low.shape[1] - m] if m == k else np.full(len(low), -np.inf)
    qi, ci = np.nonzero((high >= edge[:, None]) & ~own)
    a = (q8[qi] + qr[qi] / 254.0) * qs[qi, None]
    b = (c8[ci] + cr[ci] / 254.0) * cs[ci, None]
    finer = first[qi, ci] / 254 * (1 + 1e-6) + np.minimum(slack[qi, ci], 1e-13 * dim * q1[qi] * c1[ci])
    low, high = _bounded(np.einsum("ij,ij->i", a, b), finer + 1e-4 * finer, qp[qi] + cp[ci], dim)
    near = high >= bar(low, qi, len(q_ids))[qi]
    return qi[near], ci[near], low[near], high[near]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows; where a sum has no value, of the rows scaled down, and infinite if that is too large."""
    with np.errstate(all="ignore"):
        out = np.einsum("ij,ij->i", a, b)
        bad = np.flatnonzero(~np.isfinite(out))
        if len(bad):
            pa_, pb = (np.frexp(np.abs(x[bad]).max(1))[1] for x in (a, b))
            out[bad] = np.ldexp(np.einsum("ij,ij->i", np.ldexp(a[bad], -pa_[:, None]), np.ldexp(b[bad], -pb[:, None])), pa_ + pb)
    return out


def _matrix(lists: pa.Array, rows: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(rows, -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries, the k rows of vectors of largest inner product."""
    spark = vectors.sparkSession
    small_batches(spark)

    def usable(df: DataFrame, most: int) -> DataFrame:
        """Rows (row, id, v) that take part, of equal vectors those of the `most` first ids, less than `most` of each."""
        v = F.col(vector_col).cast("array<double>")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
        rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.coalesce(fine, F.lit(False)) & F.col("id").isNotNull())
        if most:
            # arrays of doubles that are equal have equal bytes but for the sign of zero, which only makes two groups of one
            rows = rows.withColumn("place", F.dense_rank().over(Window.partitionBy("v").orderBy("id"))).where(F.col("place") <= most)
            rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("v", "id").orderBy("place"))).where(F.col("copy") < most).drop("place", "copy")
        return cut(rows.withColumn("row", F.monotonically_increasing_id()), "neighbours-rows")

    c, q = usable(vectors, k + 1), usable(queries, 0)
    n_blocks, q_blocks = max(1, ceil(c.count() / BLOCK_ROWS)), max(1, ceil(q.count() / QUERY_ROWS))

    def shrink(batches):
        for batch in batches:
            lists, ids, rows = batch.column(2), batch.column(1), batch.column(0)
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                small, rest, step, power, size = quantised(_matrix(lists.take(at), len(at)))
                flat = lambda x, dim=dim: pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.take(at), ids.take(at), pa.array(np.full(len(at), dim, np.int32)), flat(small), flat(rest), pa.array(step), pa.array(power), pa.array(size)], ["row", "id", "dim", "small", "rest", "step", "power", "size"])

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int, side: int) -> DataFrame:
        small = df.select("row", "id", "v").mapInArrow(shrink, SMALL)
        place: Column = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return small.select(place.alias(own), F.lit(side).alias("side"), "*").withColumn(other, every).select("q_block", "c_block", "side", *small.columns)

    tiles = dealt(c, "c_block", n_blocks, "q_block", q_blocks, 1).unionByName(dealt(q, "q_block", q_blocks, "c_block", n_blocks, 0))

    def one_tile(table: pa.Table) -> pa.Table:
        side, sides = table.column("side").to_numpy(), []
        for s in (0, 1):
            own = table.filter(pa.array(side == s))
            plain = [own.column(x).to_numpy() for x in ("id", "step", "power", "size", "row")]
            small, rest = (np.frombuffer(b"".join(own.column(x).to_pylist()), np.int8).reshape(own.num_rows, -1) if own.num_rows else np.empty((0, 1), np.int8) for x in ("small", "rest"))
            sides.append((plain[0], small, rest, plain[1], plain[2], plain[3], plain[4]))
        (*a, q_rows), (*b, c_rows) = sides
        if not len(q_rows) or not len(c_rows):
            qi, ci, low, high = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)
        else:
            qi, ci, low, high = tile_bounds(tuple(a), tuple(b), k)
        return pa.table({"q_row": q_rows[qi], "c_row": c_rows[ci], "low": low, "high": high})

    found = tiles.groupBy("q_block", "c_block", "dim").applyInArrow(one_tile, BOUNDS)
    by_low = Window.partitionBy("q_row").orderBy(F.col("low").desc())
    found = found.withColumn("place", F.row_number().over(by_low))
    edge = F.max(F.when(F.col("place") == k, F.col("low"))).over(Window.partitionBy("q_row"))
    found = found.withColumn("edge", edge).where(F.col("edge").isNull() | (F.col("high") >= F.col("edge"))).select("q_row", "c_row")
    pairs = found.join(q.select(F.col("row").alias("q_row"), F.col("id").alias("query_id"), F.col("v").alias("qv")), "q_row")
    pairs = pairs.join(c.select(F.col("row").alias("c_row"), F.col("id").alias("vec_id"), F.col("v").alias("cv")), "c_row").select("query_id", "q_row", "vec_id", "qv", "cv")

    def exact(batches):
        for batch in batches:
            dims = np.diff(batch.column(3).offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                some = batch.take(pa.array(np.flatnonzero(dims == dim)))
                score = products(_matrix(some.column(3), some.num_rows), _matrix(some.column(4), some.num_rows))
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(score)], ["query_id", "q_row", "vec_id", "score"])

    scored = pairs.mapInArrow(exact, "query_id long, q_row long, vec_id long, score double")

    def merge(batches):
        heaps: dict[tuple, list] = {}
        for batch in batches:
            for i, row, v, s in zip(*(batch.column(j).to_pylist() for j in range(4)), strict=True):
                heap = heaps.setdefault((i, row), [])
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
        rows = [(i, r, -v, s) for (i, _), heap in heaps.items() for r, (s, v) in enumerate(sorted(heap, reverse=True), 1)]
        for at in range(0, len(rows), 10000):
            i, r, v, s = zip(*rows[at : at + 10000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(r, pa.int32()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], ["query_id", "rank", "vec_id", "score"])

    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return scored.repartition(max(shuffles, q_blocks), "query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
