"""Periodic runs of words: repeated k-gram masking, then Main-Lorentz on what is left.

A run is a stretch of consecutive words with smallest period q and at least max(min_length, min_power * q) words that
no neighbouring word extends. Its words repeat q words on, over at least max(min_length, min_power * q) - q words; the
least of these over all q is k. So each word of a run lies in a k-gram that its document holds twice, and words outside
such k-grams neither belong to a run nor extend one. Only stretches of words inside them go on.

Main-Lorentz halves each stretch: a run that holds both words at a middle is found there from how far the words agree
to both sides of it with those q further on, and q further back; other runs lie in one half. All halves of one depth,
of all stretches of a slice of texts, and all their periods are looked up at once. How far words agree comes from
numbers of equal blocks of 1, 2, 4, ... words, which are exact. Of one stretch the smallest period is its period.

A null or empty text has no words, runs or kept words. Repeated rows give a row each, null ids too. An empty table gives
an empty result. Other columns, whatever their names, are not read. A text is held whole in one task, in about 150
bytes a word; texts are taken in slices of SLICE_BYTES, a longer text by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import WORD, Numbered, chunks_of, docs_in, small_batches

SLICE_BYTES = 2 << 20
RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"id long, n_words long, runs array<{RUN}>, strongest {RUN}, kept string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
KINDS = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", _RUN), ("kept", pa.string())])


def least_overlap(min_length: int, min_power: int) -> int:
    """How many words of a run are at least repeated one period on."""
    return min(max(min_length, min_power * q) - q for q in range(1, min_length + 1))


def in_repeated(codes: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in a k-gram that occurs again in their document. A hash collision only adds words."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(len(codes), bool)
    base = np.uint64(0x9E3779B97F4A7C15)
    h = doc[:n].astype(np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(31))) * base + codes[j : j + n].astype(np.uint64)
    whole = np.flatnonzero(doc[:n] == doc[k - 1 :])
    order = whole[np.argsort(h[whole])]
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    at = order[again]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return np.cumsum(edge[:-1]) > 0


class _Blocks:
    """Numbers of equal blocks of 2^t words, for every t that a stretch has room for."""

    def __init__(self, s: np.ndarray, longest: int):
        self.rank = [np.unique(s, return_inverse=True)[1].astype(np.int32)]
        while 2 << len(self.rank) - 1 <= longest:
            last, step = self.rank[-1], 1 << len(self.rank) - 1
            whole = len(s) - 2 * step + 1  # a block that would go beyond the end must not get a number of others
            both = last[:whole].astype(np.int64) * (int(last.max()) + 1) + last[step : step + whole]
            rank = -1 - np.arange(len(s), dtype=np.int32)  # no block of this size starts here: equal to no other
            rank[: len(both)] = np.unique(both, return_inverse=True)[1]
            self.rank.append(rank)
        self.all = np.stack(self.rank)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on."""
        out = np.zeros(len(i), np.int64)
        for t in reversed(range(len(self.rank))):
            out += (self.rank[t][i + out] == self.rank[t][j + out]).astype(np.int64) << t
        return out

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words up to i equal those up to j."""
        out = np.zeros(len(i), np.int64)
        for t in reversed(range(len(self.rank))):
            a, b = i - out - (1 << t) + 1, j - out - (1 << t) + 1
            fits = np.minimum(a, b) >= 0
            out += (fits & (self.rank[t][np.maximum(a, 0)] == self.rank[t][np.maximum(b, 0)])).astype(np.int64) << t
        return out

    def may_reach(self, i: np.ndarray, j: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether the 2^t words from i on equal those from j on, or those before i those before j."""
        a, b = i - (1 << t), j - (1 << t)
        before = (a >= 0) & (self.all[t, np.maximum(a, 0)] == self.all[t, np.maximum(b, 0)])
        return before | (self.all[t, i] == self.all[t, j])


def main_lorentz(s: np.ndarray, low: np.ndarray, high: np.ndarray, min_length: int, min_power: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in the stretches [low, high) of s, in order of start and period.

    Stretches are apart by words that occur once; the first and the last word of s are such, too.
    """
    blocks = _Blocks(s, int((high - low).max()))
    found = []
    while len(low):
        wide = high - low >= min_length
        low, high = low[wide], high[wide]
        middle, most = (low + high) // 2, (high - low) // min_power
        m = np.repeat(middle, most)
        q = np.arange(1, len(m) + 1) - np.repeat(np.cumsum(most) - most, most)
        # words that agree to both sides are at least (min_power - 1) * q, so on one side half of them
        t = np.frexp(np.maximum(1, (min_power - 1) * q // 2).astype(np.float64))[1] - 1
        t = np.minimum(t, len(blocks.rank) - 1)
        for i in (m, m - q):
            near = blocks.may_reach(i, i + q, t)
            a, p = i[near], q[near]
            after, before = blocks.ahead(a, a + p), blocks.back(a - 1, a + p - 1)
            fits = after + before + p >= np.maximum(min_length, min_power * p)
            found.append(np.stack([(a - before)[fits], (a + p + after)[fits], p[fits]]))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    start, end, period = np.concatenate(found, 1) if found else np.empty((3, 0), np.int64)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(codes: np.ndarray, doc: np.ndarray, min_length: int, min_power: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of texts laid one after another; doc numbers the text of every word."""
    inside = in_repeated(codes, doc, least_overlap(min_length, min_power))
    cut = np.ones(len(codes) + 1, bool)
    cut[1:-1] = (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    edge = np.flatnonzero(cut)
    low, high = edge[:-1], edge[1:]
    good = inside[low] & (high - low >= min_length) if len(codes) else np.zeros(0, bool)
    low, high = low[good], high[good]
    if not len(low):
        return (np.empty(0, np.int64),) * 3
    size = high - low
    at = 1 + np.cumsum(size + 1) - size - 1  # a lone word before each stretch, and one after the last
    s = -1 - np.arange(int(size.sum()) + len(size) + 1, dtype=np.int64)
    shift = np.repeat(low - at, size)
    place = np.arange(int(size.sum())) + np.repeat(at - (np.cumsum(size) - size), size)
    s[place] = codes[place + shift]
    start, end, period = main_lorentz(s, at, at + size, min_length, min_power)
    back = (low - at)[np.searchsorted(at, start, "right") - 1]
    return start + back, end + back, period


def _slice(ids: list, texts: list[bytes | None], min_length: int, min_power: int) -> pa.RecordBatch:
    number, words = Numbered(), [(t or b"").split() for t in texts]
    size = np.array([len(w) for w in words], np.int64)
    codes = np.fromiter((number[x] for w in words for x in w), np.int64, int(size.sum()))
    start, end, period = runs_of(codes, np.repeat(np.arange(len(words)), size), min_length, min_power)
    first = np.cumsum(size) - size
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    stays = np.cumsum(edge[:-1]) == 0
    owner = np.searchsorted(np.cumsum(size), start, "right")
    of: dict[int, list[dict]] = {}
    for d, a, b, q in zip(owner.tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True):
        of.setdefault(d, []).append({"start": a - int(first[d]), "length": b - a, "period": q})
    runs = [of.get(d, []) for d in range(len(words))]
    best = [min(r, key=lambda x: (-Fraction(x["length"], x["period"]), x["start"], x["period"])) if r else None for r in runs]
    kept = [b" ".join(w if d not in of else [x for x, s in zip(w, stays[a : a + len(w)].tolist(), strict=True) if s]).decode() for d, (a, w) in enumerate(zip(first.tolist(), words, strict=True))]
    columns = (ids, size.tolist(), runs, best, kept)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, KINDS, strict=True)], schema=KINDS)


def word_runs(docs: DataFrame, min_length: int = 6, min_power: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs by start and period, the strongest run, kept words joined by one space) of every text.

    The strongest run has the greatest length over period; ties go to the smallest start, then period. A word is not
    kept if any run holds it after its first period.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks_of(batches, SLICE_BYTES):
            yield _slice(ids, texts, min_length, min_power)

    return docs_in(docs, id_col, text_col).mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) in which one text in ten repeats its words from some place on, by the crc32 of its id.

    With h = crc32(id), g = floor(h / 10), n words, h % 10 = 0 and n > 0: from word a = g % n on, words repeat with period
    1 + floor((n - a) / (3 + g % 8)). A null id leaves the text alone.
    """
    i, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    h = F.crc32(i.cast("string").cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select(i.alias("id"), text.alias("text"), g.alias("g"), F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)).alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    block = F.slice("w", a + 1, p)
    words = F.slice(F.concat(F.slice("w", F.lit(1), a), F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))), F.lit(1), n)
    return rows.select(F.col("id").alias(id_col), F.when(F.col("w").isNull() | (n == 0), F.col("text")).otherwise(F.array_join(words, " ")).alias(text_col))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and hashes of all runs and of the kept words."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )
