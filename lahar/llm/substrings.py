"""Removing passages that repeat anywhere in the corpus: a Count-min prefilter, then exact groups of what is left.

Every window of `width` words has a 128-bit fingerprint. Pass one: each chunk of texts sends a partition sketch, in
each of `depth` rows the cells its windows fall into and whether it saw the cell once or more; the sketches are
merged by cell range, and cells whose merged count reaches two come back. The sketch has `load` cells for each
window of the corpus, so it grows with the input and is never whole in one place. Its counts are never too low, so
a window with a cell below two in any row occurs once, and only the others go to pass two, which groups their
fingerprints exactly. Windows are judged on the input; each word of a repeated window is removed.

Two different windows share a 128-bit fingerprint with a chance under 2**-110 for each pair.
Null and empty texts have no words; texts shorter than a window keep all. Repeated rows are documents of their own
(so a long enough text that occurs twice is removed in both). An empty table gives an empty result. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import CHUNK_BYTES, WORD, answered, buckets_for, cut_up, docs_in, runs, spread, text_bytes

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEPS = (0xD6E8FEB86659FD95, 0xA0761D6478BD642F)
_TABLES = np.random.default_rng(20240607).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


#: Words are hashed in slices of about so many bytes, whatever the size of a chunk or a text.
SLICE = 1 << 18
_PLAIN = [powers(b | 1, SLICE) for b in _BASES]
_BACK = [powers(pow(b | 1, -1, 1 << 64), SLICE + 1) for b in _BASES]


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of x over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a buffer."""
    inside = np.concatenate([[False], ~SPACE[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit polynomial hash of each word, by prefix sums over slices of the buffer that end between words."""
    base = _BASES[which] | 1
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE, "right")))
        low, high = int(start[i]), int(end[j - 1])
        up, back = (_PLAIN[which], _BACK[which]) if high - low <= SLICE else (powers(base, high - low), powers(pow(base, -1, 1 << 64), high - low + 1))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_TABLES[which][data[low:high]] * up[: high - low])])
        a, b = start[i:j] - low, end[i:j] - low
        out[i:j] = mixed((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))
        i = j
    return out


def window_hashes(words: np.ndarray, width: int, which: int) -> np.ndarray:
    """A 64-bit hash of each run of width words."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    step = _STEPS[which] | 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers(step, len(words)))])
    back = powers(pow(step, -1, 1 << 64), len(words) - width + 1)
    return mixed((sums[width:] - sums[:-width]) * back)


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(words of each text, document of each window, its first word in the chunk, both halves of its fingerprint)."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    start, end = word_spans(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, start, "right")
    counts = np.bincount(doc, minlength=len(texts))
    full = np.maximum(counts - width + 1, 0)
    first = np.repeat(np.cumsum(counts) - counts, full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    halves = tuple(window_hashes(word_hashes(data, start, end, h), width, h)[first] if len(first) else np.empty(0, np.uint64) for h in (0, 1))
    return counts, np.repeat(np.arange(len(texts)), full), first, halves


def _cells(a: np.ndarray, b: np.ndarray, row: int, size: int) -> np.ndarray:
    """The cell of each window in one row of the sketch, below size."""
    x = mixed(a + b * np.uint64(2 * row + 1) + np.uint64(row + 1))
    return ((x >> np.uint64(11)).astype(np.float64) * (size / 2.0**53)).astype(np.int64).clip(0, size - 1)


def _deltas(cells: np.ndarray) -> bytes:
    gaps = np.diff(cells, prepend=0)
    kind = np.uint16 if not len(gaps) or gaps.max() < 1 << 16 else np.uint32 if gaps.max() < 1 << 32 else np.int64
    planes = gaps.astype(kind).view(np.uint8).reshape(len(gaps), -1).T  # high bytes together: they are nearly all alike
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _undeltas(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1).T
    return np.cumsum(np.ascontiguousarray(raw).view({2: np.uint16, 4: np.uint32, 8: np.int64}[data[0]]).ravel().astype(np.int64))


def repeated_words(docs: DataFrame, width: int = 35, depth: int = 2, load: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_words, n_removed, kept): every row, with the words that stand in no repeated window."""
    spark = docs.sparkSession
    source = docs_in(docs, id_col, text_col)
    total = text_bytes(source, "text")
    n = buckets_for(total)
    size = max(1 << 16, load * (total // 4))  # windows are fewer than words, and words seldom shorter than four bytes
    per = -(-size // n)

    def ask(ids, texts):
        """Partition sketch: for each row and cell range, its cells in order and a bit that says seen twice or more."""
        _, _, _, (a, b) = windows([t or b"" for t in texts], width)
        asks: list[tuple[int, tuple]] = []
        for row in range(depth):
            cells = np.sort(_cells(a, b, row, size))
            new = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.empty(0, np.int64)
            often = np.diff(np.append(new, len(cells))) > 1
            own = cells[new]
            asks += [(row * n + k, (_deltas(own[part] - k * per), np.packbits(often[part]))) for k, part in runs(own // per)]
        return (ids, zstandard.ZstdCompressor(level=3).compress(_joined(texts)), np.array([-1 if t is None else len(t) for t in texts], np.int64)), asks

    def merge(questions):
        """Merged counts of a cell range, up to two; what comes back is a bit for each cell a chunk sent."""
        count, sent = np.zeros(per, np.uint8), []
        for packed, bits in questions:
            cells = _undeltas(packed)
            count[cells] = np.minimum(count[cells] + 1 + np.unpackbits(bits, count=len(cells)), 2)
            sent.append(cells)
        return [np.packbits(count[cells] > 1) for cells in sent]

    def second(kept, got):
        """Windows whose every cell came back go to exact groups, by fingerprint; each chunk names one at most twice."""
        ids, packed, sizes = kept
        texts = _split(zstandard.ZstdDecompressor().decompress(packed), sizes)
        _, _, first, (a, b) = windows(texts, width)
        maybe = np.ones(len(a), bool)
        for row in range(depth):
            cells = _cells(a, b, row, size)
            own = np.unique(cells)
            hot = np.zeros(len(own), bool)
            for k, part in runs(own // per):
                hot[part] = np.unpackbits(got[row * n + k], count=part.stop - part.start)
            maybe &= hot[np.searchsorted(own, cells)]
        at = np.flatnonzero(maybe)
        keys = _pairs(a[at], b[at])
        uniq, where, times = np.unique(keys, return_inverse=True, return_counts=True)
        parts = runs((uniq["a"] >> np.uint64(32)) * np.uint64(n) >> np.uint64(32))
        asks = [(k, (uniq[part].tobytes(), np.packbits(times[part] > 1))) for k, part in parts]
        return (ids, packed, sizes, first[at], where.astype(np.int32), parts), asks

    def group(questions):
        """Exact: a fingerprint is repeated if a chunk saw it twice or two chunks saw it."""
        parts = [np.frombuffer(q[0], _PAIR) for q in questions]
        every = np.concatenate(parts)
        often = np.concatenate([np.unpackbits(q[1], count=len(p)) for q, p in zip(questions, parts, strict=True)])
        _, where, times = np.unique(every, return_inverse=True, return_counts=True)
        repeated = (times + np.bincount(where, often, len(times)) > 1)[where] if len(every) else np.empty(0, bool)
        ends = np.cumsum([0, *(len(p) for p in parts)])
        return [np.packbits(repeated[i:j]) for i, j in zip(ends, ends[1:], strict=False)]

    def finish(kept, got):
        ids, packed, sizes, first, where, parts = kept
        repeated = np.zeros(parts[-1][1].stop if parts else 0, bool)
        for k, part in parts:
            repeated[part] = np.unpackbits(got[k], count=part.stop - part.start)
        texts = _split(zstandard.ZstdDecompressor().decompress(packed), sizes)
        words = [t.split() for t in texts]
        n_words = np.array([len(w) for w in words], np.int64)
        cover = np.zeros(n_words.sum() + 1, np.int64)
        starts = first[repeated[where]] if len(where) else first
        np.add.at(cover, starts, 1)
        np.add.at(cover, np.minimum(starts + width, len(cover) - 1), -1)
        gone = np.cumsum(cover)[:-1] > 0
        out, at, held = [], 0, 0
        for i, t, w, s in zip(ids, texts, words, sizes.tolist(), strict=True):
            own = gone[at : at + len(w)]
            at += len(w)
            stay = b" ".join(w) if not own.any() else b" ".join([x for x, g in zip(w, own.tolist(), strict=True) if not g])
            out.append((i, None if s < 0 else t, len(w), int(own.sum()), stay))
            held += 2 * len(t)
            if held > CHUNK_BYTES:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)

    asked = cut_up(source, ask)
    again = answered(asked, spread(spark, n), merge, second, None)
    return answered(again, spread(spark, n), group, finish, "id long, text string, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)


_PAIR = np.dtype([("a", np.uint64), ("b", np.uint64)])


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), _PAIR)
    out["a"], out["b"] = a, b
    return out


def _joined(texts: list[bytes | None]) -> bytes:
    return b"".join(t or b"" for t in texts)


def _split(data: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))]).tolist()
    return [data[i:j] for i, j in zip(ends, ends[1:], strict=False)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    i, t, w, r, k = zip(*rows, strict=True)
    text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), text(t), pa.array(w, pa.int64()), pa.array(r, pa.int64()), text(k)], ["id", "text", "n_words", "n_removed", "kept"])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What is left of each document as a hash."""
    return found.select(id_col, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["WORD", "digest", "repeated_words"]
