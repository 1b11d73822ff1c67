"""Byte-level BPE: texts to ids through one global shuffle of distinct words, and ids back to bytes.

Nulls and empty texts give no ids and no bytes. Repeated rows give a row each. An empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import Numbered, answered, buckets_for, cut_up, dealt, docs_in, spread, text_bytes


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by id."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [found[i] for i in range(len(found))]


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, leftmost first, until no pair is a token."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 256:
        return _encode_long(word, ranks)
    none = len(ranks)
    pair = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pair and (best := min(pair)) < none:
        i = pair.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for very long words in n log n, by a heap over a linked list."""
    import heapq

    n = len(word)
    piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i, p) for i in range(n - 1) if (p := word[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, merged = heapq.heappop(heap)
        j = after[i]
        if piece[i] is None or j >= n or piece[i] + piece[j] != merged:
            continue
        piece[i], piece[j] = merged, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (p := merged + piece[k]) in ranks:
                heapq.heappush(heap, (ranks[p], i, p))
        if (h := before[i]) >= 0 and (p := piece[h] + merged) in ranks:
            heapq.heappush(heap, (ranks[p], h, p))
    return [ranks[p] for p in piece if p is not None]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row: the ids of its whole text, each match of pattern encoded apart.

    A chunk of texts becomes positions in its own list of distinct words; the words go to buckets by hash, where
    each distinct word of the corpus is encoded once; its ids come back to the chunk and are put in place.
    """
    spark = docs.sparkSession
    source = docs_in(docs, id_col, text_col)
    n = buckets_for(text_bytes(source, "text"))
    tokens = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def ask(ids, texts):
        find, words = regex.compile(pattern).findall, Numbered()
        number = words.__getitem__
        codes = [np.fromiter(map(number, find(t.decode()) if t else ()), np.int32) for t in texts]
        names = [w.encode() for w in words]
        place = np.fromiter((zlib.crc32(w) % n for w in names), np.int32, len(names))
        sizes = np.array([len(c) for c in codes], np.int64)
        asks = [(b, [names[i] for i in at.tolist()]) for b, at in dealt(place)]
        return (ids, sizes, np.concatenate(codes) if codes else np.empty(0, np.int32), place), asks

    def answer(questions):
        ranks = {t: i for i, t in enumerate(tokens.value)}
        kind = np.uint16 if len(ranks) < 1 << 16 else np.int32
        known: dict[bytes, bytes] = {}
        for words in questions:
            for w in words:
                if w not in known:
                    known[w] = np.array(encode_word(w, ranks), kind).tobytes()
        size = np.dtype(kind).itemsize
        for words in questions:
            got = [known[w] for w in words]
            yield np.array([len(g) // size for g in got], np.int32), np.frombuffer(b"".join(got), kind)

    def finish(kept, got) -> Iterator[pa.RecordBatch]:
        ids, sizes, codes, place = kept
        lens, buckets = np.zeros(len(place), np.int64), dealt(place)
        for b, where in buckets:
            lens[where] = got[b][0]
        starts = np.concatenate([[0], np.cumsum(lens)])
        flat = np.empty(starts[-1], np.int32)
        for b, where in buckets:
            k, values = got[b]
            flat[np.repeat(starts[where] - np.concatenate([[0], np.cumsum(k)[:-1]]) if len(k) else starts[where], k) + np.arange(len(values))] = values
        at = 0
        rows_ids, values, ends, size = [], [], [0], 0
        for i, s in zip(ids, sizes.tolist(), strict=True):
            c = codes[at : at + s]
            at += s
            k = lens[c]
            own = np.repeat(starts[c] - np.cumsum(k) + k, k) + np.arange(k.sum()) if s else np.empty(0, np.int64)
            rows_ids.append(i)
            values.append(flat[own])
            size += len(own)
            ends.append(size)
            if size > 1 << 20:
                yield _lists(rows_ids, values, ends)
                rows_ids, values, ends, size = [], [], [0], 0
        if rows_ids:
            yield _lists(rows_ids, values, ends)

    parts = cut_up(source, ask)
    return answered(parts, spread(spark, n), answer, finish, "id long, ids array<int>").withColumnRenamed("id", id_col)


def _lists(ids: list, values: list, ends: list[int]) -> pa.RecordBatch:
    flat = pa.array(np.concatenate(values) if values else np.empty(0, np.int32), pa.int32())
    field = pa.field("element", pa.int32(), nullable=True)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, type=pa.list_(field))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], ["id", "ids"])


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with out_col binary: the bytes of its ids, joined from the token-byte table (bounded by the vocabulary).

    Null ids give null; an id outside the table is an error.
    """
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = encoded.withColumn(out_col, F.lit(None).cast("binary")).schema

    def run(batches):
        table = tokens.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            got = [None if row is None else b"".join(map(table.__getitem__, row.values.to_numpy(zero_copy_only=False).tolist())) for row in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], [*batch.schema.names, out_col])

    return encoded.mapInArrow(run, schema)
