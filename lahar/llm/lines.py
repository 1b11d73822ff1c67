"""Line dedup by a log-template tree.

The tree has a fixed depth: a line's leaf is its number of tokens and its leading tokens, where tokens with a digit
count as the field <*>. In a leaf, a token is constant at its position if min_docs documents have it there; other
tokens and those with a digit are fields, so the line's template is its constants with <*> between. A template is
recurring if min_docs documents hold it and at least `share` of its tokens are constants. Lines of a recurring
template go from every document but the one of smallest id (so what copies share survives once).

On large input most values of a field occur in min_docs documents. So a line has another template for each of
leaf_shares, in which a token is constant only if that share of the leaf's documents have it there too; the line
goes by any of its templates, so what the first finds stays found, and fields are fields at any size of the corpus.
Low shares serve leaves with several kinds of lines, high ones fields of few values. op2_template_lines takes SHARES.

Lines without a word and lines of fewer than min_tokens always stay. Null and empty texts are one empty line.
Each row is a document; rows that share the smallest id all keep their lines; null ids come after all others.
An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lahar.llm.common import CHUNK_BYTES, answered, arrow_schema, buckets_for, cut_up, nullable, runs, spread, text_bytes
from lahar.llm.substrings import _joined, _split

FIELD = b"<*>"
LEADING = 3
SHARES = (0.1, 0.3, 0.5)
NO_ID = (1 << 63) - 1
_KEY = np.dtype([("a", ">u8"), ("b", ">u8")])
_DIGIT = re.compile(rb"[0-9]").search


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _masked(token: bytes) -> bytes:
    return FIELD if _DIGIT(token) else token


def _leaf(tokens: list[bytes]) -> bytes:
    return b"%d %s" % (len(tokens), b" ".join(map(_masked, tokens[:LEADING])))


def _order(keys: np.ndarray) -> np.ndarray:
    """Ascending order of keys, which differ in their first half but for chance."""
    return np.lexsort((keys["b"].astype(np.uint64), keys["a"].astype(np.uint64)))


class _Counted:
    """How many documents of a chunk have each key, and the smallest id among them if given, dealt to n buckets by key."""

    def __init__(self, n: int):
        self.n, self.docs, self.least = n, {}, {}

    def add(self, keys, doc: int | None = None) -> None:
        docs, least = self.docs, self.least
        for k in keys:
            docs[k] = docs.get(k, 0) + 1
        if doc is not None:
            for k in keys:
                least[k] = min(least.get(k, doc), doc)

    def asks(self) -> list:
        """(bucket, (keys in order, documents, smallest ids)) for each bucket that has keys."""
        keys = np.frombuffer(b"".join(self.docs), _KEY)
        order = _order(keys)
        keys = keys[order]
        docs = np.fromiter(self.docs.values(), np.int32, len(keys))[order]
        least = np.fromiter((self.least[k] for k in self.docs), np.int64, len(keys))[order] if self.least else np.zeros(len(keys), np.int64)
        bucket = (keys["a"].astype(np.uint64) >> np.uint64(32)) * np.uint64(self.n) >> np.uint64(32)
        return [(b, (keys[run].tobytes(), docs[run], least[run])) for b, run in runs(bucket)]


def _summed(questions: list) -> list:
    """(documents, smallest id) of each key over all chunks, in the order asked."""
    every = np.concatenate([np.frombuffer(q[0], _KEY) for q in questions])
    order = _order(every)
    place = np.cumsum(np.concatenate([np.zeros(min(1, len(every)), bool), every[order][1:] != every[order][:-1]]))
    where = np.empty(len(every), np.int64)
    where[order] = place
    count = np.bincount(where, np.concatenate([q[1] for q in questions])) if len(every) else np.empty(0)
    least = np.full(len(count), NO_ID)
    np.minimum.at(least, where, np.concatenate([q[2] for q in questions]))
    ends = np.cumsum([0, *(len(q[1]) for q in questions)])
    return [(count[where[i:j]].astype(np.int64), least[where[i:j]]) for i, j in zip(ends, ends[1:], strict=False)]


def _answers(asked: list, got: dict, enough: int) -> dict[bytes, tuple[int, int]]:
    """key: (documents, smallest id), of keys that enough documents have."""
    out = {}
    for b, keys in asked:
        count, least = got[b]
        for i, c, m in zip((at := np.flatnonzero(count >= enough)).tolist(), count[at].tolist(), least[at].tolist(), strict=True):
            out[keys[16 * i : 16 * i + 16]] = (c, m)
    return out


def _unzip(kept) -> tuple[list, list[bytes], np.ndarray]:
    ids, packed, sizes = kept
    return ids, _split(zstandard.ZstdDecompressor().decompress(packed), sizes), sizes


def dedup_lines(docs: DataFrame, min_docs: int = 3, share: float = 0.6, min_tokens: int = 3, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), leaf_shares: tuple[float, ...] = ()) -> DataFrame:
    """(doc_id, *carry, text, n_lines, n_removed, kept): every row, with its remaining lines joined by newlines."""
    names = [f"c{k}" for k in range(len(carry))]
    row = F.struct(F.col(id_col).cast("long").alias("id"), *[F.col(c).alias(k) for c, k in zip(carry, names, strict=True)])
    source = docs.select(row.alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = nullable(StructType([source.schema["id"]]))
    own = arrow_schema(kind).field(0).type
    n = buckets_for(text_bytes(source, "text"))

    def by_doc(ids, texts):
        for i, t in zip(ids, texts, strict=True):
            yield NO_ID if i["id"] is None else i["id"], [(w, at) for at, line in enumerate((t or b"").split(b"\n")) if len(w := line.split()) >= min_tokens]

    def ask(ids, texts):
        """How many documents have a line in each leaf."""
        leaves = _Counted(n)
        for _, lines in by_doc(ids, texts):
            leaves.add({_hash(_leaf(w)) for w, _ in lines})  # ids matter for templates alone
        kept = (ids, zstandard.ZstdCompressor(level=6).compress(_joined(texts)), np.array([-1 if t is None else len(t) for t in texts], np.int64))
        asks = leaves.asks()
        return (kept, [(b, a[0]) for b, a in asks]), asks

    def places(got, kept):
        """In leaves that enough documents share: how many documents have each token at each position."""
        kept, asked = kept
        hot = {k: c for k, (c, _) in _answers(asked, got, min_docs).items()}
        tokens = _Counted(n)
        ids, texts, _ = _unzip(kept)
        for _, lines in by_doc(ids, texts):
            own = set()
            for w, _ in lines:
                if (leaf := _hash(_leaf(w))) in hot:
                    own |= {_hash(b"%s %d %s" % (leaf, j, x)) for j, x in enumerate(w) if not _DIGIT(x)}
            tokens.add(own)
        asks = tokens.asks()
        return (kept, hot, [(b, a[0]) for b, a in asks]), asks

    def every(w, hot, common) -> set[bytes]:
        leaf = _hash(_leaf(w))
        if leaf not in hot:
            return set()
        # a token is looked up once, whatever the number of shares; those that keep the same constants give one template
        docs = [-1 if _DIGIT(x) else common.get(_hash(b"%s %d %s" % (leaf, j, x)), 0) for j, x in enumerate(w)]
        found = {}
        for least in {min_docs, *(max(min_docs, x * hot[leaf]) for x in leaf_shares)}:
            fixed = sum(c >= least for c in docs)
            if fixed >= share * len(w) and fixed not in found:
                found[fixed] = _hash(leaf + b" ".join([x if c >= least else FIELD for c, x in zip(docs, w, strict=True)]))
        return set(found.values())

    def templates(got, kept):
        """How many documents hold each template, and the smallest id of them."""
        kept, hot, asked = kept
        common = {k: c for k, (c, _) in _answers(asked, got, min_docs).items()}
        found = _Counted(n)
        ids, texts, _ = _unzip(kept)
        held = []
        for doc, lines in by_doc(ids, texts):
            own = {at: some for w, at in lines if (some := every(w, hot, common))}
            held.append(own)
            found.add(set().union(*own.values()), doc)
        asks = found.asks()
        return (kept, held, [(b, a[0]) for b, a in asks]), asks

    def finish(got, kept):
        kept, held, asked = kept
        known = {k: m for k, (_, m) in _answers(asked, got, min_docs).items()}
        ids, texts, sizes = _unzip(kept)
        out, size = [], 0
        for i, t, s, marked in zip(ids, texts, sizes.tolist(), held, strict=True):
            doc = NO_ID if i["id"] is None else i["id"]
            gone = {at for at, some in marked.items() if any(known.get(m, doc) < doc for m in some)}
            left = b"\n".join([line for at, line in enumerate(t.split(b"\n")) if at not in gone]) if gone else t
            out.append((i, None if s < 0 else t, t.count(b"\n") + 1, len(gone), left))
            size += 2 * len(t)
            if size > CHUNK_BYTES:
                yield _batch(out, own)
                out, size = [], 0
        if out:
            yield _batch(out, own)

    parts, at = cut_up(source, ask), spread(docs.sparkSession, n)
    for step in (places, templates):
        parts = answered(parts, at, _summed, lambda kept, got, step=step: step(got, kept), None)
    out = answered(parts, at, _summed, lambda kept, got: finish(got, kept), StructType(kind.fields + StructType.fromDDL("text string, n_lines long, n_removed long, kept string").fields))
    return out.select(F.col("id.id").alias(id_col), *[F.col(f"id.{k}").alias(c) for c, k in zip(carry, names, strict=True)], F.col("text").alias(text_col), "n_lines", "n_removed", "kept")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    i, t, a, b, k = zip(*rows, strict=True)
    text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(i, kind), text(t), pa.array(a, pa.int64()), pa.array(b, pa.int64()), text(k)], ["id", "text", "n_lines", "n_removed", "kept"])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What is left of each document as a hash."""
    return found.select(id_col, "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
