"""Toxicity: bags of subword embeddings, averaged into a linear softmax and trained jointly with it in numpy.

A word's vector is the mean of the vectors of its hashed character n-grams and of itself; a text's vector is the
mean of its words' vectors. So a misspelling that was never seen shares most n-grams with the word it hides.
As the classifier is linear, a trained model comes down to one number for each hashed n-gram and a bias, which is
what executors get (SUBWORDS floats, whatever the corpus). Training rows are at most max_rows labelled documents,
the first by hash of their id, and of these the first max_bytes: a documented bound on a classifier's sample; all
texts are scored, whole, also very long ones. Documents that share an id with a label are rows each, once for each
different label of the id.

Null and empty texts have the score of the bias alone. Repeated rows are scored each. Without training rows, or
with one label only, the score is that label's smoothed share. Rows of labels without a document, or with a null
label, are not used. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lahar.llm.common import docs_in, small_batches

SUBWORDS = 1 << 16
SHORTEST, LONGEST = 3, 6
DIM = 4
BATCH = 32
#: Texts average hundreds of words; this keeps their mean vectors near size one.
SCALE = np.float32(50)
EPOCHS = 6
#: Weight decay of the subword table: rare n-grams stay near zero.
DECAY = 1e-5
MIN_TEXTS = 3
RATE = 0.01
CACHE = 500_000


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word, hashed cell) of every n-gram of each word in angle brackets, and of the word itself."""
    marked = [f"<{w.decode(errors='replace').lower()}>" for w in words]
    size = np.array([len(m) for m in marked], np.int64)
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    room = np.repeat(end, size) - np.arange(len(points))
    base = np.uint64(0x9E3779B97F4A7C15)
    hashed, owners, cells = np.zeros(len(points), np.uint64), [], []
    cell = lambda h: ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % SUBWORDS
    for n in range(1, LONGEST + 1):
        if n > len(points):
            break
        hashed = hashed[: len(points) - n + 1] * base + points[n - 1 :]
        if n >= SHORTEST:
            fits = np.flatnonzero(room[: len(hashed)] >= n)
            owners.append(owner[fits])
            cells.append(cell(hashed[fits] + np.uint64(n)))
    place = np.arange(len(points)) - np.repeat(end - size, size)
    powers = np.multiply.accumulate(np.full(int(size.max()) + 1 if len(size) else 1, base, np.uint64))
    whole = np.add.reduceat(points * powers[place], end - size) if len(size) else np.empty(0, np.uint64)
    return np.concatenate([*owners, np.arange(len(words))]), np.concatenate([*cells, cell(whole)])


@dataclass
class Model:
    """log odds of a text = bias + mean over its words of the mean over their subwords of weight."""

    weight: np.ndarray
    bias: float


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Sparse Adam over batches of texts, on the log loss of the softmax, for embeddings and output weights together."""
    y = np.asarray(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(SUBWORDS, np.float32), float(np.log(share / (1 - share))))
    rows, cols, values = [], [], []
    for d, t in enumerate(texts):
        words: dict[bytes, int] = {}
        for w in t.split():
            words[w] = words.get(w, 0) + 1
        if words:
            owner, cell = subwords(list(words))
            share = np.array(list(words.values())) / np.bincount(owner) / sum(words.values())
            col, where = np.unique(cell, return_inverse=True)
            rows.append(np.full(len(col), d, np.int32))
            cols.append(col.astype(np.int32))
            values.append((np.bincount(where, share[owner]) * SCALE).astype(np.float32))
    row, col, value = (np.concatenate(x) if x else np.empty(0, k) for x, k in ((rows, np.int32), (cols, np.int32), (values, np.float32)))
    seen = np.bincount(col, minlength=SUBWORDS) >= MIN_TEXTS
    keep = seen[col]
    row, col, value = row[keep], col[keep], value[keep]
    used, col = np.unique(col, return_inverse=True)
    col = col.astype(np.int32)
    rng = np.random.default_rng(seed)
    turn = rng.permutation(len(y))
    place = np.argsort(turn)
    order = np.argsort(place[row], kind="stable")
    row, col, value = place[row][order], col[order], value[order]
    y = y[turn]
    batches = []
    for at in range(0, len(y), BATCH):
        i, j = np.searchsorted(row, [at, at + BATCH])
        own, local = np.unique(col[i:j], return_inverse=True)
        by_own = np.argsort(local, kind="stable")
        lines, starts = np.unique(row[i:j] - at, return_index=True)
        sorted_starts = np.searchsorted(local[by_own], np.arange(len(own)))
        small = lambda x: x.astype(np.int32)
        batches.append((y[at : at + BATCH].astype(np.int64), small(own), small(local), value[i:j, None], lines, starts, small((row[i:j] - at)[by_own]), small(by_own), sorted_starts))
    table = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, out, bias)]
    steps = epochs * len(batches)
    for step in range(steps):
        label, own, local, share, lines, starts, back, by_own, own_starts = batches[step % len(batches)]
        bag = np.zeros((len(label), DIM), np.float32)
        if len(own):
            bag[lines] = np.add.reduceat(table[own][local] * share, starts)
        z = bag @ out + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        g = p / len(label)
        to_bag = g @ out.T
        grads = [(np.add.reduceat(to_bag[back] * share[by_own], own_starts) + DECAY * table[own] if len(own) else table[:0], own), (bag.T @ g + DECAY * out, slice(None)), (g.sum(0), slice(None))]
        rate = RATE * (1 - step / steps)
        for (m, v), param, (grad, at) in zip(state, (table, out, bias), grads, strict=True):
            m[at] = 0.9 * m[at] + 0.1 * grad
            v[at] = 0.99 * v[at] + 0.01 * grad * grad
            param[at] -= rate * m[at] / (np.sqrt(v[at]) + 1e-6)
    weight = np.zeros(SUBWORDS, np.float32)
    weight[used] = table @ (out[:, 1] - out[:, 0]) * SCALE
    return Model(weight, float(bias[1] - bias[0]))


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo folds."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)).cast("int")


def train(docs: DataFrame, labels: DataFrame, label_col: str, folds: int = 5, held: int = 0, max_rows: int = 3000, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most max_rows labelled documents outside the held-out fold, the first of at most max_bytes in all
    (and the one that passes it), by hash of their id."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(fold("label_id", folds) != held)
    # labels meet their documents before the sample is taken: labels without one must not use it up
    # a row's key is its id, a hash of its text and a number among equals, so that rows of one id stay apart
    source = docs_in(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    equals = F.row_number().over(Window.partitionBy("id", "h").orderBy(F.lit(1)))
    found = source.select("id", "h", F.octet_length("text").alias("bytes")).join(known.select(F.col("label_id").alias("id")).distinct(), "id", "left_semi")
    found = found.withColumn("n", equals).where(F.col("n") <= max_rows)
    order = [F.xxhash64("id"), "id", "label", "h", "n"]
    sample = known.distinct().join(found, F.col("label_id") == F.col("id")).select("id", "h", "n", "label", "bytes").orderBy(*order).limit(max_rows)
    # at most max_rows rows, so one task can sum their bytes in order; the first row always stays
    size = F.sum(F.coalesce("bytes", F.lit(0))).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sample = sample.withColumn("before", F.coalesce(size, F.lit(0))).where(F.col("before") < max_bytes).select("id", "h", "n", "label")
    rows = source.join(F.broadcast(sample.select("id", "h").distinct()), ["id", "h"], "left_semi").withColumn("n", equals).where(F.col("n") <= max_rows)
    rows = rows.join(F.broadcast(sample), ["id", "h", "n"]).select("id", "text", "label")

    def fit_rows(batches):
        got = sorted(r for batch in batches for r in zip(batch.column(0).to_pylist(), (t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()), batch.column(2).to_pylist(), strict=True))
        model = fit([t for _, t, _ in got], [y for _, _, y in got])
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias])], ["weight", "bias"])

    # the bounded sample is fitted by one task, so the driver only sees the model
    got = rows.coalesce(1).mapInArrow(fit_rows, "weight binary, bias double").head()
    return Model(np.frombuffer(bytes(got.weight), np.float32), got.bias) if got else fit([], [])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the probability of label 1 for every whole text."""
    source, shared = docs_in(docs, id_col, text_col), docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    def run(batches):
        weight, bias = shared.value.weight, shared.value.bias
        known: dict[bytes, float] = {}
        for batch in batches:
            texts = [t.split() if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]
            if len(known) > CACHE:
                known.clear()
            if new := [w for w in set().union(*texts) if w not in known]:
                owner, cell = subwords(new)
                known.update(zip(new, (np.bincount(owner, weight[cell]) / np.bincount(owner)).tolist(), strict=True))
            means = np.array([sum(map(known.__getitem__, words)) / len(words) if words else 0.0 for words in texts])
            out = 1 / (1 + np.exp(-np.clip(bias + means, -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "score"])

    return source.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)
