"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

A token's probability is that of its class given what stands before, times its own within the class. Classes are
by hash (one is the end's alone). P(class | context) is a softmax over weights of hashed features: the word before,
the pair before, and the word before that one (a skip). Weights are trained by distributed gradient updates: in each
round every task descends over its texts from the same weights, and the weighted mean of the moves, summed by
grouped aggregation in slices, makes the next weights.

P(token | class, word before) is the in-class softmax: one indicator feature for each pair of words that occurs,
hashed to keys whose length grows with the corpus. As one such feature is on at a time, the weights that a gradient
leads to are known: a pair's share of its context within the class, shrunk by LEAN towards the token's smoothed share
of the class's training tokens (with one share left for words never seen), so every context sums to one. The counts
behind them are of all training texts, so what is gathered grows with the input; nothing of it is in one place.

A chunk of texts asks in one shuffle for the counts of its distinct words, pairs and contexts, and is scored in
sparse numpy batches. Null and empty texts are one end. Null ids are training rows. Repeated rows count and are
scored each. Very long texts are chunks of their own. An empty table gives an empty result. Other columns, whatever
their names, are not read. The class weights depend a little on how rows are dealt to tasks; counts do not.
"""

from __future__ import annotations

import zlib
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from lahar.llm.common import Numbered, answered, buckets_for, chunks_of, cut, cut_up, dealt, docs_in, drop, pack, recorded, runs, small_batches, spread, text_bytes, unpack
from lahar.llm.substrings import _deltas, _undeltas, mixed

CLASSES = 32
#: Hashed weights of each of the three features; with CLASSES columns they make the model's whole size.
CELLS = 1 << 13
SLICES = 16
STEP = 4096
RATE = 0.2
BLOCK = 1 << 16
END = b""
#: What the class's own shares weigh against a context's pairs.
LEAN = 8.0
#: Bits of a pair's key beyond the logarithm of the corpus's bytes: a pair shares its key with a chance under 2**-8.
KEY_BITS = 8


def held_out(i: int | None, folds: int, held: int) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % folds == held


def word_hash(word: bytes) -> int:
    return zlib.crc32(word)


def classes_of(hashes: np.ndarray, is_end: np.ndarray) -> np.ndarray:
    c = 1 + ((hashes.astype(np.uint64) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)) >> np.uint64(16)) % np.uint64(CLASSES - 1)
    return np.where(is_end, 0, c.astype(np.int64))


def features(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Three feature rows of each token, given every token's word hash and the places where texts begin."""
    h = hashes.astype(np.uint64) + np.uint64(1)
    one, two = np.zeros_like(h), np.zeros_like(h)
    one[1:], two[2:] = h[:-1], h[:-2]
    one[first] = 0
    two[first] = 0
    second = first[first + 1 < len(h)] + 1
    two[second] = 0
    mix = lambda x, k: ((x * np.uint64(k)) >> np.uint64(40)).astype(np.int64) % CELLS
    return np.stack([mix(one, 0x9E3779B97F4A7C15), mix(one * np.uint64(0xC2B2AE3D27D4EB4F) ^ (two + np.uint64(7)), 0xD6E8FEB86659FD93) + CELLS, mix(two, 0xA0761D6478BD642F) + 2 * CELLS], 1)


def _scores(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Each class's sum of weights, less the greatest."""
    z = weights.take(rows[:, 0], 0)
    z += weights.take(rows[:, 1], 0)
    z += weights.take(rows[:, 2], 0)
    z += bias
    z -= z.max(1, keepdims=True)
    return z


def _log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = _scores(weights, bias, rows)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = _scores(weights, bias, rows)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def descend(weights: np.ndarray, bias: np.ndarray, power: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """Gradient steps over batches of STEP tokens, in place; power sums squared gradients of each weight row."""
    for at in range(0, len(target), STEP):
        r, y = rows[at : at + STEP], target[at : at + STEP]
        g = _softmax(weights, bias, r)
        g[np.arange(len(y)), y] -= 1
        flat = r.T.ravel()
        order = np.argsort(flat, kind="stable")
        own, starts = np.unique(flat[order], return_index=True)
        total = np.add.reduceat(g.take(order % len(y), 0), starts)
        power[own] += (total * total).mean(1)
        weights[own] -= (RATE / np.sqrt(power[own] + 1e-6))[:, None] * total
        bias -= 0.01 * g.mean(0)


def _tokens(texts: list[bytes | None], number) -> list[np.ndarray]:
    end = number(END)
    return [np.fromiter([*map(number, (t or b"").lower().split()), end], np.int32) for t in texts]


def word_counts(texts: list[bytes | None]) -> tuple[Numbered, np.ndarray, np.ndarray]:
    """Words numbered, the number of every token, and the tokens of each text."""
    words = Numbered()
    codes = _tokens(texts, words.__getitem__)
    return words, np.concatenate(codes) if codes else np.empty(0, np.int32), np.array([len(c) for c in codes], np.int64)


def _kinds(words: list[bytes]) -> np.ndarray:
    return classes_of(np.fromiter(map(word_hash, words), np.uint32, len(words)), np.array([w == END for w in words], bool))


def train(source: DataFrame, folds: int, held: int, rounds: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(weights, bias, tokens, distinct words of each class): in round r, the training texts whose hashed id falls to
    r move the weights. The words of every round are merged by hash for the last two."""
    spark = source.sparkSession
    small_batches(spark)
    weights, bias = np.zeros((3 * CELLS, CLASSES), np.float32), np.zeros(CLASSES, np.float32)
    n, told = buckets_for(text_bytes(source, "text")), []
    schema = "slice long, seen long, data binary"

    def batch(rows):
        k, seen, data = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(seen, pa.int64()), pa.array(data, pa.binary())], ["slice", "seen", "data"])

    for r in range(rounds):
        own = source.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r)
        shared = spark.sparkContext.broadcast((weights, bias))

        def move(batches, shared=shared):
            """Moves of the weights as slices below zero, counted words as slices from zero."""
            w, b = (x.copy() for x in shared.value)
            power, seen = np.zeros(len(w), np.float32), 0
            for ids, texts in chunks_of(batches, 1 << 20):
                texts = [t for i, t in zip(ids, texts, strict=True) if not held_out(i, folds, held)]
                if not texts:
                    continue
                words, flat, sizes = word_counts(texts)
                hashes = np.fromiter(map(word_hash, words), np.uint32)
                is_end = np.zeros(len(hashes), bool)
                is_end[words[END]] = True
                descend(w, b, power, features(hashes[flat], np.cumsum(sizes) - sizes), classes_of(hashes, is_end)[flat])
                seen += len(flat)
                names, counts = list(words), np.bincount(flat, minlength=len(words))
                yield batch([(k, 0, pack((b"\n".join(names[i] for i in at.tolist()), counts[at]))) for k, at in dealt((hashes % np.uint32(n)).astype(np.int64))])
            if seen:
                moves = np.concatenate([(w - shared.value[0]).ravel(), b - shared.value[1]]) * seen
                yield batch([(-1 - k, seen, pack(part)) for k, part in enumerate(np.array_split(moves, SLICES))])

        def total(table: pa.Table) -> pa.Table:
            moves = 0
            for x in table.column("data"):
                moves = moves + unpack(x.as_py()).astype(np.float64)
            seen = sum(table.column("seen").to_pylist())
            return pa.Table.from_batches([batch([(table.column("slice")[0].as_py(), seen, pack((moves / seen).astype(np.float32)))])])

        out = cut(own.mapInArrow(move, schema), "maxent-moves")
        told.append(out)
        got = sorted((-x.slice, bytes(x.data)) for x in out.where("slice < 0").groupBy("slice").applyInArrow(total, schema).collect())
        if got:
            moves = np.concatenate([unpack(x) for _, x in got])
            weights = weights + moves[: weights.size].reshape(weights.shape)
            bias = bias + moves[weights.size :]

    def count(table: pa.Table) -> pa.Table:
        counts: dict[bytes, int] = {}
        for x in table.column("data"):
            words, own = unpack(x.as_py())
            for w, c in zip(words.split(b"\n"), own.tolist(), strict=True):
                counts[w] = counts.get(w, 0) + c
        kinds = _kinds(list(counts))
        tokens = np.bincount(kinds, np.fromiter(counts.values(), np.int64), CLASSES).astype(np.int64)
        return pa.table({"class": pa.array(np.arange(CLASSES)), "tokens": pa.array(tokens), "words": pa.array(np.bincount(kinds, minlength=CLASSES))})

    every = told[0]
    for out in told[1:]:
        every = every.union(out)
    sums = every.where("slice >= 0").groupBy("slice").applyInArrow(count, "class long, tokens long, words long").groupBy("class").agg(F.sum("tokens"), F.sum("words"))
    tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for k, t, d in sums.collect():  # a row for each class
        tokens[k], distinct[k] = t, d
    return weights.astype(np.float32), bias.astype(np.float32), tokens, distinct


def pair_keys(names: np.ndarray, kinds: np.ndarray, flat: np.ndarray, first: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of bits bits of each token: of its context (the word before and the token's class), and of the pair."""
    before = np.zeros(len(flat), np.uint64)
    before[1:] = names[flat[:-1]]
    before[first] = 1
    context = mixed(before * np.uint64(0x9E3779B97F4A7C15) + kinds[flat].astype(np.uint64) + np.uint64(1))
    return context >> np.uint64(64 - bits), mixed(context ^ mixed(names[flat])) >> np.uint64(64 - bits)


def score(docs: DataFrame, folds: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    base_score is the log10 probability under add-one unigrams of the training tokens, score that under the model.
    """
    spark = docs.sparkSession
    source = docs_in(docs, id_col, text_col)
    total = text_bytes(source, "text")
    n, bits = buckets_for(total), min(62, max(40, ceil(log2(total + 2)) + KEY_BITS))
    with recorded() as made:
        trained = train(source, folds, held)
    drop(spark, made)
    model = spark.sparkContext.broadcast(trained)

    def ask(ids, texts):
        """Counts of words go to buckets from zero, those of pairs and contexts to buckets below."""
        words, flat, sizes = word_counts(texts)
        held_rows = np.array([held_out(i, folds, held) for i in ids])
        learnt = np.repeat(~held_rows, sizes)
        names = list(words)
        counts = np.bincount(flat[learnt], minlength=len(names))
        hashes = np.fromiter(map(word_hash, names), np.uint32, len(names))
        place = (hashes % np.uint32(n)).astype(np.int32)
        asks: list = [(b, ([names[i] for i in at.tolist()], counts[at])) for b, at in dealt(place)]
        long = np.fromiter(map(xxh3_64_intdigest, names), np.uint64, len(names))
        for f, (own, where, parts) in enumerate(asked(long, hashes, words[END], flat, sizes)):
            seen = np.bincount(where, learnt, len(own)).astype(np.int64)
            seen = seen.astype(np.min_scalar_type(int(seen.max(initial=0))))
            asks += [(n + 2 * b + f, (_deltas(own[part].astype(np.int64)), seen[part])) for b, part in parts]
        return (ids, held_rows, sizes, flat, hashes, long, words[END]), asks

    def asked(long, hashes, end, flat, sizes):
        """Of contexts, then of pairs: distinct keys in order, where each token's key is among them, and their buckets.

        Found anew when answers come: as many numbers as tokens would be shuffled otherwise.
        """
        is_end = np.zeros(len(hashes), bool)
        is_end[end] = True
        for keys in pair_keys(long, classes_of(hashes, is_end), flat, np.cumsum(sizes) - sizes, bits):
            own, where = np.unique(keys, return_inverse=True)
            yield own, where, runs((own >> np.uint64(bits - 32)) * np.uint64(n) >> np.uint64(32))

    def answer(questions):
        """Sums over all chunks, of words or of keys."""
        if isinstance(questions[0][0], list):
            counts: dict[bytes, int] = {}
            for words, own in questions:
                for w, c in zip(words, own.tolist(), strict=True):
                    counts[w] = counts.get(w, 0) + c
            return [np.array([counts[w] for w in words], np.int64) for words, _ in questions]
        keys = [_undeltas(q[0]) for q in questions]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(where, np.concatenate([q[1] for q in questions])).astype(np.int64)
        sums = sums.astype(np.min_scalar_type(int(sums.max(initial=0))))
        ends = np.cumsum([0, *map(len, keys)])
        return [sums[where[i:j]] for i, j in zip(ends, ends[1:], strict=False)]

    def finish(kept, got):
        ids, held_rows, sizes, flat, hashes, long, end = kept
        count = np.zeros(len(hashes), np.int64)
        for b, own in dealt((hashes % np.uint32(n)).astype(np.int32)):
            count[own] = got[b]
        weights, bias, tokens, distinct = model.value
        n_all, v_all = tokens.sum(), distinct.sum()
        is_end = np.zeros(len(hashes), bool)
        is_end[end] = True
        kind = classes_of(hashes, is_end)
        base = np.log10((count + 1) / (n_all + v_all + 1))
        share = (count + 1) / (tokens + distinct + 1)[kind]
        seen = []
        for f, (own, where, parts) in enumerate(asked(long, hashes, end, flat, sizes)):
            told = np.zeros(len(own), np.int64)
            for b, part in parts:
                told[part] = got[n + 2 * b + f]
            seen.append(told[where])
        context, pair = seen
        value = np.log10((pair + LEAN * share[flat]) / (context + LEAN))
        first = np.cumsum(sizes) - sizes
        rows = features(hashes[flat], first)
        for i in range(0, len(flat), BLOCK):
            part = slice(i, i + BLOCK)
            z = _scores(weights, bias, rows[part])
            own = z[np.arange(len(z)), kind[flat[part]]]
            value[part] += (own - np.log(np.exp(z, out=z).sum(1))).astype(np.float64) / np.log(10)
        sums = lambda x: np.add.reduceat(x, first)
        arrays = [
            pa.array(ids, pa.int64()),
            pa.array(held_rows, pa.bool_()),
            pa.array(sizes, pa.int64()),
            pa.array(sums((count[flat] > 0).astype(np.int64))),
            pa.array(np.full(len(ids), int(n_all), np.int64)),
            pa.array(sums(base[flat])),
            pa.array(sums(value)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return answered(cut_up(source, ask), spread(spark, n), answer, finish, schema).withColumnRenamed("id", id_col)
