"""Media columns: FLAC streams written and read in numpy, many frames at a time.

write_flac stores any bytes as signed 8-bit mono samples; read_flac decodes Rice residuals and linear predictors,
verifies the CRC-8 and CRC-16 of every frame and the stream's MD5, and gives the samples back; pcm_blocks cuts
them into blocks with their sample offset and the byte offset of the frame that holds it.

A null or empty text is one padded unit of spaces. Repeated rows give a row each; equal texts give equal bytes.
An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import docs_in, small_batches

UNIT = 192
SEEK_FRAMES = 4
SAMPLE_RATE = 8000
LPC_BITS, LPC_SHIFT = 12, 10
BATCH_BYTES = 2 << 20
#: Frames coded, and lanes decoded, side by side: what bounds memory, also for one very long text.
SLICE_FRAMES = 1 << 14
#: Fixed predictors of the FLAC format, orders 0 to 4.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def _crc_rows(poly: int, bits: int, length: int) -> np.ndarray:
    """row[i, b]: what byte b adds to the CRC of a message when i bytes follow it (initial value 0)."""
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    step = []
    for b in range(256):
        r = b << (bits - 8)
        for _ in range(8):
            r = ((r << 1) ^ poly if r & top else r << 1) & mask
        step.append(r)
    table = np.array(step, np.uint16)
    rows = np.empty((length, 256), np.uint16)
    rows[0] = table
    for i in range(1, length):
        rows[i] = (rows[i - 1] << 8) & mask ^ table[rows[i - 1] >> (bits - 8)] if bits == 16 else table[rows[i - 1]]
    return rows


class _Crc:
    def __init__(self, poly: int, bits: int):
        self.poly, self.bits, self.rows = poly, bits, _crc_rows(poly, bits, 512)

    def of(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC of each of many pieces of data."""
        if len(start) == 0:
            return np.empty(0, np.uint16)
        while len(self.rows) < length.max():
            self.rows = _crc_rows(self.poly, self.bits, 2 * len(self.rows))
        first = np.concatenate([[0], np.cumsum(length)[:-1]])
        i = np.arange(length.sum()) - np.repeat(first, length)
        part = self.rows[np.repeat(length, length) - 1 - i, data[np.repeat(start, length) + i]]
        return np.bitwise_xor.reduceat(part, first)


CRC8, CRC16 = _Crc(0x07, 8), _Crc(0x8005, 16)


class _Bits:
    """Fields of up to 17 bits at any bit positions; fields never overlap, so adding bytes is the same as or."""

    def __init__(self):
        self.at, self.value, self.width = [], [], []

    def put(self, at, value, width) -> None:
        at, value, width = np.broadcast_arrays(at, value, width)
        self.at.append(at.flatten())
        self.value.append(value.flatten())
        self.width.append(width.flatten())

    def pack(self, size: int) -> np.ndarray:
        at, value, width = np.concatenate(self.at), np.concatenate(self.value).astype(np.int32), np.concatenate(self.width).astype(np.int32)
        word, byte = value << (24 - (at & 7).astype(np.int32) - width), at >> 3
        out = np.zeros(size + 3)
        for j in range(3):
            out[: size + 2 - j] += np.bincount(byte + j, (word >> (16 - 8 * j)) & 255, size + 2)[: size + 2 - j]
        return out[:size].astype(np.uint8)


def _residuals(x: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
    """(subframe type, residual, coefficients) of each predictor tried: fixed order 1, and least squares of order 2."""
    d1 = x[:, 1:] - x[:, :-1]
    f = x.astype(np.float32)
    aa, ab = np.einsum("ij,ij->i", f, f), np.einsum("ij,ij->i", f[:, 1:], f[:, :-1])
    far = np.einsum("ij,ij->i", f[:, 2:], f[:, :-2])
    det = aa * aa - ab * ab
    flat = det < 1
    safe = np.where(flat, 1, det)
    limit = (1 << (LPC_BITS - 1)) - 1
    coef = np.stack([np.where(flat, 1, (ab * aa - far * ab) / safe), np.where(flat, 0, (far * aa - ab * ab) / safe)], 1)
    coef = np.clip(np.rint(coef * (1 << LPC_SHIFT)), -limit, limit).astype(np.int32)
    guess = (x[:, 1:-1] * coef[:, :1] + x[:, :-2] * coef[:, 1:]) >> LPC_SHIFT
    return [(9, d1, None), (33, x[:, 2:] - guess, coef)]


def _packed(x: np.ndarray, number: np.ndarray) -> tuple[bytes, np.ndarray]:
    """FLAC frames of rows of UNIT samples with their frame numbers: their bytes one after another, and each length."""
    n = len(x)
    best, kind, rice = np.full(n, 8 * UNIT, np.int64), np.full(n, 1, np.int64), np.zeros(n, np.int64)
    tried = _residuals(x)
    folded = []
    for code, r, coef in tried:
        u = (r << 1) ^ (r >> 31)
        folded.append(u)
        extra = (8 if coef is None else 16 + 9 + 2 * LPC_BITS) + 10
        k = np.clip(np.log2(u.mean(1) * 0.7 + 0.5).astype(np.int64), 0, 10)
        size = (u >> k[:, None].astype(np.int32)).sum(1) + (k + 1) * u.shape[1] + extra
        better = size < best
        best[better], kind[better], rice[better] = size[better], code, k[better]
    still = (x == x[:, :1]).all(1)
    kind[still], best[still] = 0, 8
    # frame number in the UTF-8 way, up to 31 bits
    more = np.select([number < 1 << 7, number < 1 << 11, number < 1 << 16, number < 1 << 21, number < 1 << 26], [0, 1, 2, 3, 4], 5)
    head = 6 + more
    length = head + 1 + (best + 7) // 8 + 2
    start = np.concatenate([[0], np.cumsum(length)])
    at, bits = start[:-1] * 8, _Bits()
    for j, byte in enumerate((0xFF, 0xF8, 0x10, 0x02)):
        bits.put(at + 8 * j, byte, 8)
    lead = np.where(more == 0, number, ((0xFF00 >> (more + 1)) & 0xFF) | (number >> (6 * more)))
    bits.put(at + 32, lead, 8)
    for j in range(1, 6):
        w = more >= j
        bits.put(at[w] + 32 + 8 * j, 0x80 | ((number[w] >> (6 * (more[w] - j))) & 0x3F), 8)
    body = at + 8 * head
    bits.put(body, kind << 1, 8)
    body += 8
    bits.put(body[still], x[still, 0] & 255, 8)
    raw = kind == 1
    for (code, _, coef), u in zip(tried, folded, strict=True):
        w = np.flatnonzero(kind == code)
        if not len(w):
            continue
        p, order = body[w].copy(), UNIT - u.shape[1]
        bits.put(p[:, None] + 8 * np.arange(order), x[w, :order] & 255, 8)
        p += 8 * order
        if coef is not None:
            bits.put(p, LPC_BITS - 1, 4)
            bits.put(p + 4, LPC_SHIFT, 5)
            bits.put(p[:, None] + 9 + LPC_BITS * np.arange(order), coef[w] & ((1 << LPC_BITS) - 1), LPC_BITS)
            p += 9 + LPC_BITS * order
        bits.put(p + 6, rice[w], 4)
        k, v = rice[w, None].astype(np.int32), u[w]
        ends = (p + 10)[:, None] + np.cumsum((v >> k) + 1 + k, 1)
        bits.put(ends - k - 1, (1 << k) | (v & ((1 << k) - 1)), k + 1)
    out = bits.pack(int(start[-1]))
    out[(start[:-1] + head + 1)[raw, None] + np.arange(UNIT)] = x[raw].astype(np.uint8)
    out[start[:-1] + head - 1] = CRC8.of(out, start[:-1], head - 1)
    crc = CRC16.of(out, start[:-1], length - 2)
    out[start[1:] - 2], out[start[1:] - 1] = crc >> 8, crc & 255
    return out.tobytes(), length


def write_flac(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload, whose length is a positive multiple of UNIT; SLICE_FRAMES frames at a time."""
    counts = np.array([len(p) // UNIT for p in payloads], np.int64)
    x = np.frombuffer(b"".join(payloads), np.int8).reshape(-1, UNIT)
    number = np.arange(len(x)) - np.repeat(np.cumsum(counts) - counts, counts)
    parts = [_packed(x[i : i + SLICE_FRAMES].astype(np.int32), number[i : i + SLICE_FRAMES]) for i in range(0, len(x), SLICE_FRAMES)]
    data, length = b"".join(p for p, _ in parts), np.concatenate([k for _, k in parts]) if parts else np.empty(0, np.int64)
    start, streams, i = np.concatenate([[0], np.cumsum(length)]), [], 0
    for payload, c in zip(payloads, counts.tolist(), strict=True):
        own = start[i : i + c + 1]
        sizes = length[i : i + c]
        info = struct.pack(">HH", UNIT, UNIT) + int(sizes.min()).to_bytes(3, "big") + int(sizes.max()).to_bytes(3, "big")
        info += ((SAMPLE_RATE << 44) | (0 << 41) | (7 << 36) | len(payload)).to_bytes(8, "big") + hashlib.md5(payload).digest()
        points = np.arange(0, c, SEEK_FRAMES)
        table = np.zeros(len(points), [("sample", ">u8"), ("offset", ">u8"), ("samples", ">u2")])
        table["sample"], table["offset"], table["samples"] = points * UNIT, own[points] - own[0], UNIT
        seek = table.tobytes()
        streams.append(b"fLaC" + b"\0" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + data[own[0] : own[-1]])
        i += c
    return streams


class _Reader:
    """Windows of 57 bits and more at any bit position of one buffer."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        self.data, self.words = padded, np.ndarray(len(padded) - 8, ">u8", padded, 0, (1,)).astype(np.uint64)

    def window(self, at: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(at >> 3, len(self.words) - 1)] << (at & 7).astype(np.uint64)

    def take(self, at: np.ndarray, width) -> np.ndarray:
        """Unsigned fields of 0 to 32 bits."""
        width = np.asarray(width)
        got = (self.window(at) >> np.uint64(1)) >> (63 - width).astype(np.uint64)
        return got.astype(np.int64)

    def signed(self, at: np.ndarray, width) -> np.ndarray:
        got = self.take(at, width)
        return got - ((got >> (np.asarray(width) - 1)) << np.asarray(width))

    def unary(self, at: np.ndarray) -> np.ndarray:
        """Zeros before the next one."""
        zeros, going = np.zeros(len(at), np.int64), np.arange(len(at))
        while len(going):
            top = (self.window(at[going] + zeros[going]) >> np.uint64(11)).astype(np.float64)
            run = np.where(top == 0, 48, 53 - np.frexp(top)[1])
            zeros[going] += run
            going = going[top == 0]
            if len(going) and (at[going] + zeros[going] > 8 * len(self.data)).any():
                raise ValueError("FLAC: a Rice code runs past the end")
        return zeros


def _metadata(stream: bytes) -> tuple[dict, np.ndarray, int]:
    """STREAMINFO, the seek points (sample, offset), and where frames begin."""
    if stream[:4] != b"fLaC":
        raise ValueError("FLAC: no stream marker")
    at, info, points = 4, {}, np.zeros((0, 2), np.int64)
    last = False
    while not last:
        last, kind, size = stream[at] >> 7, stream[at] & 127, int.from_bytes(stream[at + 1 : at + 4], "big")
        block = stream[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(block[10:18], "big")
            info = {"block": int.from_bytes(block[2:4], "big"), "bits": ((packed >> 36) & 31) + 1, "channels": ((packed >> 41) & 7) + 1, "samples": packed & ((1 << 36) - 1), "md5": block[18:34]}
        elif kind == 3:
            table = np.frombuffer(block, [("sample", ">u8"), ("offset", ">u8"), ("samples", ">u2")])
            table = table[table["sample"] != 2**64 - 1]
            points = np.stack([table["sample"].astype(np.int64), table["offset"].astype(np.int64)], 1)
        at += 4 + size
    if info.get("bits") != 8 or info.get("channels") != 1:
        raise ValueError("FLAC: only 8-bit mono streams are stored here")
    return info, points, at


def read_flac(streams: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """(samples as bytes, seek points as (sample, byte offset in the stream)) of each stream. Raises on a wrong checksum.

    Every seek point starts a lane of its own; lanes are decoded side by side, a frame each at a time.
    """
    metas = [_metadata(s) for s in streams]
    base = np.concatenate([[0], np.cumsum([len(s) for s in streams])])
    lanes, ends, first, seeks = [], [], [], []
    total = 0
    for (info, points, at), b in zip(metas, base.tolist(), strict=False):
        if not len(points) or points[0, 0] != 0:
            points = np.array([[0, 0]], np.int64)
        seeks.append(points + [0, at])
        lanes.append(points[:, 1] + at + b)
        ends.append(np.append(points[1:, 0], info["samples"]) + total)
        first.append(points[:, 0] + total)
        total += info["samples"]
    reader, out = _Reader(np.frombuffer(b"".join(streams), np.uint8)), np.empty(total, np.int8)
    every = [np.concatenate(part) if part else np.empty(0, np.int64) for part in (lanes, first, ends)]
    for i in range(0, len(every[0]), SLICE_FRAMES):
        at, sample, end = (part[i : i + SLICE_FRAMES] for part in every)
        while len(at):
            at, block = _frames(reader, at, sample, end, out)
            sample = sample + block
            going = sample < end
            at, sample, end = at[going], sample[going], end[going]
    pcm, got, i = out.tobytes(), [], 0
    for (info, _, _), points in zip(metas, seeks, strict=True):
        own = pcm[i : i + info["samples"]]
        i += info["samples"]
        if hashlib.md5(own).digest() != info["md5"]:
            raise ValueError("FLAC: the MD5 of the samples is wrong")
        got.append((own, points))
    return got


def _frames(r: _Reader, start: np.ndarray, sample: np.ndarray, end: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decode one frame of each lane into out; where each ends, and its samples."""
    data, n = r.data, len(start)
    if ((data[start] != 0xFF) | (data[start + 1] & 0xFE != 0xF8)).any():
        raise ValueError("FLAC: no frame where one is due")
    code, lead = data[start + 2] >> 4, data[start + 4].astype(np.int64)
    more = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [0, 1, 2, 3, 4, 5], 6)
    at = (start + 5 + more) * 8
    block = np.select([code == 1, (code >= 2) & (code <= 5), code >= 8], [192, 576 << np.maximum(code.astype(np.int64) - 2, 0), 256 << np.maximum(code.astype(np.int64) - 8, 0)], 0)
    for c, width in ((6, 8), (7, 16)):
        w = code == c
        block[w] = r.take(at[w], width) + 1
        at[w] += width
    rate = data[start + 2] & 15
    at += np.select([rate == 12, (rate == 13) | (rate == 14)], [8, 16], 0)
    if (block == 0).any() or (block > end - sample).any():
        raise ValueError("FLAC: a block size is wrong")
    if (CRC8.of(data, start, at // 8 - start) != data[at // 8]).any():
        raise ValueError("FLAC: the CRC-8 of a frame header is wrong")
    at += 8
    head = r.take(at, 8)
    at += 8
    if (head & 0x81).any():
        raise ValueError("FLAC: wasted bits are not used here")
    kind = head >> 1
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (fixed | lpc | (kind <= 1)).all():
        raise ValueError("FLAC: an unknown subframe type")
    order = np.select([fixed, lpc, kind == 0], [kind - 8, kind - 31, 1], block)
    longest, deepest = int(block.max()), int(np.where(kind == 1, 0, order).max())
    x = np.zeros((n, longest), np.int64)
    plain = np.flatnonzero(kind <= 1)
    for w in (plain[kind[plain] == 0], plain[kind[plain] == 1]):
        if len(w):
            same = kind[w[0]] == 0
            col = np.arange(1 if same else int(block[w].max()))
            got = r.signed(at[w, None] + 8 * col, 8)
            x[w, : len(col)] = got
            if same:
                x[w] = got[:, :1]
            at[w] += np.where(same, 8, 8 * block[w])
    p = np.flatnonzero(kind > 1)
    if len(p):
        depth, pos = order[p], at[p]
        for i in range(deepest):
            w = depth > i
            x[p[w], i] = r.signed(pos[w], 8)
            pos[w] += 8
        coef, shift = np.zeros((len(p), deepest), np.int64), np.zeros(len(p), np.int64)
        for o in range(1, min(4, deepest) + 1):
            coef[(kind[p] == 8 + o), :o] = FIXED[o]
        w = np.flatnonzero(lpc[p])
        if len(w):
            width = r.take(pos[w], 4) + 1
            shift[w] = r.signed(pos[w] + 4, 5)
            pos[w] += 9
            for i in range(deepest):
                v = depth[w] > i
                coef[w[v], i] = r.signed(pos[w[v]], width[v])
                pos[w[v]] += width[v]
        method, split = r.take(pos, 2), r.take(pos + 2, 4)
        pos += 6
        each, rice, raw = block[p] >> split, np.zeros(len(p), np.int64), np.zeros(len(p), bool)
        for i in range(longest):
            # parameters stand before the first residual of each partition
            due = np.flatnonzero(((i == depth) | ((i > depth) & (i % each == 0))) & (i < block[p])) if i <= deepest or (i % each == 0).any() else ()
            if len(due):
                width = 4 + (method[due] == 1)
                rice[due] = r.take(pos[due], width)
                pos[due] += width
                raw[due] = rice[due] == (1 << width) - 1
                esc = due[raw[due]]
                rice[esc] = r.take(pos[esc], 5)
                pos[esc] += 5
            on = slice(None) if i >= deepest and i < int(block[p].min()) and not raw.any() else np.flatnonzero((i >= depth) & (i < block[p]))
            here, k = pos[on], rice[on]
            window = r.window(here)
            top = (window >> np.uint64(11)).astype(np.float64)
            zeros = 53 - np.frexp(top)[1].astype(np.int64)
            far = np.flatnonzero((top == 0) | (zeros + k > 55))
            low = ((window << (zeros + 1).astype(np.uint64)) >> np.uint64(1) >> (63 - k).astype(np.uint64)).astype(np.int64)
            if len(far):
                zeros[far] = r.unary(here[far])
                low[far] = r.take(here[far] + zeros[far] + 1, k[far])
            u = (zeros << k) | low
            value, used = (u >> 1) ^ -(u & 1), zeros + 1 + k
            if raw.any():
                w = np.flatnonzero(raw[on])
                value[w] = np.where(k[w] > 0, r.signed(here[w], np.maximum(k[w], 1)), 0)
                used[w] = k[w]
            pos[on] = here + used
            rows = p[on]
            if deepest and i:
                depths = min(i, deepest)
                guess = (x[rows, i - depths : i][:, ::-1] * coef[on, :depths]).sum(1)
                value = value + (guess >> shift[on])
            x[rows, i] = value
        at[p] = pos
    stop = (at + 7) // 8
    crc = (data[stop].astype(np.int64) << 8) | data[stop + 1]
    if (CRC16.of(data, start, stop - start) != crc).any():
        raise ValueError("FLAC: the CRC-16 of a frame is wrong")
    where = np.repeat(sample, block) + np.arange(block.sum()) - np.repeat(np.cumsum(block) - block, block)
    out[where] = x[np.repeat(np.arange(n), block), where - np.repeat(sample, block)]
    return stop + 2, block


def _grouped(batches, column: str, limit: int = BATCH_BYTES):
    """Record batches cut so that a binary column holds about limit bytes in each."""
    for batch in batches:
        sizes = [len(v) if (v := x.as_py()) is not None else 0 for x in batch.column(batch.schema.get_field_index(column))]
        start, size = 0, 0
        for i, s in enumerate(sizes):
            size += s
            if size >= limit:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text's bytes, padded with spaces to a positive multiple of UNIT, as a FLAC stream."""
    source = docs_in(docs, id_col, text_col).select("id", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("raw"))

    small_batches(docs.sparkSession)

    def run(batches):
        for batch in _grouped(batches, "raw"):
            raw = batch.column(1).to_pylist()
            padded = [t + b" " * (-len(t) % UNIT if t else UNIT) for t in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in raw], pa.int64()), pa.array(write_flac(padded), pa.binary())], ["id", "n_bytes", "media"])

    return source.mapInArrow(run, "id long, n_bytes long, media binary").withColumnRenamed("id", id_col)


def blocks_of(pcm: bytes, points: np.ndarray, block: int = UNIT * SEEK_FRAMES) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sample offset of each block of samples, byte offset of the last seek point at or before it, and the blocks."""
    at = np.arange(0, len(pcm), block)
    return at, points[np.searchsorted(points[:, 0], at, "right") - 1, 1], [pcm[a : a + block] for a in at.tolist()]


def read_media(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media with payload binary, feature string and n_blocks, from the stored stream's PCM blocks; null streams give nulls.

    feature: samples, sum, sum of squares, peak, and changes of sign against the previous sample.
    """
    schema = media.withColumn("payload", F.lit(None).cast("binary")).withColumn("feature", F.lit(None).cast("string")).withColumn("n_blocks", F.lit(None).cast("long")).schema

    def feature(pcm: bytes) -> str:
        x = np.frombuffer(pcm, np.int8).astype(np.int64)
        return f"{len(x)};{x.sum()};{(x * x).sum()};{np.abs(x).max()};{((x[1:] < 0) != (x[:-1] < 0)).sum()}"

    def run(batches):
        for batch in _grouped(batches, media_col):
            streams = batch.column(batch.schema.get_field_index(media_col)).to_pylist()
            read = iter(read_flac([s for s in streams if s is not None]))
            blocks = [None if s is None else blocks_of(*next(read))[2] for s in streams]
            got = [None if b is None else b"".join(b) for b in blocks]
            own = [pa.array(got, pa.binary()), pa.array([g and feature(g) for g in got]), pa.array([b and len(b) for b in blocks], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "payload", "feature", "n_blocks"])

    return media.mapInArrow(run, schema)


def pcm_blocks(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", block: int = UNIT * SEEK_FRAMES) -> DataFrame:
    """(doc_id, sample_offset, byte_offset, pcm): blocks of block samples; byte_offset is the last seek point at or before it."""

    def run(batches):
        for batch in _grouped(batches, "media"):
            keep = [(i, s) for i, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if s is not None]
            for (i, _), (pcm, points) in zip(keep, read_flac([s for _, s in keep]), strict=True):
                at, byte, pieces = blocks_of(pcm, points, block)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(at), pa.int64()), pa.array(at), pa.array(byte), pa.array(pieces, pa.binary())], ["id", "sample_offset", "byte_offset", "pcm"])

    source = media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media"))
    return source.mapInArrow(run, "id long, sample_offset long, byte_offset long, pcm binary").withColumnRenamed("id", id_col)
