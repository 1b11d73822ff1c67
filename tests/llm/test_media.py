import os
import random

import numpy as np
import pytest

from lahar.llm import media


def padded(t: bytes) -> bytes:
    return t + b" " * (-len(t) % 192 if t else 192)


def payloads():
    rng = random.Random(2)
    return [padded(b""), padded(b"".join(rng.choices([b"the ", b"and ", b"of\n"], k=9000))), os.urandom(192 * 5), bytes([0, 255] * 96), padded(("é" * 9000).encode()), b" " * 192 * 300, b"a" * 192 * 3]


def test_round_trip():
    p = payloads()
    streams = media.write_flac(p)
    back = media.read_flac(streams)
    assert [x for x, _ in back] == p
    for s, (_, points) in zip(streams, back, strict=True):
        assert all(s[o : o + 2] == b"\xff\xf8" for _, o in points.tolist())


@pytest.mark.parametrize("at", [-1, -30, 100])
def test_changed_byte_is_found(at):
    s = bytearray(media.write_flac([payloads()[1]])[0])
    s[at if at < 0 else s.index(b"\xff\xf8") + at] ^= 4
    with pytest.raises(ValueError):
        media.read_flac([bytes(s)])


def test_foreign_frames():
    """Fixed order 4, partitioned and escaped residuals, and an odd block size, built bit by bit."""
    x = np.array([3, 5, 8, 12, 17, 23, 30, 38, 47, 57, 60, 61, 59, 58, 50, 41], np.int64)
    r = x.copy()
    for _ in range(4):
        r = np.concatenate([r[:1] * 0, np.diff(r)])
    bits = ""
    put = lambda v, n: format(v & ((1 << n) - 1), f"0{n}b")
    head = bytes([0xFF, 0xF8, 0x60, 0x02, 0x00, 15])
    crc8 = int(media.CRC8.of(np.frombuffer(head, np.uint8), np.array([0]), np.array([len(head)]))[0])
    bits += put(12 << 1, 8) + "".join(put(int(v), 8) for v in x[:4]) + put(0, 2) + put(1, 4)
    res = [int(v) for v in r]
    full = x.tolist()
    res = [full[i] - (4 * full[i - 1] - 6 * full[i - 2] + 4 * full[i - 3] - full[i - 4]) for i in range(4, 16)]
    bits += put(2, 4)
    for v in res[:4]:
        u = v * 2 if v >= 0 else -v * 2 - 1
        bits += "0" * (u >> 2) + "1" + put(u & 3, 2)
    bits += put(15, 4) + put(9, 5) + "".join(put(v, 9) for v in res[4:])
    bits += "0" * (-len(bits) % 8)
    frame = head + bytes([crc8]) + int(bits, 2).to_bytes(len(bits) // 8, "big")
    crc = int(media.CRC16.of(np.frombuffer(frame, np.uint8), np.array([0]), np.array([len(frame)]))[0])
    frame += crc.to_bytes(2, "big")
    import hashlib
    import struct

    pcm = x.astype(np.int8).tobytes()
    info = struct.pack(">HH", 16, 16) + bytes(6) + ((8000 << 44) | (7 << 36) | 16).to_bytes(8, "big") + hashlib.md5(pcm).digest()
    assert media.read_flac([b"fLaC\x80" + len(info).to_bytes(3, "big") + info + frame])[0][0] == pcm


def test_table(spark):
    texts = [None, "", "hello", "hello", "x" * 5000, "é\n" * 300]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, payload int")
    stored = media.encode_media(df)
    rows = {r.doc_id: r for r in media.read_media(stored).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert bytes(rows[i].payload) == padded(raw) and rows[i].n_bytes == len(raw)
    assert rows[2].media == rows[3].media
    blocks = media.pcm_blocks(stored).where("doc_id = 4").orderBy("sample_offset").collect()
    assert b"".join(bytes(b.pcm) for b in blocks) == padded(b"x" * 5000)
    assert media.read_media(media.encode_media(df.limit(0))).collect() == []


def plain_decoder(stream):
    """A FLAC decoder of 8-bit mono streams of its own, bit by bit after the format's description."""
    assert stream[:4] == b"fLaC"
    at, samples = 4, None
    while True:
        last, kind, size = stream[at] >> 7, stream[at] & 127, int.from_bytes(stream[at + 1 : at + 4], "big")
        if kind == 0:
            samples = int.from_bytes(stream[at + 14 : at + 22], "big") & ((1 << 36) - 1)
        at += 4 + size
        if last:
            break
    bits = "".join(f"{b:08b}" for b in stream[at:])
    p, out = 0, []

    def take(n, signed=False):
        nonlocal p
        v = int(bits[p : p + n], 2) if n else 0
        p += n
        return v - (1 << n) if signed and n and v >> (n - 1) else v

    while len(out) < samples:
        assert take(14) == 0b11111111111110
        take(2)
        code = take(4)
        take(4 + 8)
        lead = take(8)
        for _ in range(max(0, 8 - len(bin(lead ^ 0xFF)[2:]) - 1) if lead & 0x80 else 0):
            take(8)
        block = {1: 192}.get(code) or (take(8) + 1 if code == 6 else take(16) + 1)
        take(8)
        assert take(1) == 0
        kind = take(6)
        assert take(1) == 0
        if kind == 0:
            x = [take(8, True)] * block
        elif kind == 1:
            x = [take(8, True) for _ in range(block)]
        else:
            order = kind - 8 if kind < 32 else kind - 31
            x = [take(8, True) for _ in range(order)]
            if kind < 32:
                coef, shift = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order], 0
            else:
                width, shift = take(4) + 1, take(5, True)
                coef = [take(width, True) for _ in range(order)]
            assert take(2) == 0
            split = take(4)
            for part in range(1 << split):
                k = take(4)
                for _ in range((block >> split) - (order if part == 0 else 0)):
                    q = 0
                    while not take(1):
                        q += 1
                    u = (q << k) | take(k)
                    x.append(((u >> 1) ^ -(u & 1)) + (sum(c * v for c, v in zip(coef, x[::-1])) >> shift))
        out += x
        p += -p % 8 + 16
    return bytes(v & 255 for v in out)


def test_streams_read_by_an_independent_decoder():
    rng = np.random.default_rng(8)
    payloads = [b" " * 192, "Ein Text mit Umlauten äöü. ".encode() * 60, bytes(rng.integers(0, 256, 192 * 9, np.uint8)), bytes(range(97, 121)) * 24, b"word " * 192 * 30]
    payloads = [p + b" " * (-len(p) % 192) for p in payloads]
    for p, stream in zip(payloads, media.write_flac(payloads), strict=True):
        assert plain_decoder(stream) == p


def test_very_long_payload_goes_in_slices(monkeypatch):
    monkeypatch.setattr(media, "SLICE_FRAMES", 64)
    text = b"".join(b"line %d of a long text\n" % i for i in range(20_000))
    payload = text + b" " * (-len(text) % 192)
    stream = media.write_flac([payload, b"x" * 192])
    assert [p for p, _ in media.read_flac(stream)] == [payload, b"x" * 192]
    monkeypatch.undo()
    assert media.write_flac([payload, b"x" * 192]) == stream
