"""Secret scans: fixed patterns, and the guess cost of what stands in a credential's place.

Patterns find assigned values, access keys and hex runs. Beyond them, a value after a credential word (see CONTEXT) is
a secret if it would take more than 10^`strength` guesses. Its cost is that of the cheapest way to cut it into pieces,
found by dynamic programming: a word of the corpus costs what its frequency says, upper case and look-alike characters
a little more, and dates, repeated blocks, walks over the keyboard and spans of brute force what there are of them. So
`password=correct horse` or `pin: 20010101` are no secrets, and `pwd: qT7#vLz9p` is one.

Words are counted in all texts, without the values themselves, so that a value can't vouch for itself. Texts are cut
into chunks; each sends the counts of its distinct words to hashed buckets and asks there for the words that its
values may hold, and gets only these back: one shuffle, no key with a group, nothing whole on the driver but the
number of all words. Values of any length are looked up: a value's distinct words, about 22 a letter in runs of letters, are held
in one task, and so are those of its chunk.

Null and empty texts have no spans. Repeated rows give a row each, null ids too. An empty table gives an empty result.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from math import comb, inf, log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import answered, buckets_for, cut_up, dealt, docs_in, spread, text_bytes

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Runs of 16 and more: as a run is taken whole, shorter ones can be left out at once.
HEX = re.compile(rb"[0-9a-f]{16,}")
#: What announces a credential, and the value after it up to a space, quote, bracket, comma or semicolon.
CONTEXT = re.compile(
    rb"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|(?:access|private|auth|signing|encryption)[_-]?key|auth|login|pin|bearer)"""
    rb"""["'`]?\x20*(?:=>|:=|[:=])\x20*["'`]?([^\s"'`<>,;()\[\]{}]+)"""
)
KINDS = ["assign", "access", "hex", "guess"]
SPAN = "struct<kind: string, start: long, end: long, cost: double>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])

SHORTEST_WORD, LONGEST_WORD = 3, 24
LONGEST_LOOKED_UP = 128
LONGEST_BLOCK = 12
#: log10 of what each piece costs besides itself: where it ends.
PIECE = log10(2)
DAYS, YEARS = 365, 200
#: Rows of keys as they lie: each row is half a key to the right of the one above.
ROWS = ["1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]
#: Characters that stand for letters they look like.
ALIKE = {"4": "a", "@": "a", "3": "e", "1": "l", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PLAIN = bytes(ord(ALIKE[chr(b)]) if chr(b) in ALIKE else b + 32 if 65 <= b <= 90 else b for b in range(256))
_KEYS = {ord(x): (r, c) for r, row in enumerate(ROWS) for c, x in enumerate(row)}
_DATE = re.compile(rb"(?:19|20)\d\d(?:([-/._]?)(?:0?[1-9]|1[0-2])\1(?:3[01]|[12]\d|0?[1-9]))?|(?:3[01]|[12]\d|0?[1-9])([-/._]?)(?:3[01]|[12]\d|0?[1-9])\2(?:(?:19|20)\d\d|\d\d)")


def _char(b: int) -> float:
    return log10(10 if 48 <= b <= 57 else 26 if 65 <= b <= 90 or 97 <= b <= 122 else 33 if b < 128 else 64)


CHAR = [_char(b) for b in range(256)]


def words_in(value: bytes, longest: int | None = LONGEST_LOOKED_UP) -> set[bytes]:
    """Every word that a value may hold, look-alike characters read as letters; none of values over longest bytes, if given."""
    if longest is not None and len(value) > longest:
        return set()
    out = set()
    for run in value.translate(_PLAIN).translate(_LETTERS).split():
        for i in range(len(run) - SHORTEST_WORD + 1):
            out.update(run[i:j] for j in range(i + SHORTEST_WORD, min(len(run), i + LONGEST_WORD) + 1))
    return out


def word_cost(piece: bytes, count: int, total: int) -> float:
    """log10 of the guesses for a word seen count times among total, as it is written."""
    upper = sum(65 <= b <= 90 for b in piece)
    letters = upper + sum(97 <= b <= 122 or b >= 128 for b in piece)
    if upper == 0:
        case = 0.0
    elif upper == letters or (upper == 1 and 65 <= piece[0] <= 90):
        case = log10(2)
    else:
        case = log10(sum(comb(letters, k) for k in range(1, upper + 1)))
    return log10((total + 1) / count) + case + log10(2) * sum(chr(b) in ALIKE for b in piece)


def date_ends(value: bytes, i: int) -> list[tuple[int, float]]:
    """(end, cost) of dates that begin at i: a year, or a day and a year in any usual order."""
    out = []
    if value[i : i + 1].isdigit():
        for end in range(i + 4, min(len(value), i + 10) + 1):
            if _DATE.fullmatch(value, i, end):
                dashes = 0 if value[i:end].isdigit() else log10(4)
                out.append((end, log10(YEARS) if end == i + 4 and value[i : i + 2] in (b"19", b"20") else log10(DAYS * YEARS) + dashes))
    return out


def _near(a: int, b: int) -> tuple[int, int] | None:
    """The step between two keys that touch."""
    if a in _KEYS and b in _KEYS:
        (r, c), (s, d) = _KEYS[a], _KEYS[b]
        if (s - r, d - c) in ((0, 1), (0, -1), (-1, 0), (-1, 1), (1, -1), (1, 0)):
            return s - r, d - c
    return None


def walk_ends(value: bytes) -> list[tuple[int, float] | None]:
    """For each place, (end, cost) of the longest walk over touching keys from there, if it has three keys."""
    low = value.lower()
    step = [_near(a, b) for a, b in zip(low, low[1:], strict=False)] + [None]
    end, turns = [0] * len(low), [0] * len(low)
    for i in reversed(range(len(low))):
        end[i] = i + 1 if step[i] is None else end[i + 1]
        turns[i] = 0 if step[i] is None or step[i + 1] is None else turns[i + 1] + (step[i] != step[i + 1])
    keys = sum(map(len, ROWS))
    return [(e, log10(keys) + log10(e - i) + log10(6) * (t + 1)) if e - i >= 3 else None for i, (e, t) in enumerate(zip(end, turns, strict=True))]


def repeat_ends(value: bytes) -> list[list[tuple[int, float]]]:
    """For each place, (end, cost) of each block that stands there at least twice, with all its repetitions."""
    n, out = len(value), [[] for _ in value]
    for b in range(1, min(LONGEST_BLOCK, n // 2) + 1):
        same = 0
        brute = sum(CHAR[x] for x in value[n - b :])
        for i in reversed(range(n - b)):
            same = same + 1 if value[i] == value[i + b] else 0
            brute += CHAR[value[i]] - CHAR[value[i + b]]
            if (times := 1 + same // b) > 1:
                out[i].append((i + times * b, brute + log10(times)))
    return out


def guess_cost(value: bytes, counts: dict[bytes, int], total: int) -> float:
    """log10 of the guesses for the cheapest way to cut value into words, dates, repeats, walks and brute force."""
    n, plain = len(value), value.translate(_PLAIN)
    walks, repeats = walk_ends(value), repeat_ends(value)
    best = [0.0] + [inf] * n
    brute = inf  # the last piece is brute force and goes on
    for i in range(n):
        here = best[i] = min(best[i], brute)
        brute = min(brute, here + PIECE) + CHAR[value[i]]
        ends = [*date_ends(value, i), *repeats[i], *([walks[i]] if walks[i] else [])]
        for j in range(i + SHORTEST_WORD, min(n, i + LONGEST_WORD) + 1):
            if c := counts.get(plain[i:j]):
                ends.append((j, word_cost(value[i:j], c, total)))
        for j, cost in ends:
            best[j] = min(best[j], here + cost + PIECE)
    return min(best[n], brute)


def base_spans(data: bytes, low: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes of what the fixed patterns find; low is data in lower case."""
    out = [(m.start(), m.end(), 2) for m in HEX.finditer(data)]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(data) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= 12]
    return out


def values_in(data: bytes, low: bytes) -> list[tuple[int, int]]:
    """(start, end) in bytes of the values in a credential's place, without punctuation behind them."""
    found = ((m.start(1), m.start(1) + len(data[m.start(1) : m.end(1)].rstrip(b".:!?"))) for m in CONTEXT.finditer(low))
    return [(a, b) for a, b in found if b > a]


def _points(data: bytes, at: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte offset."""
    begins = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.where(at > 0, begins[np.maximum(at, 1) - 1], 0)


def found_secrets(docs: DataFrame, strength: float = 10.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): kind, start and end in code points, and the log10 of guesses for kind guess; by start, then kind."""
    source = docs_in(docs, id_col, text_col)
    buckets = buckets_for(text_bytes(docs, text_col))
    letters = F.regexp_count("text", F.lit(r"[a-zA-Z\x{80}-\x{10FFFF}]+"))
    total = source.agg(F.sum(letters.cast("long"))).head()[0] or 0

    def by_bucket(words: list[bytes]) -> list[tuple[int, list[int]]]:
        place = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
        return [(b, at.tolist()) for b, at in dealt(place)]

    def ask(ids: list, texts: list[bytes | None]):
        rows, counts, wanted = [], Counter(), set()
        for i, t in zip(ids, texts, strict=True):
            data = t or b""
            low = data.lower()
            base, values = base_spans(data, low), values_in(data, low)
            left = 0
            for a, b in values:
                counts.update(data[left:a].translate(_LETTERS).split())
                wanted |= words_in(data[a:b], None)
                left = b
            counts.update(data[left:].translate(_LETTERS).split())
            at = sorted({x for a, b, *_ in (*base, *values) for x in (a, b)})
            point = dict(zip(at, _points(data, np.array(at, np.int64)).tolist(), strict=True)) if at else {}
            rows.append((i, [(point[a], point[b], k) for a, b, k in base], [(point[a], point[b], data[a:b]) for a, b in values]))
        words = [w for w in counts if SHORTEST_WORD <= len(w) <= LONGEST_WORD]
        wanted = sorted(wanted)
        told = {b: ([words[j] for j in at], np.array([counts[words[j]] for j in at], np.int32)) for b, at in by_bucket(words)}
        asked = {b: [wanted[j] for j in at] for b, at in by_bucket(wanted)}
        none = ([], np.empty(0, np.int32))
        return (rows, asked), [(b, (b" ".join(w), c.tobytes(), b" ".join(asked.get(b, [])))) for b in told.keys() | asked.keys() for w, c in [told.get(b, none)]]

    def answer(questions: list[tuple[bytes, bytes, bytes]]) -> list[list[int]]:
        wanted = [q[2].split() for q in questions]
        seen = dict.fromkeys((w for some in wanted for w in some), 0)
        if seen:
            for words, counts, _ in questions:
                for w, c in zip(words.split(), np.frombuffer(counts, np.int32).tolist(), strict=True):
                    if w in seen:
                        seen[w] += c
        return [[seen[w] for w in some] for some in wanted]

    def finish(kept: tuple, got: dict[int, list[int]]):
        rows, asked = kept
        counts = {w: c for b, words in asked.items() for w, c in zip(words, got[b], strict=True) if c}
        cost = lru_cache(1 << 14)(lambda value: guess_cost(value, counts, total))
        ids, spans = [], []
        for i, base, values in rows:
            guessed = [(a, b, 3, g) for a, b, value in values if (g := cost(value)) > strength]
            some = sorted([*((a, b, k, None) for a, b, k in base), *guessed], key=lambda s: (s[0], s[2]))
            ids.append(i)
            spans.append([{"kind": KINDS[k], "start": a, "end": b, "cost": g} for a, b, k, g in some])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, pa.list_(_SPAN))], ["id", "spans"])

    found = answered(cut_up(source, ask), spread(docs.sparkSession, buckets), answer, finish, f"id long, spans array<{SPAN}>")
    return found.withColumnRenamed("id", id_col)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, how many spans of each fixed kind, a hash of these, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
