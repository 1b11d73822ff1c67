import random
from collections import defaultdict

import duckdb

from lahar.llm import lines
from lahar.llm.sql import LINES_SQL


def brute(rows, min_docs=3, share=0.6, min_tokens=3, leaf_shares=()):
    split = [[(x, x.split()) for x in (t or "").split("\n")] for _, t in rows]
    digit = lambda w: any(c in "0123456789" for c in w)
    leaf = lambda w: (len(w), tuple("<*>" if digit(x) else x for x in w[:3]))
    leaves, tokens, found = defaultdict(set), defaultdict(set), defaultdict(set)
    for r, ls in enumerate(split):
        for _, w in ls:
            if len(w) >= min_tokens:
                leaves[leaf(w)].add(r)
    hot = {k for k, v in leaves.items() if len(v) >= min_docs}
    for r, ls in enumerate(split):
        for _, w in ls:
            if len(w) >= min_tokens and leaf(w) in hot:
                for j, x in enumerate(w):
                    if not digit(x):
                        tokens[leaf(w), j, x].add(r)

    def templates(w):
        if len(w) < min_tokens or leaf(w) not in hot:
            return set()
        out = set()
        for least in [min_docs, *(max(min_docs, x * len(leaves[leaf(w)])) for x in leaf_shares)]:
            marks = [x if not digit(x) and len(tokens[leaf(w), j, x]) >= least else "<*>" for j, x in enumerate(w)]
            if sum(m != "<*>" for m in marks) >= share * len(w):
                out.add((leaf(w), tuple(marks)))
        return out

    order = lambda r: float("inf") if rows[r][0] is None else rows[r][0]
    for r, ls in enumerate(split):
        for _, w in ls:
            for t in templates(w):
                found[t].add(r)
    gone = lambda r, w: any(len(found[t]) >= min_docs and order(r) > min(map(order, found[t])) for t in templates(w))
    out = []
    for r, ls in enumerate(split):
        stay = [x for x, w in ls if not gone(r, w)]
        out.append((rows[r][0], len(ls), len(ls) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_matches_brute_force_and_generalises(spark):
    rows = [(i, f"unique {'abcdefghi'[i] * 4} words {'ihgfedcba'[i] * 5} here {'qrstuvwxy'[i] * 3}\nUser name{i} logged in from 10.0.0.{i}\nuser {'anna bob carl dora'.split()[i % 4]} saw the page today\n\nAll rights reserved.\nHi you") for i in range(9)]
    rows += [(20, None), (21, ""), (22, "All rights reserved."), (22, "All rights reserved."), (None, "All rights reserved.\r"), (30, "é " * 3000 + "\n7 7 7")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, kept string").repartition(3)
    got = lines.dedup_lines(df).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in got), key=str) == brute(rows)
    by = {r.doc_id: r.kept for r in got}
    assert "logged in" in by[0] and "logged in" not in by[5] and "unique ffff" in by[5] and "Hi you" in by[5]
    assert lines.dedup_lines(df.limit(0)).collect() == []
    carried = lines.dedup_lines(spark.createDataFrame([(1, "a b c", "en"), (1, "a b c", None)], "doc_id long, text string, lang string"), carry=("lang",))
    assert sorted(str(r.lang) for r in carried.collect()) == ["None", "en"]


def test_leaf_shares_match_brute_force_and_sql(spark):
    """Leaves of several kinds, fields of few and of many values, null, shared and unordered ids."""
    rng = random.Random(5)
    pick = lambda pool: "".join(chr(97 + int(c)) for c in str(rng.randrange(pool)))
    line = lambda: rng.choice([lambda: f"sent by mail to {pick(40)} on {pick(4)}", lambda: f"sent by mail from {pick(3)} at {rng.randrange(9)}", lambda: f"seen {pick(300)} and {pick(2)} there today", lambda: " ".join(pick(50) for _ in range(6)), lambda: ""])()
    rows = [(rng.choice([i, i, i, 7, None]), "\n".join(line() for _ in range(rng.randrange(1, 7)))) for i in range(150)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = lines.dedup_lines(df, leaf_shares=lines.SHARES)
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found.collect()), key=str)
    assert got == brute(rows, leaf_shares=lines.SHARES) and got != brute(rows)
    duck = duckdb.connect()
    duck.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    assert sorted(map(str, duck.execute(LINES_SQL).fetchall())) == sorted(str(tuple(r)) for r in lines.digest(found).collect())


def test_a_token_is_looked_up_once_for_all_shares(spark, monkeypatch):
    """Counts of hashes in one process: a token's twice, whatever the number of shares."""
    asked = []
    plain = lines._hash
    monkeypatch.setattr(lines, "_hash", lambda data: asked.append(data) or plain(data))
    seen = {}
    monkeypatch.setattr(lines, "cut_up", lambda source, ask: seen.setdefault("chunk", ask))
    monkeypatch.setattr(lines, "answered", lambda parts, at, answer, go_on, schema: seen.setdefault("steps", []).append(go_on) or spark.createDataFrame([], "id struct<id: long>, text string, n_lines long, n_removed long, kept string"))
    df = spark.createDataFrame([(i, "a line of eight common words stands here") for i in range(5)], "doc_id long, text string")
    lines.dedup_lines(df, leaf_shares=lines.SHARES)
    kept, asks = seen["chunk"]([{"id": i} for i in range(5)], [b"a line of eight common words stands here"] * 5)
    for step in seen["steps"][:2]:
        got = dict(zip([b for b, _ in asks], [a for q in asks for a in lines._summed([q[1]])], strict=True))
        kept, asks = step(kept, got)
    token = plain(lines._leaf(b"a line of eight common words stands here".split())) + b" 3 eight"
    assert asked.count(token) == 2 * 5
