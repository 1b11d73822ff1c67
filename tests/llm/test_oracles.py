"""Every registered query of the corpus operators over its whole table: against its SQL, or its fixed columns by hand."""

import hashlib
import math
import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from lahar.llm import queries

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(x):
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.10g}")
    return x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    got = duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == cols
    assert sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in got.fetchall()) == rows


def test_language_model_columns(spark):
    docs = {r.doc_id: (r.text or "") for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    got = queries.QUERIES["op4_maxent_scores"](spark, DIR).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    tokens = {i: [*t.encode().lower().split(), None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    known = {w for i, t in tokens.items() if not held[i] for w in t}
    total = sum(len(t) for i, t in tokens.items() if not held[i])
    for r in got:
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), total)
        assert r.n_known == sum(w in known for w in tokens[r.doc_id]) and r.score < 0


def test_media_columns(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    got = queries.QUERIES["op9_flac_media"](spark, DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        padded = docs[r.doc_id] + b" " * (-len(docs[r.doc_id]) % 192 if docs[r.doc_id] else 192)
        assert (r.n_bytes, r.payload_bytes) == (len(docs[r.doc_id]), len(padded))
        assert r.payload_sha256 == hashlib.sha256(padded).hexdigest() and r.tail_crc32 == zlib.crc32(padded[-16:])


@pytest.mark.parametrize(("name", "table"), [("op5_toxicity", "documents"), ("op6_byte_bpe", "documents"), ("op7_language_id", "pages")])
def test_query_keeps_every_row(spark, name, table):
    key = "page_id" if table == "pages" else "doc_id"
    want = sorted(r[0] for r in spark.read.parquet(f"{DIR}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in queries.QUERIES[name](spark, DIR).select(F.col(key)).collect()) == want
