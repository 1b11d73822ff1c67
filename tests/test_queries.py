"""Every registered query against its SQL in DuckDB, and without one, that it runs."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from lahar.plans import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(x):
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, (float, decimal.Decimal)):
        return None if math.isnan(x) else float(f"{float(x):.10g}")
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    if sql := registry.oracle_sql().get(name):
        got = duck.execute(sql)
        names = [c[0] for c in got.description]
        assert sorted(names) == cols
        assert sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in got.fetchall()) == rows
