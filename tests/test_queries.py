"""Every registered query of the library runs and agrees with its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidewater.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return (a is None) == (b is None) and (a is None or math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-12))
    return a == b


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_agrees_with_sql(spark, db, name):
    df = entry_module.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = db.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    theirs = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted(names) == columns and len(ours) == len(theirs)
    key = lambda r: tuple((x is None, str(x) if not isinstance(x, (int, float)) else f"{float(x):030.6f}") for x in r)
    for a, b in zip(sorted(ours, key=key), sorted(theirs, key=key), strict=True):
        assert all(map(_same, a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert entry_module.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
