"""Every numbered query runs through the entry module and agrees with its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidewater.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings benchmark labels".split()


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _same(a, b):
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, float) or isinstance(b, float):
        return (a is None) == (b is None) and (a is None or math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-12))
    return a == b


#: The columns that make a row of a query one of its kind.
KEYS = {"op11_negatives": ("anchor_id", "positive_id", "rank"), "op12_near_vectors": ("vec_id",)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, db, name):
    df = entry_module.queries()[name](spark, SF)
    cursor = db.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(r[k] for k in KEYS.get(name, ("doc_id",)))
    ours = sorted((r.asDict() for r in df.collect()), key=key)
    theirs = sorted((dict(zip(names, r, strict=True)) for r in cursor.fetchall()), key=key)
    assert ours and len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert all(_same(a[c], b[c]) for c in names), (a, b)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_without_sql_covers_its_table(spark, db, name):
    got = entry_module.queries()[name](spark, SF).collect()
    if name == "op8_neighbours":
        asked = db.execute("SELECT vec_id FROM embeddings WHERE vec_id % 20 = 0").fetchall()
        assert sorted({r.query_id for r in got}) == sorted(v for (v,) in asked) and len(got) == 20 * len(asked)
    else:
        assert sorted(r.doc_id for r in got) == sorted(d for (d,) in db.execute("SELECT doc_id FROM documents").fetchall())
