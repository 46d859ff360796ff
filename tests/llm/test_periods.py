"""Runs against brute force, with small tiles, and the query against a plain reading of its contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidewater.llm import periods, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            e = i
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            if e - i + q >= max(6, 4 * q):
                out.setdefault((i, e - i + q), q)  # the smallest period of a stretch comes first
            i = max(e, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def texts(seed, count, longest):
    r = random.Random(seed)
    for _ in range(count):
        out = []
        while len(out) < r.randrange(1, longest):
            unit = [r.choice("abcd") for _ in range(r.choice((1, 1, 2, 3, 5, 8, 13, 40)))]
            out += (unit * r.randrange(1, 12))[: r.randrange(1, 200)]
        yield " ".join(out)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "p", 5) for i, t in rows], "doc_id long, text string, uid long, runs string, period int").repartition(3)
    found = periods.repetitions(docs).collect()
    assert len(found) == len(rows)
    seen = [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed, r.collapsed_sha256) for r in found]
    wanted = []
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = brute_runs(w)
        kept = collapsed(w, runs)
        wanted.append((i, len(w), runs, kept if runs else None, sha(kept)))
    assert sorted(seen, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("tile", [64, 8192])
def test_runs_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(periods, "TILE", tile)
    rows = list(enumerate(texts(tile, 150, 900)))
    rows += [(1000, "x " * 3000), (1001, " ".join(f"u{i}" for i in range(500)) + " " + " ".join(f"v{i % 170}" for i in range(1500)))]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a a a a a"), (5, "a a a a a a"), (None, "b c " * 4), (6, "b c " * 4), (6, "é  " * 9), (7, "x\x1fy " * 8), (8, "A a A a A a A")]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periods.repetitions(empty).count() == 0


def test_z_function():
    r = random.Random(2)
    for _ in range(200):
        s = [r.choice("ab") for _ in range(r.randrange(1, 40))]
        plain = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periods.z_function(s, len(s)) == plain


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def test_query_follows_its_contract(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(9, 120, 300))]
    rows += [(i, " ".join(f"w{random.Random(i).randrange(50)}" for _ in range(i % 90))) for i in range(200, 400)] + [(500, None), (501, "")]
    rows += [(i, t) for i, t in zip((i for i in range(600, 900) if zlib.crc32(str(i).encode()) % 10 == 0), (None, "", " \t", "one", "one two"))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in queries.op13_periods(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    hit = 0
    for i, t in rows:
        w = planted(i, t)
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        hit += zlib.crc32(str(i).encode()) % 10 == 0 and bool(runs)
        listed = sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert tuple(found[i]) == (i, len(runs), *best, milli, listed, sha(collapsed(w, runs))), i
    assert hit > 10
