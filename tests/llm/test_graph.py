"""Near-duplicate vectors against brute force: clusters, borders, shards, pieces of near copies, odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import graph, neighbours

SCHEMA = "vec_id long, embedding array<float>, cell string, copies int, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "c", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.9):
    """{id: (links, component)}; of rows that repeat an id the smallest usable vector."""
    good = {}
    for i, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if i is not None and ok:
            v = tuple(np.float32(x) for x in v)
            good[i] = min(good.get(i, v), v)
    ids = sorted({i for i, _ in rows if i is not None})
    near = {i: set() for i in ids}
    for d in {len(v) for v in good.values()}:
        own = [i for i in good if len(good[i]) == d]
        x = np.array([good[i] for i in own], float)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if a != b:
                near[own[a]].add(own[b])
    comp = {}
    for i in ids:
        if i not in comp:
            stack = [i]
            comp[i] = i
            while stack:
                for j in near[stack.pop()]:
                    if j not in comp:
                        comp[j] = i
                        stack.append(j)
    return {i: (len(near[i]), comp[i]) for i in ids}


def found(df):
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()]


def clusters(seed, n, dim, sizes, noise):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    parts = [x]
    for size in sizes:
        y = x[r.integers(n)] + noise * r.standard_normal((size, dim)) / np.sqrt(dim)
        parts.append(y * r.uniform(0.5, 3, (size, 1)))
    x = np.concatenate(parts).astype(np.float32)
    return [(int(i), v) for i, v in zip(r.permutation(len(x)), x, strict=True)]


def same(spark, rows, least=1.0, **options):
    got = found(graph.links(table(spark, rows), **options))
    wanted = brute(rows)
    assert sorted(i for i, *_ in got) == sorted(wanted)
    assert all(n <= wanted[i][0] for i, n, _, _ in got)  # nothing but true links
    links = sum(n for n, _ in wanted.values())
    assert sum(n for _, n, _, _ in got) >= least * links > 0
    if least == 1.0:
        assert all(c == wanted[i][1] and kept == (i == c) for i, _, c, kept in got)


def test_clusters_in_one_shard(spark):
    same(spark, clusters(1, 800, 32, [1, 1, 1, 2, 3, 5, 30, 200], 0.2))


@pytest.mark.parametrize("noise", [0.1, 0.42])
def test_overlapping_shards(spark, monkeypatch, noise):
    """Many small shards; at a noise of 0.42 most links lie just above the threshold."""
    monkeypatch.setattr(graph, "PIECE", 300)
    same(spark, clusters(2, 1500, 32, [1] * 60 + [8] * 10, noise), 1.0 if noise < 0.2 else 0.97)


def test_near_copies_in_pieces(spark, monkeypatch):
    """A third of all rows are near copies: they stay in one shard, whose pieces meet two by two."""
    monkeypatch.setattr(graph, "PIECE", 250)
    same(spark, clusters(3, 1200, 24, [600], 0.1))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0, 0]), (4, [nan, 1]), (5, [inf, 1]), (6, [None, 1]), (7, [1, 0]), (8, [2, 0]), (9, [1, 0]), (10, [1, 0, 0]), (11, [1, 0.01, 0])]
    rows += [(12, [0, 1]), (12, [0, -1]), (12, None), (13, [0, -3]), (14, [1e30, 1e30]), (15, [1e-30, 1e-30]), (16, [-1, -1])]
    got = {i: rest for i, *rest in found(graph.links(table(spark, [*rows, (None, [1, 0]), (None, None)]))) if i is not None}
    assert {i: tuple(v[:2]) for i, v in got.items()} == brute(rows)
    assert found(graph.links(table(spark, [(None, [1, 0]), (None, None)]))) == [(None, 0, None, True)] * 2
    assert graph.links(table(spark, [])).count() == 0


def test_all_nodes_can_be_reached():
    r = np.random.default_rng(4)
    centres = r.standard_normal((6, 16))
    x = graph._unit(np.concatenate([c + 0.01 * r.standard_normal((150, 16)) for c in centres]))
    lists = graph.build(x)
    seen, stack = {graph.medoid(x)}, [graph.medoid(x)]
    while stack:
        new = set(lists[stack.pop()].tolist()) - seen - {len(x)}
        seen |= new
        stack += new
    assert len(seen) == len(x)


def test_a_leaf_gives_ties_by_id(spark):
    """Thousands of equal products in one leaf, in the order of anything but their ids: the smallest ids come first."""
    spark.range(1).count()  # schemas are parsed by a session
    r = np.random.default_rng(8)
    n = 3000
    x = np.column_stack((np.full(n, 0.5), r.standard_normal((n, 7))))
    rows = [*({"level": None, "string": int(r.integers(1 << 40)), "vec_id": int(i), "v": v.tolist()} for i, v in zip(r.permutation(n) + 1, x, strict=True))]
    rows.append({"level": 0, "string": 5, "vec_id": 100_000, "v": [1.0] + [0.0] * 7})
    schema = pa.schema([("level", pa.int32()), ("string", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(pa.float64()))])
    search, _ = neighbours._leaf_search(20, "bigint", np.zeros(9), float((x * x).sum(axis=1).max()))
    assert search(pa.Table.from_pylist(rows, schema=schema))["vec_id"].to_pylist() == list(range(1, 21))
