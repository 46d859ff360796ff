"""Hard negatives against brute force: exact products, bands, ties, odd rows, tiles."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, positives int, _part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2) for r in rows], SCHEMA)


def brute(rows, every, positives=5, wanted=10, low=30, high=90):
    kept = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) for x in v):
            kept.setdefault(i, (label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = set()
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scores = {i: sum(x * y for x, y in zip(v, w, strict=True)) for i, (_, w) in kept.items() if i != a}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if kept[i][0] == label][:positives]:
            fit = [i for i in order if kept[i][0] != label and low * scores[p] <= 100 * scores[i] <= high * scores[p]]
            out |= {(a, p, n + 1, i, scores[p], scores[i]) for n, i in enumerate(fit[:wanted])}
    return out


def result(df):
    rows = df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert len(rows) == len(set(map(tuple, rows)))
    return set(map(tuple, rows))


@pytest.mark.parametrize("size", [1.0, 5e4, 1.5e6])
def test_scores_are_exact(size):
    r = np.random.default_rng(3)
    x, a = (np.floor(r.standard_normal((n, 7)) * size * 256).astype(np.int64) for n in (2500, 3))
    packed = negatives.Packed(x, a)
    for row in a:
        assert packed.scores(row).tolist() == [sum(int(p) * int(q) for p, q in zip(v, row, strict=True)) for v in x]
    assert packed.width == {1.0: 4, 5e4: 8, 1.5e6: 16}[size]


def test_odd_rows_ties_and_repeats(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)], r.randrange(3)) for i in range(300)]
    rows += [(10, rows[10][1], 9), (7000, None, 1), (7007, [0.5, None, 0.0, 0.0, 0.0, 0.0], 1), (7014, [float("nan")] * 6, 1), (7021, [float("inf")] * 6, 1)]
    rows += [(None, [1.0] * 6, 1), (7028, [1.0] * 6, None), (7035, [0.0] * 6, 2)]
    other = [(7042, [1.0] * 5, 1), (7049, [], 1), (7056, [1e30] * 6, 1)]  # another length, and too long for scores that fit
    assert result(negatives.mine(table(spark, rows + other), F.col("vec_id") % 7 == 0)) == brute(rows, 7)


def test_many_tiles_agree(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 10)
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v], 0 if i % 3 else i % 5) for i, v in enumerate(r.standard_normal((400, 8)).astype(np.float32))]
    assert result(negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0)) == brute(rows, 10)


def test_empty_tables_and_single_labels(spark):
    assert negatives.mine(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    alone = [(100, [1.0, 0.0], 1), (1, [0.5, 0.5], 2)]
    assert negatives.mine(table(spark, alone), F.col("vec_id") % 100 == 0).count() == 0
    same = [(i, [1.0, 0.0], 1) for i in range(4)]
    assert negatives.mine(table(spark, same), F.col("vec_id") % 2 == 0).count() == 0
