"""Links of fuzzy lines that an edited run, a rim or a small vocabulary makes hard, against the rule itself."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidewater.llm import lines
from tidewater.llm.common import written


def line(r, n, vocabulary):
    return [f"w{r.randrange(vocabulary)}x" for _ in range(n)]


def turned(r, words, how):
    n, e = len(words), int(0.2 * len(words) + 1e-9)
    if how == "run":
        return words[: n - e] + ["la"] * e
    if how == "front":
        return [f"f{k}y" for k in range(e)] + words[: n - e] if e else words
    if how == "longer":  # e words added at the end of a line that is so much shorter
        return words[: n - e]
    out = list(words)
    for k in r.sample(range(n), e):
        out[k] = f"q{k}z"
    return out


@pytest.mark.parametrize("vocabulary", [3, 10_000])
def test_every_link_is_found(spark, vocabulary):
    r = random.Random(vocabulary)
    rows, pairs = [], []
    for k, (n, how) in enumerate([(n, how) for n in (10, 30, 50, 100, 300) for how in ("run", "front", "longer", "random")] * 2):
        words = line(r, n, vocabulary)
        if how == "run":
            words[n - int(0.2 * n + 1e-9) :] = ["na"] * int(0.2 * n + 1e-9)
        # Lines of one pair share a word of their own in every place that stays, so that pairs don't link with each other.
        words = [f"{w}{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{'ab'[k // 26]}" if w not in ("na",) else w for w in words]
        other = turned(r, words, how)
        a, b = ([w.encode() for w in lines.normalise(" ".join(t)).decode().split()] for t in (words, other))
        if a != b and lines.edit_similar(a, b):
            rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
            pairs.append((2 * k, 2 * k + 1, n, how))
    assert len(pairs) >= 30
    got = {x.doc_id: x.n_removed for x in lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lost = [p for p in pairs if not got[p[1]]]
    assert not lost, lost


def test_shared_keys_come_once_each_with_one_centre():
    rng = np.random.default_rng(8)
    keys, ids = rng.integers(0, 400, 3000).astype(np.uint64), rng.integers(0, 300, 3000)
    keys[::5] = 7  # one key of many lines
    known, rows = lines.Shared(), []
    for k in range(0, 3000, 250):
        rows += zip(*(c.tolist() for c in known.add(keys[k : k + 250], ids[k : k + 250])), strict=True)
    owners: dict = {}
    for k, i in zip(keys.tolist(), ids.tolist(), strict=True):
        owners.setdefault(k, set()).add(i)
    assert {(i, k) for i, k, _, _ in rows} == {(i, k) for k, own in owners.items() if len(own) > 1 for i in own}
    centres = {(k, c) for _, k, _, c in rows}
    assert len(centres) == len({k for k, _ in centres}) and all(c in owners[k] for k, c in centres)
    assert sum(i == c for i, _, _, c in rows) == len(centres)
    assert len(known.keys) == len(owners)


def test_shared_keys_of_small_blocks(spark):
    rows = [(i, [k for k in range(1, 40) if i % k == 0]) for i in range(1, 300)]
    found = lines.shared_keys(spark.createDataFrame(rows, "id bigint, keys array<bigint>"), parts=5, held=50).collect()
    groups: dict = {}
    for r in found:
        groups.setdefault(r.key, []).append(r.id)
    assert sorted(sorted(g) for g in groups.values()) == sorted([i for i in range(1, 300) if i % k == 0] for k in range(1, 40))


def test_lines_leave_one_table(spark):
    text = "one two three four five six seven\nsome other words stand here now\n"
    docs = spark.createDataFrame([(k, text + f"line {k} " * 4) for k in range(20)], "doc_id long, text string")
    mark = written()
    got = lines.deduplicate(docs).collect()
    assert sum(r.n_removed for r in got) > 30
    assert written() - mark == 1


def edited(r, words, most):
    out = list(words)
    for _ in range(r.randrange(most + 1)):
        k, what = r.randrange(len(out)), r.randrange(3)
        if what == 0:
            out.insert(k, r.choice(words))
        elif what == 1:
            out[k] = "new"
        elif len(out) > lines.MIN_WORDS:
            del out[k]
    return out


def test_filters_lose_no_link():
    r = random.Random(77)
    linked = 0
    for k in range(400):
        n = r.choice([5, 9, 10, 14, 30, 79, 80, 100, 254, 300])
        vocabulary = r.choice([6, 400, 100_000])
        both = [line(r, n, vocabulary)]
        both.append(edited(r, both[0], n // 5))
        raw = [lines.normalise(" ".join(t)) for t in both]
        if raw[0] == raw[1] or not lines.edit_similar(*(t.split() for t in raw)):
            continue
        linked += 1
        _, _, count, _, words = lines.parted([t.decode() for t in raw])
        _, odd, _, keys, many, places, wide = lines.sketched(count, words, lines._NONE, np.ones(2, bool))
        turned = 2 * (int(count.max()) // 5) - abs(int(count[0] - count[1]))
        assert np.bitwise_count((odd[0] ^ odd[1]).view(np.uint64)).sum() <= turned
        if len(wide) == 2:
            assert np.bitwise_count((wide[0] ^ wide[1]).view(np.uint64)).sum() <= turned
        at = [dict(zip(part.tolist(), lines._at(c, p), strict=True)) for part, p, c in zip(np.split(keys, many[:1]), np.split(places, many[:1]), count, strict=True)]
        shared = [key for key in at[0] if key in at[1]]
        # A line of few distinct pairs may lose them all.
        assert not shared or any(lines.may_meet(np.array([at[0][key]]), np.array([at[1][key]]))[0] for key in shared), (k, n, vocabulary)
    assert linked > 200


def test_few_gives_pairs_of_small_keys_and_rows_of_large_ones():
    rng = np.random.default_rng(9)
    keys, ids = rng.integers(0, 300, 3000).astype(np.uint64), rng.integers(0, 500, 3000)
    at = np.where(ids % 2, 20 << 8 | 3, 20 << 8 | 9).astype(np.int16)  # odd and even ones are too far apart
    few, pairs, rows = lines.Few(8), set(), []
    for k in range(0, 3000, 170):
        a, b, *rest = few.add(keys[k : k + 170], ids[k : k + 170], at[k : k + 170])
        pairs |= set(zip(a.tolist(), b.tolist(), strict=True))
        rows += zip(*(c.tolist() for c in rest), strict=True)
    owners: dict = {}
    for k, i in zip(keys.tolist(), ids.tolist(), strict=True):
        owners.setdefault(k, set()).add(i)
    large = {k for k, own in owners.items() if len(own) > 8}
    assert set(rows) >= {(k, i) for k in large for i in owners[k]} and {k for k, _ in rows} <= set(owners)
    assert pairs >= {(i, j) for k, own in owners.items() if k not in large and k not in {x for x, _ in rows} for i in own for j in own if i > j and i % 2 == j % 2}
    assert all(i > j and i % 2 == j % 2 for i, j in pairs) and len(large) > 50 and len(few.keys) <= 8 * 300


def test_unlike_long_lines_are_not_compared(spark, monkeypatch):
    r = random.Random(5)
    # All have the same rare pair, and most words from a small vocabulary: the bags are unlike, the distinct words are not.
    weights = [[r.random() ** 4 for _ in range(60)] for _ in range(100)]
    texts = [" ".join(["rare", "pair", *r.choices([f"v{chr(97 + k % 26)}{'xyz'[k // 26]}" for k in range(60)], w, k=300)]) for w in weights]
    seen = []

    def counted(pairs, f=lines._verified):
        seen.append(pairs.count())
        return f(pairs)

    monkeypatch.setattr(lines, "_verified", counted)
    got = lines.deduplicate(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert sum(x.n_removed for x in got) == 0
    assert sum(seen) < 100, seen
