"""Members of keys of many lines: pairs that may be linked, once each, and no others."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import lines


def _rows(texts):
    """Rows of each key of each text as ``pairs_within`` takes them, the texts' numbers as ids, by key."""
    _, _, count, _, words = lines.parted(texts)
    sims, odd, rich, keys, many, places, wide = lines.sketched(count, words, lines._NONE, np.ones(len(count), bool))
    owner = np.repeat(np.arange(len(count)), many)
    own = np.zeros((len(count), lines.WIDE), np.int64)
    own[count >= lines.LONG] = wide
    x = {"id": owner, "comp": owner, "block": owner % 2, "alone": np.ones(len(owner), bool), "n": count[owner], "d": rich[owner], "at": lines._at(count[owner], places)}
    x |= {"s": sims[owner][:, None], "odd": odd[owner], "wide": own[owner], "previous": np.full(len(owner), lines.NO_KEY)}
    order = np.argsort(keys, kind="stable")
    return keys[order], {name: v[order] for name, v in x.items()}


def test_pairs_of_a_key_are_those_of_each_two_rows():
    r = random.Random(3)
    seeds = [[f"w{r.randrange(300)}x" for _ in range(n)] for n in (5, 6, 9, 30, 90, 260)]
    texts = []
    for k in range(240):
        words = list(r.choice(seeds))
        for _ in range(r.randrange(len(words) // 5 + 2)):
            words[r.randrange(len(words))] = f"e{k}"
        texts.append(" ".join((words + [f"t{k}"]) if k % 3 else words))
    texts = list(dict.fromkeys(texts))
    keys, x = _rows(texts)
    group = np.cumsum(np.append(True, keys[1:] != keys[:-1]))
    got = set(zip(*(c.tolist() for c in lines.pairs_within(group, x)), strict=True))
    a, b = (v.ravel() for v in np.indices((len(keys), len(keys))))
    both = (keys[a] == keys[b]) & (x["id"][a] < x["id"][b])
    a, b = a[both], b[both]
    a, b = (v[lines.may_meet(x["at"][a], x["at"][b])] for v in (a, b))
    good = lines.sift(x, a, b)
    assert got == set(zip(x["id"][a[good]].tolist(), x["id"][b[good]].tolist(), strict=True)) and len(got) > 500
    linked = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if lines.edit_similar(*(lines.normalise(texts[k]).split() for k in (i, j)))}
    assert got >= linked and len(linked) > 100
    # Of two blocks only rows of both, of one group none.
    apart = set(zip(*(c.tolist() for c in lines.pairs_within(group, x | {"alone": np.zeros(len(keys), bool)})), strict=True))
    assert apart == {(i, j) for i, j in got if i % 2 != j % 2}
    assert not len(lines.pairs_within(group, x | {"comp": np.zeros(len(keys), np.int64)})[0])


def test_sift_keeps_what_likely_keeps(spark, monkeypatch):
    """The join's condition and the arrays' agree."""
    r = random.Random(4)
    seed = [f"w{r.randrange(60)}x" for _ in range(100)]
    texts = [" ".join(f"u{k}" if r.random() < k / 200 else w for w in seed[: 60 + k % 41]) for k in range(60)]
    seen = {}

    def kept(nodes, shared, likely, *rest):
        rows = nodes.orderBy("id").collect()
        left, right = (nodes.select(*(F.col(c).alias(f"{p}_{c}") for c in nodes.columns)) for p in "lr")
        seen["join"] = {(p.l_id, p.r_id) for p in left.join(right, (F.col("l_id") < F.col("r_id")) & likely("l_", "r_")).collect()}
        x = {"n": np.array([p.n for p in rows]), "d": np.array([p.d for p in rows]), "s": np.array([[p.s] for p in rows]), "odd": np.array([[p[o] for o in lines._ODD] for p in rows])}
        x["wide"] = np.array([p.wide or [0] * lines.WIDE for p in rows])
        a, b = np.triu_indices(len(rows), 1)
        good = lines.sift(x, a, b)
        seen["arrays"] = {(rows[i].id, rows[j].id) for i, j in zip(a[good].tolist(), b[good].tolist(), strict=True)}
        return spark.createDataFrame([], "node long, comp long")

    monkeypatch.setattr(lines, "link_groups", kept)
    lines.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert seen["join"] == seen["arrays"] and 50 < len(seen["join"]) < 1700


def test_a_shared_stretch_pairs_lines_once(spark, monkeypatch):
    """Lines that have many keys of many lines in common are one pair and not one for each key; a row tells the line's key before and where."""
    r = random.Random(6)
    stretch = [f"s{chr(97 + k)}z" for k in range(12)]
    # A common stretch at one place, all else of each line its own: no two are linked.
    texts = [" ".join([*("".join(r.choices("bcdef", k=12)) for _ in range(3)), *stretch]) for k in range(60)]
    keyed = lines.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = lines.with_previous(lines.shared_keys(keyed.select("id", "keys", "n", "places"), few=lines.FEW).where("key is not null"))
    found = rows.collect()
    per_line = {}
    for row in found:
        per_line.setdefault(row.id, []).append((row["at"] & 255, row.key, row.previous))
    assert len(per_line) == 60 and len(found) > 120
    for own in per_line.values():
        own.sort(key=lambda row: row[0])
        assert own[0][2] is None and all(b == j * 256 + q - p for (p, j, _), (q, _, b) in zip(own, own[1:], strict=False))
    made = []

    def counted(x, a, b, f=lines.sift):
        made.append(len(a))
        return np.arange(len(a))

    monkeypatch.setattr(lines, "sift", counted)
    codes = {k: n for n, k in enumerate(sorted({row.key for row in found}))}
    order = sorted(range(len(found)), key=lambda k: codes[found[k].key])
    column = lambda f, kind=np.int64: np.array([f(found[k]) for k in order], kind)
    ids = column(lambda row: row.id)
    x = {"id": ids, "comp": ids, "block": 0 * ids, "alone": ids == ids, "n": 15 + 0 * ids, "d": ids, "at": column(lambda row: row["at"], np.int16)}
    x |= {"previous": column(lambda row: lines.NO_KEY if row.previous is None else row.previous)}
    a, _ = lines.pairs_within(column(lambda row: codes[row.key]), x)
    assert len(a) == sum(made) == 60 * 59 // 2
