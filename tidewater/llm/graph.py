"""Near-duplicate vectors by a flat, robustly pruned proximity graph.

Vectors are dealt out to cluster shards that overlap: each goes to its nearest leaders, drawn from the
shard's own members, and a shard that is still too large is split again. Leaders that are close to each
other count as one, so near copies stay together; a shard of nothing else is cut into pieces at random,
any two of which meet in a task of their own.

In each piece a graph is built by insertion: a new node looks for its place with a greedy search from the
medoid, keeps of what it met the neighbours that no nearer one stands in front of (robust pruning), and
is entered with them in turn. A node's lists of all its shards are united. Then every vector searches its
shards' graphs from their medoids, and goes on from whatever it finds in range until nothing new is in
range; close neighbours that another shard knows are there as well. What is found is verified by the
exact cosine. A pair is counted in the first shard that both are in, so tasks return counts and one link
a node, never pairs of a cluster. An audit compares a bounded sample with brute force; where it finds
too little, all is done again with more overlap.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut
from tidewater.llm.grouping import connected_components

#: Most vectors of a piece, about, and most leaders of a shard.
PIECE, LEADERS = 4096, 1024
#: Leaders that a vector goes to, and the cosine from which two leaders count as one.
OVERLAP, SAME = 4, 0.7
#: Most times that shards are split.
ROUNDS = 8
#: Neighbours that a node keeps, candidates that a search keeps, and the slack of pruning (on squared distances).
DEGREE, BEAM, ALPHA = 24, 24, 1.44
#: How far below the threshold a search still goes on, and how far below it neighbours still are near.
SLACK, NEAR = 0.05, 0.1
#: Nodes inserted at once, and searches that go in step.
BATCH, STEP = 512, 1024
#: Vectors, drawn by hashed id, of which the audit looks for all links, and the share that must have been found.
AUDIT, RECALL = 512, 0.97
log = logging.getLogger(__name__)


class Search:
    """Searches that go in step over one graph: ``x`` unit rows, ``lists`` of neighbours padded with len(x)."""

    def __init__(self, x: np.ndarray, lists: np.ndarray, queries: np.ndarray, starts: np.ndarray):
        self.x, self.lists, self.q, self.n = x, lists, queries, len(x)
        self.seen = np.zeros((len(queries), self.n + 1), bool)
        self.seen[:, self.n] = True
        self.ids = np.full((len(queries), BEAM), self.n)
        self.scores = np.full((len(queries), BEAM), -np.inf, np.float32)
        self.open = np.zeros((len(queries), BEAM), bool)
        self.trail: list[tuple[np.ndarray, np.ndarray]] = []
        self.met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._meet(np.arange(len(queries)), starts)

    def _fresh(self, rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, score) of the nodes that their search meets for the first time, each once."""
        new = ~self.seen[rows, nodes]
        key = np.unique(rows[new] * (self.n + 1) + nodes[new])
        rows, nodes = key // (self.n + 1), key % (self.n + 1)
        self.seen[rows, nodes] = True
        scores = np.einsum("ij,ij->i", self.x[nodes], self.q[rows])
        self.met.append((rows, nodes, scores))
        return rows, nodes, scores

    def _meet(self, rows: np.ndarray, lists: np.ndarray) -> None:
        """Nodes that ``rows`` have come to, each its own list, take their place among the candidates."""
        r, nodes, scores = self._fresh(np.repeat(rows, lists.shape[1]), lists.ravel())
        begin = np.searchsorted(r, rows)
        place = np.arange(len(r)) - np.repeat(begin, np.searchsorted(r, rows, "right") - begin)
        width = int(place.max(initial=-1)) + 1
        if not width:
            return
        ids, value = np.full((len(rows), width), self.n), np.full((len(rows), width), -np.inf, np.float32)
        at = np.searchsorted(rows, r)
        ids[at, place], value[at, place] = nodes, scores
        ids = np.concatenate((self.ids[rows], ids), axis=1)
        value = np.concatenate((self.scores[rows], value), axis=1)
        fresh = np.concatenate((self.open[rows], np.isfinite(value[:, BEAM:])), axis=1)
        best = np.argsort(-value, axis=1, kind="stable")[:, :BEAM]
        self.ids[rows], self.scores[rows], self.open[rows] = (np.take_along_axis(a, best, 1) for a in (ids, value, fresh))

    def descend(self) -> None:
        """Greedy search: each goes on from its best candidate until it has been to all of them."""
        while len(rows := np.flatnonzero(self.open.any(axis=1))):
            best = self.open[rows].argmax(axis=1)  # candidates are in order
            nodes = self.ids[rows, best]
            self.open[rows, best] = False
            self.trail.append((rows, nodes))
            self._meet(rows, self.lists[nodes])

    def visited(self) -> np.ndarray:
        """A row a search: its candidates and the nodes on its way, padded."""
        if not self.trail:
            return self.ids
        rows, nodes = (np.concatenate(c) for c in zip(*self.trail, strict=True))
        order = np.argsort(rows, kind="stable")
        rows, nodes = rows[order], nodes[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        way = np.full((len(self.q), int(place.max()) + 1), self.n)
        way[rows, place] = nodes
        return np.concatenate((self.ids, way), axis=1)

    def expand(self, least: float, offsets: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(search, node) of all nodes met with a score of ``least`` or more, after going on from each of them.

        Here node i leads to ``targets`` from ``offsets[i]`` to ``offsets[i + 1]``.
        """
        out = []
        while self.met:
            rows, nodes, scores = (np.concatenate(c) for c in zip(*self.met, strict=True))
            self.met = []
            near = scores >= least
            rows, nodes = rows[near], nodes[near]
            out.append((rows, nodes))
            for k in range(0, len(rows), 1 << 15):
                i, j = rows[k : k + (1 << 15)], nodes[k : k + (1 << 15)]
                self._fresh(*_leading(i, j, offsets, targets))
        rows, nodes = zip(*out, strict=True)
        return np.concatenate(rows), np.concatenate(nodes)


def _leading(rows: np.ndarray, nodes: np.ndarray, offsets: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row with all targets of its node."""
    counts = offsets[nodes + 1] - offsets[nodes]
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(offsets[nodes], counts)
    return np.repeat(rows, counts), targets[at]


def both_ways(x: np.ndarray, lists: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, targets) of the graph's edges between near nodes, in both directions."""
    a, b = np.repeat(np.arange(len(x)), lists.shape[1]), lists.ravel()
    a, b = a[b < len(x)], b[b < len(x)]
    near = np.einsum("ij,ij->i", x[a], x[b]) >= least
    edges = np.unique(np.concatenate((a[near] * len(x) + b[near], b[near] * len(x) + a[near])))
    return np.searchsorted(edges // len(x), np.arange(len(x) + 1)), edges % len(x)


def pruned(x: np.ndarray, nodes: np.ndarray, pools: np.ndarray) -> np.ndarray:
    """Of each node's pool (padded with len(x)) the neighbours that robust pruning keeps, nearest first, padded."""
    n = len(x)
    out = np.full((len(nodes), DEGREE), n)
    for k in range(0, len(nodes), 256):
        own, pool = nodes[k : k + 256], pools[k : k + 256]
        there = x[np.minimum(pool, n - 1)]
        cosine = np.where((pool < n) & (pool != own[:, None]), np.matmul(there, x[own][:, :, None])[:, :, 0], -np.inf)
        order = np.argsort(-cosine, axis=1, kind="stable")
        pool, cosine = (np.take_along_axis(a, order, 1) for a in (pool, cosine))
        there = np.take_along_axis(there, order[:, :, None], 1)
        alive, rows = np.isfinite(cosine), np.arange(len(own))
        for slot in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[k : k + 256][some, slot] = pool[rows, pick][some]
            between = np.matmul(there, there[rows, pick][:, :, None])[:, :, 0]
            alive &= (ALPHA * (1 - between) > 1 - cosine) & (pool != pool[rows, pick][:, None])
    return out


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax()) if len(x) else 0


def build(x: np.ndarray) -> np.ndarray:
    """The pruned graph over unit rows ``x``: lists of neighbours, padded with len(x); all can be reached from the medoid."""
    n, first = len(x), medoid(x)
    lists = np.full((n, DEGREE), n)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([first], order[order != first]))
    done = 1
    while done < n:
        new = order[done : done + min(done, BATCH)]
        search = Search(x, lists, x[new], np.full((len(new), 1), first))
        search.descend()
        # Nodes inserted together don't meet in the graph yet.
        together = x[new] @ x[new].T
        beside = new[np.argpartition(-together, min(8, len(new) - 1), axis=1)[:, :9]]
        lists[new] = pruned(x, new, np.concatenate((search.visited(), beside), axis=1))
        to, back = lists[new].ravel(), np.repeat(new, DEGREE)
        to, back = to[to < n], back[lists[new].ravel() < n]
        nearness = np.einsum("ij,ij->i", x[to], x[back])
        o = np.lexsort((-nearness, to))
        to, back = to[o], back[o]
        place = np.arange(len(to)) - np.searchsorted(to, to)
        keep = place < 4 * DEGREE
        targets = np.unique(to)
        more = np.full((len(targets), int(place[keep].max(initial=0)) + 1), n)
        more[np.searchsorted(targets, to[keep]), place[keep]] = back[keep]
        pools = np.concatenate((lists[targets], more), axis=1)
        small = (pools < n).sum(axis=1) <= DEGREE
        lists[targets[small]] = np.sort(pools[small], axis=1)[:, :DEGREE]
        if not small.all():
            lists[targets[~small]] = pruned(x, targets[~small], pools[~small])
        done += len(new)
    reached, front = np.zeros(n + 1, bool), np.array([first])
    reached[[first, n]] = True
    while len(front):
        front = np.unique(lists[front])
        front = front[~reached[front]]
        reached[front] = True
    lost = np.flatnonzero(~reached[:n])
    if len(lost):
        known = np.flatnonzero(reached[:n])
        parents = np.concatenate([known[(x[lost[k : k + 256]] @ x[known].T).argmax(axis=1)] for k in range(0, len(lost), 256)])
        o = np.argsort(parents, kind="stable")
        parents, lost = parents[o], lost[o]
        place = np.arange(len(parents)) - np.searchsorted(parents, parents)
        more = np.full((n, int(place.max()) + 1), n)
        more[parents, place] = lost
        lists = np.concatenate((lists, more), axis=1)
    return lists


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, initial=1e-300)[:, None]
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; large and tiny components don't overflow."""
    x, y = (a / np.abs(a).max(axis=1)[:, None] for a in (x, y))
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def _separate(part: pa.Table) -> pa.Table:
    """Of a shard's drawn vectors those that are not close to one before them."""
    part = part.sort_by("id")
    x = _unit(_matrix(part["v"], part.num_rows))
    kept: list[int] = []
    for i in range(len(x)):
        if not kept or (x[kept] @ x[i]).max() < SAME:
            kept.append(i)
    return part.take(kept).select(["cell", "v"])


def _assign(overlap: int, margin: float):
    def run(leaders: pa.Table, rows: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.select(["cell", "id", "v"])
        x = _unit(_matrix(rows["v"], rows.num_rows))
        c = _unit(_matrix(leaders["v"], leaders.num_rows)) if leaders.num_rows else np.empty((0, x.shape[1]), np.float32)
        if len(c) < 2:  # nothing but near copies: from now on cut at random
            cells = pa.array([f"{rows['cell'][0].as_py()}!"] * rows.num_rows, pa.string())
            return pa.table({"cell": cells, "id": rows["id"].combine_chunks(), "v": rows["v"].combine_chunks()})
        angle = np.arccos(np.clip(x @ c.T, -1, 1))
        order = np.argsort(angle, axis=1, kind="stable")[:, :overlap]
        near = np.take_along_axis(angle, order, 1)
        i, j = np.nonzero(near <= near[:, :1] + margin)
        name = rows["cell"][0].as_py()
        cells = pa.array([f"{name}.{k}" for k in order[i, j].tolist()], pa.string())
        return pa.table({"cell": cells, "id": rows["id"].combine_chunks().take(i), "v": rows["v"].combine_chunks().take(i)})

    return run


def _shards(nodes: DataFrame, threshold: float, overlap: int) -> DataFrame:
    """(cell, id, v): overlapping shards. Those marked ``!`` hold near copies only and may be of any size, as may what is left after ROUNDS."""
    margin = 2 * float(np.arccos(threshold))  # farther away, no vector in range can have its nearest leader
    kind = nodes.schema["v"].dataType.simpleString()
    cells = cut(nodes.select(F.size("v").cast("string").alias("cell"), "id", "v"))
    whole: list[DataFrame] = []
    for _ in range(ROUNDS):
        sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
        large = cut(sizes.where((F.col("n") > PIECE) & ~F.endswith("cell", F.lit("!"))))
        if large.isEmpty():
            break
        wanted = F.least(F.lit(LEADERS), F.ceil(2 * overlap * F.col("n") / PIECE) + 2)
        drawn = F.pmod(F.xxhash64("id", "cell"), F.lit(1 << 30)) < F.lit(1 << 30) * wanted / F.col("n")
        split = cells.join(large, "cell")
        leaders = cut(split.where(drawn).select("cell", "id", "v").groupBy("cell").applyInArrow(_separate, f"cell string, v {kind}"))
        tasks = F.ceil(F.col("n") / PIECE).cast("int")
        mine = leaders.join(large, "cell").withColumn("_task", F.explode(F.sequence(F.lit(0), tasks - 1))).select("cell", "_task", "v")
        theirs = split.withColumn("_task", F.pmod(F.xxhash64("id"), tasks).cast("int")).select("cell", "_task", "id", "v")
        fresh = mine.groupBy("cell", "_task").cogroup(theirs.groupBy("cell", "_task")).applyInArrow(_assign(overlap, margin), f"cell string, id bigint, v {kind}")
        whole.append(cells.join(large, "cell", "left_anti").select("cell", "id", "v"))
        cells = cut(fresh)
    for other in whole:
        cells = cells.unionByName(other)
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    return cells.join(sizes, "cell").withColumn("piece", F.pmod(F.xxhash64("id", F.lit(1)), F.col("pieces")).cast("int"))


def _build(threshold: float):
    """A grouped function that builds a piece's graph: each node's neighbours, and those of them that are near."""

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        x, ids = _unit(_matrix(part["v"], part.num_rows)), part["id"].to_numpy()
        there = [row[row < len(x)] for row in build(x)]
        near = [row[(x[row] @ v) >= threshold - NEAR] for row, v in zip(there, x, strict=True)]
        kind = pa.list_(pa.int64())
        return pa.table({"id": pa.array(ids), "lists": pa.array([ids[r] for r in there], kind), "near": pa.array([ids[r] for r in near], kind)})

    return run


def _padded(groups: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(groups), max(map(len, groups), default=0) or 1), fill)
    for row, values in zip(out, groups, strict=True):
        row[: len(values)] = values
    return out


_FOUND = "a bigint, b bigint, n bigint, root bigint"


def _lookup(threshold: float):
    """A grouped function over a tile: the searches of one piece in the graph of another, or its own.

    It returns (a, null, n, root), the number of links of a that are counted here with a node they join it
    to, and (a, b, null, null) for a link of two nodes that no shard holds both of.
    """
    kind = pa.schema([(c, pa.int64()) for c in ("a", "b", "n", "root")])

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("role", "ascending"), ("id", "ascending")])  # 0: nodes of the piece, 1: close ones from elsewhere, 2: searches
        role, ids, weight = (part[c].to_numpy() for c in ("role", "id", "copies"))
        vectors = _matrix(part["v"], part.num_rows)
        cell, same = part["cell"][0].as_py(), part["i"][0].as_py() == part["j"][0].as_py()
        n, members = int((role < 2).sum()), int((role == 0).sum())
        asks = np.arange(members) if same else np.flatnonzero(role == 2)
        if not members or not len(asks):
            return kind.empty_table()
        x = _unit(vectors)
        place = pd.Series(np.arange(n), index=ids[:n])
        lists = part["lists"].combine_chunks()[:n]
        to = place.reindex(lists.flatten().to_numpy(zero_copy_only=False)).fillna(n).to_numpy().astype(int)
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        width = max(1, int(counts.max(initial=1)))
        known = np.full((n, width), n)
        known[np.repeat(np.arange(n), counts), np.arange(len(to)) - np.repeat(np.cumsum(counts) - counts, counts)] = to
        first, near = medoid(x[:members]), both_ways(x[:n], known, threshold - NEAR)
        pairs = [[np.empty(0, int)], [np.empty(0, int)]]
        for k in range(0, len(asks), STEP):
            own = asks[k : k + STEP]
            starts = np.column_stack((np.full(len(own), first), own)) if same else np.full((len(own), 1), first)
            search = Search(x[:n], known, x[own], starts)
            search.descend()
            rows, nodes = search.expand(threshold - SLACK, *near)
            rows = own[rows]
            other = ids[rows] != ids[nodes]
            rows, nodes = rows[other], nodes[other]
            true = cosines(vectors[rows], vectors[nodes]) >= threshold
            pairs[0].append(rows[true])
            pairs[1].append(nodes[true])
        a, b = (np.concatenate(c) for c in pairs)
        # A pair is counted in the first shard of both; homes before this one are numbered from 1.
        homes = part["homes"].to_pylist()
        names = {h: k + 1 for k, h in enumerate(sorted({h for own in homes for h in own}))}
        mine = names[cell]
        codes = _padded([np.array([names[h] for h in own]) for own in homes], 0)
        common = lambda a, b, below: ((codes[a][:, :, None] == codes[b][:, None, :]) & (codes[a] > 0)[:, :, None] & (codes[a] < below)[:, :, None]).any(axis=(1, 2))
        outside = (b >= members) & (b < n)
        loose = np.flatnonzero(outside)
        loose = loose[~common(a[loose], b[loose], len(names) + 1)]
        inside = np.flatnonzero(~outside)
        inside = np.concatenate([np.empty(0, int), *(p[~common(a[p], b[p], mine)] for k in range(0, len(inside), 1 << 18) if len(p := inside[k : k + (1 << 18)]))])
        low, high = np.minimum(a[inside], b[inside]), np.maximum(a[inside], b[inside])
        once = np.unique(low * len(ids) + high)
        low, high = once // len(ids), once % len(ids)
        links = np.bincount(low, weight[high], len(ids)) + np.bincount(high, weight[low], len(ids))
        root = ids.copy()
        while True:
            least = np.minimum(root[low], root[high])
            before = root.copy()
            np.minimum.at(root, low, least)
            np.minimum.at(root, high, least)
            if (root == before).all():
                break
        some = np.flatnonzero(links)
        none = [None] * max(len(some), len(loose))
        return pa.table(
            {
                "a": pa.array([*ids[some].tolist(), *ids[a[loose]].tolist()], pa.int64()), "b": pa.array([*none[: len(some)], *ids[b[loose]].tolist()], pa.int64()),
                "n": pa.array([*links[some].astype(int).tolist(), *none[: len(loose)]], pa.int64()), "root": pa.array([*root[some].tolist(), *none[: len(loose)]], pa.int64()),
            }
        )

    return run


def _found(nodes: DataFrame, threshold: float, overlap: int) -> DataFrame:
    """(a, b, n, root) of all tiles, as ``_lookup`` gives it, written."""
    shards = cut(_shards(nodes, threshold, overlap))
    graph = cut(shards.groupBy("cell", "piece").applyInArrow(_build(threshold), "id bigint, lists array<bigint>, near array<bigint>"))
    united = graph.groupBy("id").agg(*(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("lists", "near")))
    homes = shards.groupBy("id").agg(F.array_sort(F.collect_list("cell")).alias("homes"))
    known = cut(nodes.join(united, "id").join(homes, "id"))
    places = shards.select("cell", "piece", "pieces", "id")
    close = places.join(known.select("id", F.explode("near").alias("to")), "id").select("cell", "piece", "pieces", F.col("to").alias("id")).distinct()
    close = close.join(places.select("cell", "id"), ["cell", "id"], "left_anti").select(*places.columns, F.lit(1).alias("role"))
    rows = places.withColumn("role", F.lit(0)).union(close)
    # The graph of piece j meets the searches of all pieces up to it.
    graphs = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("piece")))).withColumn("j", F.col("piece"))
    asking = places.where("piece < pieces - 1").withColumn("role", F.lit(2))
    asking = asking.withColumn("j", F.explode(F.sequence(F.col("piece") + 1, F.col("pieces") - 1))).withColumn("i", F.col("piece"))
    columns = ["cell", "i", "j", "id", "role"]
    tiles = graphs.select(*columns).union(asking.select(*columns)).join(known.select("id", "v", "copies", "lists", "homes"), "id")
    return cut(tiles.groupBy("cell", "i", "j").applyInArrow(_lookup(threshold), _FOUND))


def _recall(nodes: DataFrame, counts: DataFrame, threshold: float) -> float:
    """The share of the links of a bounded sample, by brute force, that ``counts`` (id, n) has; 1 if there are none."""
    total = nodes.count()
    share = min(1.0, AUDIT / max(1, total))
    sample = nodes.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < F.lit(1 << 30) * share).join(counts, "id", "left").select("id", "v", F.coalesce("n", F.lit(0)).alias("n")).collect()
    asked: dict[int, list] = {}
    for r in sample:
        asked.setdefault(len(r.v), []).append(r)
    shared = nodes.sparkSession.sparkContext.broadcast({d: (np.array([r.id for r in rs]), np.array([r.v for r in rs], float)) for d, rs in asked.items()})

    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["v"].map(len)):
                if dim in shared.value:
                    names, wanted = shared.value[dim]
                    x = np.stack(part["v"].to_numpy()).astype(float)
                    i, j = np.nonzero(_unit(x) @ _unit(wanted).T >= threshold - 1e-4)
                    true = (cosines(x[i], wanted[j]) >= threshold) & (part["id"].to_numpy()[i] != names[j])
                    yield pd.DataFrame({"id": names[j][true], "n": part["copies"].to_numpy()[i][true]})

    true = dict(nodes.select("id", "v", "copies").mapInPandas(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n")).collect())
    wanted = sum(true.values())
    return sum(min(r.n, true.get(r.id, 0)) for r in sample) / wanted if wanted else 1.0


def links(vectors: DataFrame, threshold: float = 0.9, overlap: int = OVERLAP) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row an id of ``vectors`` (vec_id, embedding).

    Two rows are linked if the cosine of their vectors, in double precision, is at least ``threshold``;
    ``n_links`` counts a row's other linked rows, ``component_id`` is the smallest id it reaches and
    ``kept`` says whether that is its own. Only vectors of equal length can be linked; those that are
    null, empty, zero or hold null or non-finite components are linked with nothing. Of rows that repeat
    a vec_id the smallest usable vector counts; rows with a null vec_id count for themselves, are
    linked with nothing and are kept. Other columns are ignored.

    Equal vectors are one node of the graph with their number. All links found are true; that all are
    found isn't certain, see RECALL.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    useful = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & useful).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v"))
    rows = cut(rows.groupBy("vec_id").agg(F.min("v").alias("v")))
    nodes = cut(rows.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    if nodes.isEmpty():
        counts, comps = spark.createDataFrame([], "id bigint, n bigint"), spark.createDataFrame([], "node bigint, comp bigint")
    else:
        for _ in range(3):
            found = _found(nodes, threshold, overlap)
            loose = found.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            both = loose.union(loose.select("b", "a")).toDF("id", "to").join(nodes.select(F.col("id").alias("to"), "copies"), "to")
            counts = found.where("b IS NULL").select(F.col("a").alias("id"), "n").union(both.select("id", F.col("copies").alias("n")))
            counts = cut(counts.groupBy("id").agg(F.sum("n").alias("n")))
            share = _recall(nodes, counts, threshold)
            log.info("overlap %d: %.4f of the audited links found", overlap, share)
            if share >= RECALL:
                break
            overlap *= 2
        comps = connected_components(found.where("b IS NULL").select("a", F.col("root").alias("b")).union(loose))
    nodes = nodes.join(counts, "id", "left").join(comps.withColumnRenamed("node", "id"), "id", "left")
    nodes = nodes.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("comp", "id").alias("component_id"))
    known = rows.join(nodes, "v").select("vec_id", "n_links", "component_id")
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    out = every.where("vec_id IS NOT NULL").distinct().join(known, "vec_id", "left").union(every.where("vec_id IS NULL").selectExpr("vec_id", "0L", "null"))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
