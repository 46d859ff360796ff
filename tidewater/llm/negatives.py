"""Hard negatives by exact integer products, several candidates to a multiplication.

Components become integers. The same component of up to ``FIELDS`` candidates, biased so that none is
negative, lies in separated fields of one wide integer, so one multiplication by an anchor's component
serves all of them, and the sum over components holds every candidate's product in its own field. A
field has room for the largest sum of its tile, so nothing carries over; taking the biases off again
gives exact scores.

Anchors and rows meet in tiles of bounded size, each a task of its own: rows are dealt out in parts and
anchors in blocks by hash. The first pass meets rows of an anchor's label only and finds its positives,
the second looks for the rows of other labels in the band below each positive. A tile returns the first
few of each anchor, never its scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidewater.llm.common import cut

#: Candidates whose components share one wide integer.
FIELDS = 1024
#: Rows and anchors of a tile, about.
ROWS, ANCHORS = 4096, 256
#: Squared length of a scaled vector from which its scores might not fit a long.
LIMIT = 2.0**62


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v): scaled integer vectors of the commonest length, one row an id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select("vec_id", "label", whole.alias("v"))
    rows = rows.where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) < LIMIT)
    if not rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common.n if common else 0))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


class Packed:
    """Candidates' vectors as wide integers, one a component and ``FIELDS`` candidates."""

    def __init__(self, vectors: np.ndarray, anchors: np.ndarray):
        self.rows, self.dim = vectors.shape
        self.bias, self.other = (-int(x.min(initial=0)) for x in (vectors, anchors))
        top = self.dim * (int(vectors.max(initial=0)) + self.bias) * (int(anchors.max(initial=0)) + self.other)
        self.width = next(w for w in (4, 8, 16) if top < 1 << 8 * w)
        biased = (vectors + self.bias).astype(np.uint64)
        self.sums = biased.sum(axis=1, dtype=np.uint64)
        self.packs = [[self._pack(column) for column in biased[k : k + FIELDS].T] for k in range(0, self.rows, FIELDS)]

    def _pack(self, values: np.ndarray) -> int:
        if self.width == 16:
            values = np.column_stack((values, np.zeros_like(values)))
        return int.from_bytes(values.astype("<u4" if self.width == 4 else "<u8").tobytes(), "little")

    def _unpack(self, total: int, count: int) -> np.ndarray:
        """The fields modulo 2**64; scores are smaller than that."""
        fields = np.frombuffer(total.to_bytes(count * self.width, "little"), "<u4" if self.width == 4 else "<u8")
        return fields.reshape(count, -1)[:, 0].astype(np.uint64)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The exact product of every candidate with ``anchor``."""
        factors = [int(x) + self.other for x in anchor]
        fields = [np.empty(0, np.uint64)]
        for k, pack in enumerate(self.packs):
            fields.append(self._unpack(sum(map(int.__mul__, pack, factors)), min(FIELDS, self.rows - k * FIELDS)))
        whole = 1 << 64
        rest = (self.dim * self.bias * self.other - self.bias * sum(factors)) % whole
        return (np.concatenate(fields) - self.sums * np.uint64(self.other % whole) + np.uint64(rest)).view(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ``rows`` (places) with the highest scores, ties to smaller ids."""
    if len(rows) > k:
        least = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
        rows = rows[scores[rows] >= least]
    return rows[np.lexsort((ids[rows], -scores[rows]))[:k]]


def _tiles(rows: DataFrame, anchors: DataFrame, by: list[str], search, schema: str) -> DataFrame:
    """``search(anchors, rows)`` over all tiles; with ``by``, of those that agree in these columns."""
    parts, blocks = max(1, -(-rows.count() // ROWS)), max(1, -(-anchors.count() // ANCHORS))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    theirs = rows.withColumn("_part", dealt(parts)).withColumn("_block", every(blocks))
    mine = anchors.withColumn("_block", dealt(blocks)).withColumn("_part", every(parts))
    keys = ["_part", "_block", *by]
    return mine.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInArrow(search, schema)


def _table(columns: list[list], target: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(columns, target, strict=True)], schema=target)


def _like_search(k: int, schema: str):
    target = to_arrow_schema(StructType.fromDDL(schema))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if mine.num_rows and theirs.num_rows:
            anchors = _matrix(mine["v"], mine.num_rows)
            packed, ids = Packed(_matrix(theirs["v"], theirs.num_rows), anchors), theirs["vec_id"].to_numpy()
            for name, anchor in zip(mine["vec_id"].to_numpy(), anchors, strict=True):
                scores = packed.scores(anchor)
                best = _first(scores, ids, np.flatnonzero(ids != name), k)
                for column, values in zip(out, (np.full(len(best), name), ids[best], scores[best]), strict=True):
                    column.append(values)
        return _table(out, target)

    return search


def _unlike_search(k: int, low: int, high: int, schema: str):
    target = to_arrow_schema(StructType.fromDDL(schema))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if mine.num_rows and theirs.num_rows:
            anchors = _matrix(mine["v"], mine.num_rows)
            packed, ids = Packed(_matrix(theirs["v"], theirs.num_rows), anchors), theirs["vec_id"].to_numpy()
            labels, own = theirs["label"].to_numpy(), mine["label"].to_numpy()
            names, liked = mine["vec_id"].to_numpy(), mine["positives"].to_pylist()
            for name, label, positives, anchor in zip(names, own, liked, anchors, strict=True):
                scores = packed.scores(anchor)
                other = labels != label
                for p in positives:
                    # low * p <= 100 * score <= high * p, in whole numbers
                    least, most = -(-low * p["score"] // 100), high * p["score"] // 100
                    if least > most:
                        continue
                    best = _first(scores, ids, np.flatnonzero(other & (scores >= least) & (scores <= most)), k)
                    ones = np.ones(len(best), np.int64)
                    for column, values in zip(out, (np.full(len(best), name), np.full(len(best), p["vec_id"]), ids[best], p["score"] * ones, scores[best]), strict=True):
                        column.append(values)
        return _table(out, target)

    return search


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor and positive.

    ``anchor`` is a condition that marks anchors among ``vectors`` (vec_id, embedding, label). A
    component x becomes floor(scale * x), a score is the integer inner product, ties go to the smaller
    vec_id. An anchor's positives are its ``positives`` best other rows of its label (all, if fewer), and
    each one's negatives the ``negatives`` best rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score; a positive without any has no row, as has one with a
    negative score.

    Rows take no part that have a null id, label or vector or a null or non-finite component, another
    than the commonest length (of equally common ones the shortest), or a scaled squared length of 2**62
    or more, whose scores might not fit a long. Of rows that repeat a vec_id, the one with the smallest
    label, then vector, counts. Other columns are ignored; an empty table gives no rows.
    """
    rows = cut(_usable(vectors, scale))
    kinds = {c: t for c, t in rows.dtypes}
    anchors = rows.where(anchor)
    found = "vec_id {0}, positive_id {0}, score bigint".format(kinds["vec_id"])
    like = _tiles(rows, anchors, ["label"], _like_search(positives, found), found)
    best = Window.partitionBy("vec_id").orderBy(F.desc("score"), "positive_id")
    like = like.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    like = like.groupBy("vec_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("vec_id"), "score")).alias("positives"))
    asking = cut(anchors.join(like, "vec_id"))
    found = "anchor_id {0}, positive_id {0}, negative_id {0}, positive_score bigint, negative_score bigint".format(kinds["vec_id"])
    unlike = _tiles(rows, asking, [], _unlike_search(negatives, low, high, found), found)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    unlike = unlike.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return unlike.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
