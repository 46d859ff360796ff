"""Near-duplicate documents by SuperMinHash.

Every 5-word shingle draws, for each rank 0, 1, 2, ..., a register of its own permutation of the
registers and a fraction; a register keeps the smallest rank plus fraction that it meets. Ranks are
correlated over the registers (each shingle takes every rank once), which lowers the variance below
plain MinHash; and once all registers of a document hold something below rank j, rank j and those
after it can't change the signature, so long documents stop after a rank or two. All shingles of a
document advance together, rank by rank, which numpy does at once; minima don't depend on order.

Bands of the signature give buckets, two bits of each register a cheap estimate, full shingle
sets the confirmation, and star rounds the groups (``grouping``).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, first_rows, map_batches, one_per_id, text_dictionary, zipped, zipper
from tidewater.llm.grouping import link_groups, shared_buckets
from tidewater.llm.words import mix, shingles, signed, word_hashes

SHINGLE = 5
REGISTERS = 512
BANDS, ROWS = 20, 4
#: Links hold 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Estimates below the threshold less so many standard deviations aren't confirmed.
DEVIATIONS = 4.5
_LANES = REGISTERS // 32


#: Shingles that advance together, and ranks up to which their swaps are followed back; from then on permutations are held.
TOGETHER, SWAPS = 1 << 14, 16


def signatures(items: np.ndarray, count: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """For each document of ``count`` distinct 64-bit items the registers' minima, a row each; rank in the upper bits, fraction in the lower 48."""
    low = np.full((len(count), registers), np.uint64(1) << np.uint64(63), np.uint64)
    owner = np.repeat(np.arange(len(count)), count)
    for begin in range(0, len(items), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        _lower(low, items[part], owner[part])
    return low


def _lower(low: np.ndarray, items: np.ndarray, owner: np.ndarray) -> None:
    """Lower the registers of the items' documents, rank by rank, until no document has one that a later rank could reach."""
    registers = low.shape[1]
    fraction = np.uint64((1 << 48) - 1)
    moved: list[tuple[np.ndarray, np.ndarray]] = []
    order = None
    for rank in range(registers):
        if rank < SWAPS or rank % 8 == 0:
            first, last = owner[0], owner[-1] + 1
            going = ((low[first:last].max(axis=1) >> np.uint64(48)) >= rank)[owner - first]
            left = int(going.sum())
            if not left:
                return
            if left < 0.75 * len(items):
                items, owner = items[going], owner[going]
                moved = [(chosen[going], value[going]) for chosen, value in moved]
                order = None if order is None else order[going]
        draw = mix(items + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64))
        at = (rank + ((draw >> np.uint64(48)) * np.uint64(registers - rank) >> np.uint64(16))).astype(np.uint16)
        if rank < SWAPS:
            here, mine = at.copy(), np.full(len(items), rank, np.uint16)
            for chosen, value in moved:
                np.copyto(here, value, where=at == chosen)
                np.copyto(mine, value, where=chosen == rank)
            moved.append((at, mine))
        else:
            rows = np.arange(len(items))
            if order is None:
                order = np.tile(np.arange(registers, dtype=np.uint16), (len(items), 1))
                for chosen, value in moved:
                    order[rows, chosen] = value
                moved = []
            here = order[rows, at]
            order[rows, at] = order[:, rank]
        np.minimum.at(low.reshape(-1), owner * registers + here, (draw & fraction) | np.uint64(rank << 48))


def signature(items: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The registers' minima over one document's items."""
    return signatures(items, np.array([len(items)]), registers)[0]


def packed(sigs: np.ndarray) -> np.ndarray:
    """Two bits of each register, 32 registers a long; a row each."""
    two = (mix(sigs) & np.uint64(3)).reshape(len(sigs), _LANES, 32)
    return (two << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64)


def bands(sigs: np.ndarray) -> np.ndarray:
    """A hash for each band of registers; a row each."""
    rows = sigs[:, : BANDS * ROWS].reshape(len(sigs), BANDS, ROWS)
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sigs), 1))
    for j in range(ROWS):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + rows[:, :, j])
    return out


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingles(word_hashes(text, lower=True), SHINGLE))


def _sums(items: np.ndarray) -> tuple[int, int]:
    """Two sums that identify a set."""
    both = np.array([items.sum(dtype=np.uint64), mix(items + np.uint64(1)).sum(dtype=np.uint64)])
    return tuple(signed(both).tolist())


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, bands, sig): two sums identify a shingle set."""

    def start():
        def step(ids, texts):
            sets = [shingle_set(t) for t in texts]
            n = np.array([len(s) for s in sets])
            sums = [_sums(s) if len(s) else (0, 0) for s in sets]
            # Sets of like sizes end at like ranks, so they go side by side.
            filled = np.flatnonzero(n)
            filled = filled[np.argsort(n[filled], kind="stable")]
            keys, two = [None] * len(sets), [None] * len(sets)
            if len(filled):
                sigs = signatures(np.concatenate([sets[k] for k in filled]), n[filled])
                for k, x, y in zip(filled, signed(bands(sigs)), signed(packed(sigs)), strict=True):
                    keys[k], two[k] = x, y
            return ids, n, *zip(*sums, strict=True), keys, two

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>, sig array<bigint>", start)


def _sets(texts: DataFrame, dictionary: bytes) -> DataFrame:
    """(id, payload): full shingle sets of compressed texts."""

    def start():
        unpack = zipper(dictionary)[1]
        return lambda ids, zs: (ids, [signed(shingle_set(unpack(z).decode("utf-8", "surrogatepass"))) for z in zs])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, ["doc_id", "z"], f"id {kind}, payload array<bigint>", start)


def _estimate(left: str, right: str) -> Column:
    """Registers that differ in their two bits."""
    differ = []
    for k in range(_LANES):
        x = F.col(f"{left}s{k}").bitwiseXOR(F.col(f"{right}s{k}"))
        differ.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))))
    return reduce(lambda a, b: a + b, differ)


def _cutoff(percent: int) -> int:
    """Most registers that may differ. A register of unlike minima still agrees once in four."""
    p = percent / 100 + (1 - percent / 100) / 4
    return int(np.ceil(REGISTERS * (1 - p) + DEVIATIONS * np.sqrt(REGISTERS * p * (1 - p))))


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): near-duplicate groups of whole texts.

    Words are runs other than ASCII white space, A-Z lower-cased; a text's set holds its distinct
    5-word shingles, or its whole sequence where it has fewer words. Documents are linked where
    ``100 * intersection >= percent * union`` on full sets (64-bit shingle hashes);
    component_id is the smallest doc_id reachable; kept marks the document that has it. Texts
    without words (null, empty, blank) are linked with nothing. A row with a null doc_id is linked
    with nothing, has a null component and is kept. Rows that repeat a doc_id count once, with their smallest text.
    """
    docs = one_per_id(docs)
    one = cut(sketches(docs))
    # Equal sets collapse to their smallest doc_id before anything is compared.
    filled = one.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = cut(filled.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")))
    shown = filled.select("doc_id", "bands").join(same.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    buckets = shown.select(F.col("doc_id").alias("id"), F.posexplode("bands").alias("band", "hash")).select("id", F.xxhash64("band", "hash").alias("key"), "band")
    nodes = filled.select(
        F.col("doc_id").alias("id"),
        F.col("n_shingles").alias("size"),
        *(F.col("sig")[k].alias(f"s{k}") for k in range(_LANES)),
        "bands",
    )
    most = _cutoff(percent)

    def likely(a, b):
        small, large = F.least(f"{a}size", f"{b}size"), F.greatest(f"{a}size", f"{b}size")
        return (small * 100 >= large * percent) & (_estimate(a, b) <= most)

    def first(a, b):
        # The band of this bucket is the first that both share.
        shared = [F.col(f"{a}bands")[k] == F.col(f"{b}bands")[k] for k in range(BANDS)]
        lowest = F.coalesce(*(F.when(c, F.lit(k)) for k, c in enumerate(shared)))
        return lowest == F.col(f"{a}band")

    dictionary = text_dictionary(docs)

    def fetch(ids):
        return _sets(zipped(docs, dictionary).join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), dictionary)

    def verify(pairs):
        shared = F.size(F.array_intersect("x", "y"))
        return pairs.where(shared * 100 >= (F.size("x") + F.size("y") - shared) * percent).select("a", "b")

    comps = link_groups(nodes, cut(shared_buckets(buckets)), likely, first, fetch, verify)
    reps = filled.join(same, ["n_shingles", "f1", "f2"]).select("doc_id", "rep")
    placed = reps.join(comps, reps["rep"] == comps["node"], "left").select(F.col("doc_id"), F.coalesce("comp", "rep").alias("component_id"))
    out = one.select("doc_id", "n_shingles").join(placed, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns as they were.

    Rows with a null doc_id stay. Of rows that repeat a kept doc_id the one with the smallest text
    stays.
    """
    gone = groups(docs, percent).where(~F.col("kept")).select("doc_id")
    return first_rows(docs).join(gone, "doc_id", "left_anti").select(*docs.columns)
