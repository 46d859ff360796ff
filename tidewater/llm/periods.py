"""Runs of repeated word sequences in whole texts, and the texts without the repeats.

A run is a stretch of words with smallest period q, at least four periods and six words long, that no
neighbouring word extends. Periods are looked for by octave, P <= q < 2P. At every 2P-th word of a text
lies a boundary; a run of that octave is longer than the space between two, so it holds a boundary at
which words repeat. There, one Z-function to the right and one over the reversed words to the left give
how far every period of the octave goes on either side. A boundary sees 2P words back and 6P words on,
which overlaps what the boundaries beside it see.

So a text falls into overlapping tiles whose length goes with the octave, and a tile needs no other: a
short text is one tile for all octaves and is solved where it is read; a longer one is exploded into
tiles, rows that are dealt out to all tasks. What tiles return are fragments (text, period, from, to), a
few a run. They are shuffled by text and period and stitched where they overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut, map_batches, text_dictionary, zipper
from tidewater.llm.words import word_hashes

#: Words of a tile's own part for octaves up to a sixteenth of it; higher octaves have tiles of 16 P. Texts up to twice that are one tile.
TILE = 8192
#: A run has at least so many periods and so many words.
PERIODS, WORDS = 4, 6
#: Boundaries and periods that are held against each other at once.
PAIRS = 1 << 20


def z_function(s: list, limit: int) -> list[int]:
    """For each i below ``limit``, how many items from i on equal those from the start."""
    n = len(s)
    z = [0] * min(limit, n)
    if z:
        z[0] = n
    left = right = 0
    for i in range(1, len(z)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _prime_factors(q: int) -> set[int]:
    out, p = set(), 2
    while p * p <= q:
        while q % p == 0:
            out.add(p)
            q //= p
        p += 1
    return out | {q} - {1}


def _boundaries(begins: np.ndarray, ends: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Every ``step``-th place from each begin to its end, and which of them it belongs to."""
    counts = np.maximum(0, -(-(ends - begins) // step))
    which = np.repeat(np.arange(len(begins)), counts)
    return begins[which] + step * (np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)), which


def _repeating(words: np.ndarray, at: np.ndarray, limit: np.ndarray, periods: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """(boundary's number, periods) where words repeat at a boundary as they do in every run of these periods that began just before."""
    rows = max(1, PAIRS // len(periods))
    last = len(words) - 1
    for k in range(0, len(at), rows):
        b, end = at[k : k + rows, None], limit[k : k + rows, None]
        i, j = np.nonzero((words[b] == words[np.minimum(b + periods, last)]) & (b + 2 * periods < end))
        b, q = b[i, 0], periods[j]
        for n in range(1, 5):
            fits = words[b + q * n // 4] == words[b + q * n // 4 + q]
            i, b, q = i[fits], b[fits], q[fits]
        if len(i):
            cuts = np.flatnonzero(np.diff(i)) + 1
            for number, own in zip(i[np.r_[0, cuts]], np.split(q, cuts), strict=True):
                yield k + int(number), own.tolist()


def solve(words: np.ndarray, texts: np.ndarray, cores: np.ndarray, octaves: np.ndarray) -> dict[tuple[int, int], list[list[int]]]:
    """Fragments [from, to) by (tile, period), places of ``words``: there each word equals the one a period on.

    Tiles lie one after another in ``words``: ``texts`` holds where each begins and ends, ``cores`` the part
    whose boundaries are its own, ``octaves`` the first and the last octave to look at.
    """
    found: dict[tuple[int, int], list[list[int]]] = {}
    for octave in range(int(octaves[:, 1].max(initial=-1)) + 1):
        p = 1 << octave
        wanted = np.flatnonzero((octaves[:, 0] <= octave) & (octave <= octaves[:, 1]) & (texts[:, 1] - texts[:, 0] >= PERIODS * p))
        at, which = _boundaries(cores[wanted, 0], cores[wanted, 1], 2 * p)
        which = wanted[which]
        for number, periods in _repeating(words, at, texts[which, 1], np.arange(p, 2 * p)):
            tile, b = int(which[number]), int(at[number])
            begin, end = map(int, texts[tile])
            z = z_function(words[b : min(end, b + 6 * p)].tolist(), 2 * p)
            low, high = max(begin, b - 2 * p), min(end, b + 2 * p)
            back = words[low:b][::-1].tolist()
            left = z_function([*back, None, *words[low:high][::-1].tolist()], len(back) + 1 + high - b)
            for q in periods:
                if any(z[q // f] >= q - q // f for f in _prime_factors(q)):
                    continue  # the words repeat in a shorter period, whose run this is
                before = left[len(back) + 1 + high - b - q]
                parts = found.setdefault((tile, q), [])
                if parts and b - before <= parts[-1][1]:
                    parts[-1] = [min(parts[-1][0], b - before), max(parts[-1][1], b + z[q])]
                else:
                    parts.append([b - before, b + z[q]])
    return found


def _tiles(n: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(first octave, last octave, begin, end, core begin, core end) of a long text's tiles."""
    top = max(0, (n // PERIODS).bit_length() - 1)
    small = (TILE // 16).bit_length() - 1
    for first, last in [(0, min(small, top)), *((k, k) for k in range(small + 1, top + 1))]:
        p = 1 << last
        core = max(TILE, 16 * p)
        for begin in range(0, n, core):
            yield first, last, max(0, begin - 2 * p), min(n, begin + core + 6 * p), begin, min(n, begin + core)


def _read(docs: DataFrame, dictionary: bytes) -> DataFrame:
    """A row a text: its number of words, the hash of its words, fragments if it is short, its compressed text if anything repeats; and a row a tile of each long text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"uid bigint, doc_id {kind}, n_words bigint, plain string, z binary, fragments array<struct<period: bigint, s: bigint, e: bigint>>, "
        "octaves array<int>, place array<bigint>, words array<int>"
    )

    def start():
        pack = zipper(dictionary)[0]

        def step(uids, ids, texts):
            rows, short, begin = [], [], 0
            for uid, doc_id, text in zip(uids, ids, texts, strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                hashes = word_hashes(text)
                plain = hashlib.sha256(b" ".join(raw.split())).hexdigest()
                row = [uid, doc_id, len(hashes), plain, None, None, None, None, None]
                rows.append(row)
                if len(hashes) <= 2 * TILE:
                    short.append((row, raw, hashes, begin))
                    begin += len(hashes)
                    continue
                row[4] = pack(raw)
                numbers = np.unique(hashes, return_inverse=True)[1].astype(np.int32)
                for first, last, low, high, core, stop in _tiles(len(hashes)):
                    rows.append([uid, None, None, None, None, None, [first, last], [low, core - low, stop - low], numbers[low:high]])
            if short:
                texts = np.array([(b, b + len(h)) for _, _, h, b in short], np.int64)
                octaves = np.array([(0, max(0, (len(h) // PERIODS).bit_length() - 1)) for _, _, h, _ in short])
                for (tile, q), parts in sorted(solve(np.concatenate([h for _, _, h, _ in short]), texts, texts, octaves).items()):
                    row, raw, _, at = short[tile]
                    row[4] = row[4] or pack(raw)
                    row[5] = (row[5] or []) + [{"period": q, "s": s - at, "e": e - at} for s, e in parts]
            return list(zip(*rows, strict=True))

        return step

    return map_batches(docs.withColumn("uid", F.monotonically_increasing_id()), ["uid", "doc_id", "text"], schema, start)


def _solved(tiles: DataFrame) -> DataFrame:
    """(uid, period, s, e): the fragments of all tiles of long texts."""

    def start():
        def step(uids, octaves, places, words):
            rows = [[], [], [], []]
            for uid, octave, (low, core, stop), own in zip(uids, octaves, places, words, strict=True):
                own = np.array(own, np.int32)
                found = solve(own, np.array([[0, len(own)]]), np.array([[core, stop]]), np.array([octave]))
                for (_, q), parts in sorted(found.items()):
                    for s, e in parts:
                        for column, value in zip(rows, (uid, q, low + s, low + e), strict=True):
                            column.append(value)
            return rows

        return step

    return map_batches(tiles, ["uid", "octaves", "place", "words"], "uid bigint, period bigint, s bigint, e bigint", start)


def stitch(fragments: DataFrame) -> DataFrame:
    """(uid, start, length, period): runs from fragments (uid, period, s, e) that overlap or adjoin."""
    order = Window.partitionBy("uid", "period").orderBy("s", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = fragments.withColumn("_new", F.coalesce((F.col("s") > before).cast("int"), F.lit(1)))
    rows = rows.withColumn("_n", F.sum("_new").over(order))
    rows = rows.groupBy("uid", "period", "_n").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    rows = rows.select("uid", "start", (F.col("e") - F.col("start") + F.col("period")).alias("length"), "period")
    return rows.where(F.col("length") >= F.greatest(F.lit(WORDS), PERIODS * F.col("period")))


def repetitions(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed, collapsed_sha256), a row a row of ``docs`` (doc_id, text).

    ``runs`` holds (start, period, length) in words, ordered by start, then period; it is empty for a text
    without one. ``collapsed`` has the words joined by one space of which none lies in a run after its
    first period; it is null where there are no runs, as nothing goes. ``collapsed_sha256`` is the hash of
    the words that stay, with or without runs. Null, empty and blank texts have no words. Rows are
    judged one by one, so rows that repeat or share a doc_id, or have none, each have theirs; other
    columns are ignored.
    """
    dictionary = text_dictionary(docs.select("text"))
    read = cut(_read(docs.select("doc_id", "text"), dictionary))
    texts, tiles = read.where("words IS NULL"), read.where("words IS NOT NULL")
    tiles = tiles.select("uid", "octaves", "place", "words").repartition("uid", "octaves", "place")
    fragments = texts.select("uid", F.explode("fragments").alias("f")).select("uid", "f.period", "f.s", "f.e").union(_solved(tiles))
    runs = stitch(fragments).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    rows = texts.select("uid", "doc_id", "n_words", "plain", "z").join(runs, "uid", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, period: bigint, length: bigint>>, collapsed string, collapsed_sha256 string"

    def start():
        unpack = zipper(dictionary)[1]

        def step(ids, counts, plains, zs, all_runs):
            out = []
            for doc_id, n, plain, z, own in zip(ids, counts, plains, zs, all_runs, strict=True):
                if not own:
                    out.append((doc_id, n, [], None, plain))
                    continue
                stays = np.ones(n, bool)
                for r in own:
                    stays[r["start"] + r["period"] : r["start"] + r["length"]] = False
                kept = b" ".join(w for w, stay in zip(unpack(z).split(), stays.tolist(), strict=True) if stay)
                out.append((doc_id, n, own, kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()))
            return [pa.array(c) if k == 4 else c for k, c in enumerate(zip(*out, strict=True))]

        return step

    return map_batches(rows, ["doc_id", "n_words", "plain", "z", "runs"], schema, start)
