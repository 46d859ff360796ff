"""Removal of repeated passages with FM-indexes.

A window is 20 consecutive words of a document; a word goes if a window that covers it has started
earlier. Equal windows must meet, and unlike ones need not, so the corpus is split into shards by
content: the smallest hash among a window's 5-word grams names the window's key, neighbouring
windows with one key form a segment, and only segments whose key occurs more than once are read
again. Segments are dealt out by key, and each task turns its sorted stream into shards of bounded
size. A shard is a compressed FM-index: a wavelet matrix over the Burrows-Wheeler transform with
packed bits and block counts, and the first row of each symbol; no suffix positions are kept. The
shard's segments are streamed through it backwards, all positions in step: matching statistics grow
by a word a step for as long as the interval of rows holds another place than the position's own,
from a table of 16-word intervals on. Positions whose match reaches 20 words and that end in the same
interval hold the same window; all but the first of them are repeats.

A key with more than ``HOT`` segments is a passage too common for one shard. Its windows are dealt
out one by one, by their own hash and a salt, and need no index: in order, all but the first of
equal windows are repeats.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, one_per_id, text_dictionary, zipped, zipper
from tidewater.llm.words import shingles, signed, spans, word_hashes

WINDOW = 20
GRAM = 5
#: Words of a match that a table gives, a power of two; backward search goes on from there.
SEED = 16
#: Words of a shard. A shard ends with a key, so it holds at most HOT segments more.
SHARD_WORDS = 1 << 16
#: Windows of a segment.
RUN = 64
HOT = 20_000
SALTS = 32


def _fit(names: np.ndarray, times: int) -> bool:
    """Whether so many names in a row are one long."""
    return (int(names.max()) + 2) ** times < 1 << 63


def _in_a_row(names: np.ndarray, span: int, times: int) -> np.ndarray:
    """Numbers that sort as ``times`` names, each of ``span`` symbols, one after the other from each position; past the end sorts first."""
    out, base = names, int(names.max()) + 2
    for k in range(1, times):
        after = np.zeros_like(names)
        after[: max(0, len(names) - k * span)] = names[k * span :] + 1
        out = out * base + after
    return out


class FMIndex:
    """Intervals of the sorted suffixes of a text of symbol ids; 0 ends a segment. Suffixes count up to 2 * SEED symbols, which a window doesn't reach."""

    def __init__(self, text: np.ndarray):
        order, self.seeds = self._order(text)
        self.seed_first = np.concatenate(([0], np.cumsum(np.bincount(self.seeds)))).astype(np.int32)
        bwt = text[order - 1].astype(np.int32)
        self.symbols = int(text.max()) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.symbols)))).astype(np.int32)
        self.levels = []
        for bit in range(max(1, int(self.symbols - 1).bit_length()))[::-1]:
            ones = (bwt >> bit & 1).astype(bool)
            padded = np.zeros(len(ones) // 64 * 64 + 64, bool)
            padded[: len(ones)] = ones
            blocks = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64))).astype(np.int32)
            self.levels.append((bit, blocks, counts, np.int32(len(ones) - int(ones.sum()))))
            bwt = np.concatenate((bwt[~ones], bwt[ones]))
        # From a row on the last level to one of the sorted suffixes that begin with a symbol.
        every = np.arange(self.symbols, dtype=np.int32)
        self.shift = self.first[:-1] - self._descend(every, np.zeros(self.symbols, np.int32))

    @staticmethod
    def _order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes sorted by their first 2 * SEED symbols; the name of the SEED symbols at each position.

        Those that agree so far are in any order: no interval of a window or a part of one ends between them.
        """
        rank, span = text.astype(np.int64), 1
        while span < SEED:
            times = 4 if 4 * span <= SEED and _fit(rank, 4) else 2
            rank, span = np.unique(_in_a_row(rank, span, times), return_inverse=True)[1], span * times
        return np.argsort(_in_a_row(rank, span, 2)), rank.astype(np.int32)

    def seeded(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the SEED symbols at each position, from a table."""
        return self.seed_first[self.seeds[at]], self.seed_first[self.seeds[at] + 1]

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where row ``at`` of the transform lies among the rows of ``symbol`` on the last level."""
        for bit, blocks, counts, zeros in self.levels:
            block = at >> 6
            below = blocks[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = counts[block] + np.bitwise_count(below)
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of sequences after ``symbol`` is put before them."""
        both = self._descend(np.concatenate((symbol, symbol)), np.concatenate((low, high))) + np.tile(self.shift[symbol], 2)
        return both[: len(low)], both[len(low) :]


def matching_statistics(text: np.ndarray, most: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, starts, rows) of a text whose zeros end segments, streamed backwards over its own index.

    ``lengths`` has for each position how many words that end there, up to ``most``, also stand
    elsewhere; what is shorter than SEED counts as 0. ``starts`` are the places where such a match of
    ``most`` words begins, ``rows`` the first row of its interval: equal for equal windows only.
    """
    index = FMIndex(text)
    lengths = np.zeros(len(text), np.int8)
    ends = np.concatenate(([0], np.cumsum(text == 0)))
    start = np.arange(len(text) - SEED + 1)
    start = start[ends[start + SEED] == ends[start]]
    low, high = index.seeded(start)
    for length in range(SEED, most + 1):
        alive = high - low > 1
        start, low, high = start[alive], low[alive], high[alive]
        lengths[start + length - 1] = length
        if length == most or not len(start):
            break
        start = start - 1
        symbol = text[start]  # a zero stands before every segment, the first included
        inside = symbol > 0
        start, low, high = start[inside], low[inside], high[inside]
        if len(start):
            low, high = index.extend(low, high, symbol[inside].astype(np.int32))
    return lengths, start, low


def repeated_starts(text: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions where a window starts that occurs earlier in ``text``, whose zeros end segments."""
    _, starts, rows = matching_statistics(text, window)
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    return np.sort(starts[1:][rows[1:] == rows[:-1]])


def segments(docs: DataFrame) -> DataFrame:
    """(doc_id, key, start, n, grams): n windows from word ``start`` on whose smallest gram hash is ``key``; grams is 2 if they hold that gram twice."""

    def start():
        def one(text):
            words = word_hashes(text)
            if len(words) < WINDOW:
                return None
            grams = least = shingles(words, GRAM)
            reach, width = 1, WINDOW - GRAM + 1
            while reach < width:
                step = min(reach, width - reach)
                least = np.minimum(least[:-step], least[step:])
                reach += step
            starts = np.concatenate(([0], np.flatnonzero(np.diff(least)) + 1))
            if len(least) > RUN:
                starts = np.union1d(starts, np.arange(0, len(least), RUN))
            keys, n = least[starts], np.diff(np.append(starts, len(least)))
            # A segment that holds its key's gram twice may repeat a window by itself.
            order = np.argsort(grams, kind="stable")
            pair = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
            times = np.ones(len(starts), np.int32)
            if len(pair):
                one, two = order[pair], order[pair + 1]
                owner = np.searchsorted(starts, np.minimum(one, len(least) - 1), "right") - 1
                inside = (keys[owner] == grams[one]) & (two < starts[owner] + n[owner] + width - 1)
                times[owner[inside]] = 2
            return signed(keys), starts, n, times

        def step(ids, texts):
            found = [(i, *r) for i, t in zip(ids, texts, strict=True) if i is not None and (r := one(t))]
            if not found:
                return [[] for _ in range(5)]
            names = pa.array([f[0] for f in found])
            names = names.take(pa.array(np.repeat(np.arange(len(found)), [len(f[1]) for f in found])))
            return names, *(np.concatenate([f[k] for f in found]) for k in (1, 2, 3, 4))

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, key bigint, start int, n int, grams int", start)


def _texts_of(joined: DataFrame, dictionary: bytes) -> DataFrame:
    """(part, salt, doc_id, start, n, words): the compressed text of wanted segments; of hot ones window by window."""

    def start():
        pack, unpack = zipper(dictionary)

        def step(ids, zs, runs):
            out = [[] for _ in range(6)]
            for i, z, wanted in zip(ids, zs, runs, strict=True):
                raw = unpack(z)
                if any(r["hot"] for r in wanted):
                    keys = signed(shingles(word_hashes(raw.decode("utf-8", "surrogatepass")), WINDOW))
                begins, ends = spans(raw)
                for r in wanted:
                    for at in range(r["start"], r["start"] + r["n"]) if r["hot"] else [r["start"]]:
                        n = 1 if r["hot"] else r["n"]
                        row = (int(keys[at]) if r["hot"] else r["key"], 1 + zlib.crc32(str(i).encode()) % SALTS if r["hot"] else 0, i, at, n)
                        for column, v in zip(out, (*row, pack(raw[begins[at] : ends[at + n + WINDOW - 2]])), strict=True):
                            column.append(v)
            return out

        return step

    kind = joined.schema["doc_id"].dataType.simpleString()
    return map_batches(joined, ["doc_id", "z", "runs"], f"part bigint, salt int, doc_id {kind}, start int, n int, words binary", start)


def _repeats(rows: DataFrame, dictionary: bytes) -> DataFrame:
    """(doc_id, begin, end, part) from segments sorted by part, salt, doc_id and start.

    Words from begin to before end go; where part isn't null, only if this isn't the part's first row.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    def shard(held: list[tuple], unpack: Callable) -> tuple[list, list, list]:
        """Intervals of one shard: repeats of whole segments, then of windows of unlike segments."""
        ids, begins, ends = [], [], []
        seen: set = set()
        kept = []
        for part, doc, start, n, words in held:
            if (part, words) in seen:
                ids.append(doc), begins.append(start), ends.append(start + n + WINDOW - 1)
            else:
                seen.add((part, words))
                kept.append((part, doc, start, words))
        # Of a key with a single segment only a periodic one can repeat a window.
        unlike: dict = {}
        for k in kept:
            unlike[k[0]] = unlike.get(k[0], 0) + 1
        kept = [(*k[:3], unpack(k[3]).split()) for k in kept]
        kept = [k for k in kept if unlike[k[0]] > 1 or len(set(k[3])) <= len(k[3]) - WINDOW]
        if kept:
            kept.sort(key=lambda k: (k[1], k[2]))  # text positions then follow the corpus's order
            lengths = np.array([len(k[3]) for k in kept])
            # Before and after each segment a zero, so that no search leaves it.
            offsets = np.concatenate(([1], 1 + np.cumsum(lengths + 1)))
            names: defaultdict = defaultdict(count(1).__next__)
            words = np.fromiter(map(names.__getitem__, chain.from_iterable(k[3] for k in kept)), np.int64, lengths.sum())
            text = np.zeros(offsets[-1], np.int64)
            text[np.arange(len(words)) + np.repeat(np.arange(len(kept)) + 1, lengths)] = words
            found = repeated_starts(text)
            # Windows that follow one another are one interval; a segment's end always parts them.
            new = np.flatnonzero(np.diff(found, prepend=-2) > 1)
            lengths = np.diff(np.append(new, len(found)))
            found = found[new]
            owner = np.searchsorted(offsets, found, "right") - 1
            begin = found - offsets[owner] + np.array([k[2] for k in kept], np.int64)[owner]
            ids += [kept[o][1] for o in owner]
            begins += begin.tolist()
            ends += (begin + lengths - 1 + WINDOW).tolist()
        return ids, begins, ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zipper(dictionary)[1]
        held, size, last = [], 0, None
        for batch in batches:
            ids, begins, ends, parts = [], [], [], []
            for part, salt, doc, start, n, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if salt:
                    ids.append(doc), begins.append(start), ends.append(start + WINDOW)
                    parts.append(None if last == (part, salt) else part)
                    last = (part, salt)
                    continue
                if size >= SHARD_WORDS and part != held[-1][0]:
                    for column, found in zip((ids, begins, ends), shard(held, unpack), strict=True):
                        column += found
                    parts += [None] * (len(ids) - len(parts))
                    held, size = [], 0
                held.append((part, doc, start, n, words))
                size += n + WINDOW - 1
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((ids, begins, ends, parts), target, strict=True)], schema=target)
        ids, begins, ends = shard(held, unpack)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((ids, begins, ends, [None] * len(ids)), target, strict=True)], schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema

    fields = rows.sparkSession.createDataFrame([], f"doc_id {kind}, begin int, end int, part bigint").schema
    target = to_arrow_schema(fields)
    return rows.mapInArrow(run, fields)


def repeats(docs: DataFrame, dictionary: bytes, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Compressed texts by document, and (doc_id, cuts): each document's repeated word intervals."""
    # Both are filtered as the joins would filter them, so that each is shuffled once and read twice.
    texts = zipped(docs, dictionary).where(F.col("doc_id").isNotNull()).repartition("doc_id")
    runs = segments(docs).where(F.col("key").isNotNull() & F.col("doc_id").isNotNull()).repartition("key")
    # The condition, true of every run, needs all columns: both sides of the join then read one shuffle.
    counts = runs.groupBy("key").agg(F.sum("grams").alias("times"), F.max("doc_id").alias("_d"), F.max("start").alias("_s"), F.max("n").alias("_n"))
    counts = counts.where("times > 1 AND _d IS NOT NULL AND _s >= 0 AND _n > 0")
    wanted = runs.join(counts.select("key", "times"), "key")
    by_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("key", "start", "n", "grams", (F.col("times") > hot).alias("hot"))).alias("runs"))
    rows = _texts_of(by_doc.join(texts, "doc_id"), dictionary).repartition("part", "salt").sortWithinPartitions("part", "salt", "doc_id", "start")
    found = _repeats(rows, dictionary)
    # Of hot windows, which come in salted pieces, the first piece's first row stays.
    alone = F.xxhash64("doc_id", "begin", "end")
    piece = Window.partitionBy(F.coalesce("part", alone), F.col("part").isNull())
    first = F.min(F.struct("doc_id", "begin")).over(piece)
    found = found.withColumn("first", first).where(F.col("part").isNull() | (F.col("first") != F.struct("doc_id", "begin")))
    cuts = found.groupBy("doc_id").agg(F.collect_list(F.struct("begin", "end")).alias("cuts"))
    return texts, cuts


def removed(n: int, cuts: list | None) -> np.ndarray:
    """Which of n words the intervals cover."""
    edge = np.zeros(n + 1, np.int32)
    if cuts:
        np.add.at(edge, [c["begin"] for c in cuts], 1)
        np.add.at(edge, [c["end"] for c in cuts], -1)
    return np.cumsum(edge[:-1]) > 0


def deduplicate(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each whole text without the words of repeated windows.

    Words are runs other than ASCII white space, unchanged; ``kept`` joins those left by one space.
    Null and empty texts have no words and an empty ``kept``; texts under 20 words lose none. Order
    is by doc_id, then start. Rows that repeat a doc_id count once, with their smallest text; rows with
    a null one pass unchanged.
    """
    docs = one_per_id(docs)
    dictionary = text_dictionary(docs)
    texts, cuts = repeats(docs, dictionary, hot)
    nameless = zipped(docs.where(F.col("doc_id").isNull()), dictionary).withColumn("cuts", F.lit(None).cast(cuts.schema["cuts"].dataType))

    def start():
        unpack = zipper(dictionary)[1]

        def step(ids, zs, cuts):
            out = [[], [], [], []]
            for i, z, c in zip(ids, zs, cuts, strict=True):
                words = unpack(z).split()
                gone = removed(len(words), c)
                left = [w for w, g in zip(words, gone, strict=True) if not g] if c else words
                for column, v in zip(out, (i, len(words), int(gone.sum()), b" ".join(left).decode("utf-8", "surrogatepass")), strict=True):
                    column.append(v)
            return out

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(texts.join(cuts, "doc_id", "left").union(nameless), ["doc_id", "z", "cuts"], f"doc_id {kind}, n_words bigint, n_removed bigint, kept string", start)
