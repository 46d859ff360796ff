"""Fuzzy line de-duplication.

Lines are normalised (lower case, digits to 0, ASCII punctuation and white space to single blanks).
Equal normalised lines are one line. Of unlike ones a pair is linked if the edit similarity of its
words is at least ``SIMILARITY``; of all lines of a connected group the first stays.

Keys follow from that rule without loss. An edit changes at most two of a line's pairs of
neighbouring words, so a pair of lines that may be linked differs in a bounded number of them; if
all lines sort theirs in one order, the first of them, one more than that number, have one in common,
which is the join key. Rare ones come first in the order, so that keys tell lines apart. One such key is
a pair that no edit touched, so no more words than edits may be missing before and after it: lines that
have a key in the wrong places don't meet by it. A candidate is then compared if a SimHash over the distinct
pairs of neighbouring words and the parities of its words, 256 bits and 512 more for long lines, don't
differ in more bits than the edits explain. Parities lose nothing; the SimHash is given four deviations, which
loses a link at the very bound about once in 30,000 times, others more rarely. Pairs count once however
often a line repeats them, so an edit that turns many equal ones changes one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut, drop_written, first_rows, map_batches, one_per_id, sampled_texts, small_batches, written
from tidewater.llm.grouping import link_groups
from tidewater.llm.words import located_hashes, mix, signed

#: Word pairs that differ by half turn 21 of 64 bits, with a deviation of 3.8; unlike lines differ in some 32. So many may always differ.
DISTANCE = 36
#: Bits beyond the expected number that a pair's SimHashes may differ in: four deviations.
SLACK = 16
#: 64 bits of parities each: bit b says whether the line's words that hash to b are odd in number.
PARITIES = 4
#: Lines of LONG words and more have WIDE more, in which a word's first occurrence, its second and so on count as words of their own.
LONG, WIDE = 80, 8
SIMILARITY = 0.8
#: Shorter lines (headings, list items, braces) are never removed.
MIN_WORDS = 5
#: Texts, first by hashed id, and their characters that tell common words from rare ones: this changes times, not results.
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 4096
_NORMAL = bytes(
    ord("0") if 48 <= c <= 57 else c if c >= 128 or 97 <= c <= 122 else ord(" ") for c in range(256)
)


#: The same with line feeds left.
_NORMAL_LINES = _NORMAL[:10] + b"\n" + _NORMAL[11:]


def normalise(line: str) -> bytes:
    return b" ".join(line.lower().encode("utf-8", "surrogatepass").translate(_NORMAL).split())


#: Features whose bits a byte can count.
_COUNTABLE = 255


def simhashes(begin: np.ndarray, count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The SimHash of each line of ``count`` features from ``begin`` on: bit b is the majority of bit b over them; a tie gives 0.

    Eight bits of a feature are added at once, each in a byte of its own; lines of more than a
    byte can count are added up from parts.
    """
    parts = -(-count // _COUNTABLE)
    nth = np.cumsum(parts) - parts
    owner = np.repeat(np.arange(len(count)), parts)
    starts = begin[owner] + _COUNTABLE * (np.arange(len(owner)) - nth[owner])
    out = np.zeros(len(count), np.uint64)
    shifts = 8 * np.arange(8, dtype=np.uint64)
    for bit in range(8):
        ones = np.add.reduceat(words >> np.uint64(bit) & np.uint64(0x0101010101010101), starts).view(np.uint8).reshape(-1, 8)
        if len(owner) > len(count):
            ones = np.add.reduceat(ones, nth, axis=0, dtype=np.int64)
        most = 2 * ones.astype(np.int64) > count[:, None]
        out |= (most.astype(np.uint64) << (shifts + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return signed(out)


def parities(begin: np.ndarray, words: np.ndarray, hashes: int) -> np.ndarray:
    """So many parities of 64 bits for each line of ``words`` from ``begin`` on: a word more or less turns one bit, another word two at most."""
    h = mix(words ^ np.uint64(0x5851F42D4C957F2D))
    bit, which = np.uint64(1) << (h & np.uint64(63)), h >> np.uint64(6) & np.uint64(hashes - 1)
    zero = np.uint64(0)
    return signed(np.stack([np.bitwise_xor.reduceat(np.where(which == np.uint64(k), bit, zero), begin) for k in range(hashes)], axis=1))


def occurrences(count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of each word of lines of ``count`` of the ``words`` with how many such words of its line come before it; in no order within a line."""
    line = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((words, line))
    words, line = words[order], line[order]
    runs = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (line[1:] != line[:-1])))
    nth = np.arange(len(words)) - np.repeat(runs, np.diff(np.append(runs, len(words))))
    return mix(words + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Cells of the distance tables that are filled at once.
_CELLS = 1 << 20


def edit_similar(a: list[bytes], b: list[bytes]) -> bool:
    """Whether 1 - (word edit distance) / (words of the longer) is at least ``SIMILARITY``."""
    names: dict = {}
    x, y = (np.array([names.setdefault(w, len(names)) for w in t], np.uint64) for t in (a, b))
    return bool(similar_pairs([x], [y])[0])


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """``edit_similar`` of many pairs of word hashes, about equally long ones at once."""
    n = np.array([(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    short, long = n.min(axis=1), n.max(axis=1)
    most = _edits(long)
    good = np.zeros(len(n), bool)
    # What one bag of words lacks of the other can't be mended by fewer edits.
    todo = np.flatnonzero(_in_common(left, right, n) >= long - most)
    plain = _plain_distances([sorted((left[k], right[k]), key=len) for k in todo]) <= most[todo]
    good[todo[plain]], todo = True, todo[~plain]
    todo = todo[np.argsort(long[todo])]
    while len(todo):
        longest = int(long[todo[-1]])
        # As many as the cells allow, and none much shorter: all rows of a step are as wide as the widest.
        size = min(max(1, _CELLS // (2 * longest + 1)), int((long[todo] >= 0.8 * longest).sum()))
        part, todo = todo[-size:], todo[:-size]
        both = [sorted((left[k], right[k]), key=len) for k in part]
        good[part] = _distances([x for x, _ in both], [y for _, y in both], int(most[part].max())) <= most[part]
    return good


def _in_common(left: list[np.ndarray], right: list[np.ndarray], n: np.ndarray) -> np.ndarray:
    """How many words each pair has in common, repeats counted."""
    if not n.sum():
        return np.zeros(len(n), np.int64)
    words = np.concatenate((*left, *right))
    pair = np.concatenate((np.repeat(np.arange(len(n)), n[:, 0]), np.repeat(np.arange(len(n)), n[:, 1])))
    mine = np.arange(len(words)) < n[:, 0].sum()
    order = np.lexsort((words, pair))
    words, pair, mine = words[order], pair[order], mine[order]
    runs = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (pair[1:] != pair[:-1])))
    x, y = (np.add.reduceat(side, runs, dtype=np.int64) for side in (mine, ~mine))
    return np.bincount(pair[runs], weights=np.minimum(x, y), minlength=len(n)).astype(np.int64)


def _plain_distances(pairs: list[list[np.ndarray]]) -> np.ndarray:
    """The edits of (shorter, longer) pairs if all words that one lacks stood at one place, the best: never fewer than the edit distance."""
    if not pairs:
        return np.zeros(0, np.int64)
    m = np.array([len(x) for x, _ in pairs])
    x = np.concatenate([x for x, _ in pairs])
    front, back = (x != np.concatenate([f(y, len(v)) for v, y in pairs]) for f in (lambda y, k: y[:k], lambda y, k: y[len(y) - k :]))
    # Words before a place are compared from the front, those from it on from the back.
    change = np.concatenate(([0], np.cumsum(front.astype(np.int64) - back)))
    begin = np.cumsum(m) - m
    rest = np.concatenate(([0], np.cumsum(back)))
    best = np.minimum.reduceat(np.append(change[1:], change[-1]), begin) if len(x) else change[begin]
    some = m > 0
    best = np.where(some, np.minimum(best, change[begin]), change[begin])
    return best - change[begin] + rest[begin + m] - rest[begin] + np.array([len(y) for _, y in pairs]) - m


def _distances(short: list[np.ndarray], long: list[np.ndarray], width: int) -> np.ndarray:
    """Edit distances of pairs, exact where they are at most ``width``: rows of all tables in step, each within ``width`` of the diagonal."""
    ns, nl = np.array([len(x) for x in short]), np.array([len(y) for y in long])
    a, b = (np.zeros((len(t), int(n.max()) + more), np.uint64) for t, n, more in ((short, ns, 0), (long, nl, 2 * width + 1)))
    for k, (x, y) in enumerate(zip(short, long, strict=True)):
        a[k, : len(x)], b[k, width : width + len(y)] = x, y
    off = np.arange(-width, width + 1)
    far = int(nl.max()) + width + 1
    row = np.where((off >= 0) & (off <= nl[:, None]), off, far).astype(np.int32)
    step = np.arange(len(off), dtype=np.int32)
    out = row[np.arange(len(ns)), nl - ns + width].copy()  # of empty ones
    for i in range(1, int(ns.max()) + 1):
        at = i + off
        new = row + (b[:, i - 1 : i + 2 * width] != a[:, i - 1 : i])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        new[:, at == 0] = i
        new[:, at < 0] = far
        row = np.minimum(np.minimum.accumulate(new - step, axis=1) + step, far)
        row[at[None, :] > nl[:, None]] = far
        row[:, at < 0] = far
        done = ns == i
        out[done] = row[done, (nl - ns + width)[done]]
    return out


def _edits(n: np.ndarray) -> np.ndarray:
    """The most words that may be edited if the longer line has ``n``."""
    return ((1 - SIMILARITY) * n + 1e-9).astype(np.int64)


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    """How many word pairs of a line of ``n`` words can't all be missing in a line it may be linked with.

    As the longer line it loses two by each edit, as the shorter one by an added word just one.
    """
    most = 2 * _edits(n)
    for more in range(1, 5):  # a fifth word more allows one edit more, which doesn't make up for five
        most = np.maximum(most, 2 * _edits(n + more) - more)
    return most + 1


def least_cosine(n: Column, d: Column) -> Column:
    """The least cosine of the sets of distinct word pairs of two linked lines: ``n`` words in the longer line, ``d`` distinct pairs in the richer one.

    An edit takes two pairs out of a set at most; a line of few distinct pairs may lose them all.
    """
    return F.greatest(F.lit(0.0), 1 - 2 * F.floor((1 - SIMILARITY) * n + 1e-9) / d)


def most_bits(cosine: Column) -> Column:
    """The most bits of SimHashes that sets of this cosine may differ in."""
    return F.acos(cosine) * (64 / math.pi) + SLACK


def common_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the words that a bounded sample of texts holds more than once."""
    sample = [t.lower().encode("utf-8", "surrogatepass").translate(_NORMAL) for t in sampled_texts(docs, SAMPLE_DOCS, SAMPLE_CHARS)]
    names, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *(located_hashes(t)[1] for t in sample)]), return_counts=True)
    return names[counts > 1], counts[counts > 1]


def word_pairs(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the next."""
    return mix(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])


_NONE = (np.empty(0, np.uint64), np.empty(0, np.int64))
#: Lines whose word pairs are sorted at once: their number within takes 16 bits of the sort's key.
_SORTED = 1 << 16


#: The place of a pair that a line has more than once, or that is further on.
ANYWHERE = 255


def distinct_pairs(words: np.ndarray, count: np.ndarray, common: tuple[np.ndarray, np.ndarray] = _NONE) -> tuple[np.ndarray, ...]:
    """The distinct word pairs of lines that hold ``count`` of the ``words`` each, a line's rare ones first, how many each line has, and their places."""
    if len(count) > _SORTED:
        half = len(count) // 2
        cut_at = int(count[:half].sum())
        parts = [distinct_pairs(words[:cut_at], count[:half], common), distinct_pairs(words[cut_at:], count[half:], common)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
    line = np.repeat(np.arange(len(count), dtype=np.uint64), count)
    inside = line[1:] == line[:-1]
    pairs = word_pairs(words)[inside]
    place = np.minimum((np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count))[:-1][inside], ANYWHERE).astype(np.uint8)
    often = np.zeros(len(words), np.float32)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], words), len(common[0]) - 1)
        often = np.where(common[0][at] == words, np.log2(common[1][at]), 0).astype(np.float32)
    rank = np.minimum(often[:-1] + often[1:], 63)[inside].astype(np.uint64)
    line = line[1:][inside]
    # Line, then how common the words are, then the pair's hash: one number, one sort.
    order = np.argsort(line << np.uint64(48) | rank << np.uint64(42) | pairs >> np.uint64(22))
    line, pairs, place = line[order].astype(np.int64), pairs[order], place[order]
    new = np.append(True, (line[1:] != line[:-1]) | (pairs[1:] != pairs[:-1]))
    once = np.append(new[1:], True)[new]
    return pairs[new], np.bincount(line[new], minlength=len(count)), np.where(once, place[new], np.uint8(ANYWHERE))


#: Bits of a key; more would only take room.
KEY_BITS = 48


def line_keys(pairs: np.ndarray, many: np.ndarray, count: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Join keys of lines of ``count`` words that have ``many`` of the distinct ``pairs`` each, how many keys each line has, and their places."""
    line = np.repeat(np.arange(len(many)), many)
    taken = np.arange(len(line)) - np.repeat(np.cumsum(many) - many, many) < prefix_lengths(count)[line]
    return signed(pairs[taken] >> np.uint64(64 - KEY_BITS)), np.bincount(line[taken], minlength=len(many)), places[taken]


_ODD = [f"o{k}" for k in range(PARITIES)]
#: Lines that a task remembers.
SEEN = 500_000


def parted(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Text, line, words and id of the lines of MIN_WORDS words and more of ``texts``, and those lines' words' hashes."""
    raws = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    first = np.cumsum([0] + [r.count(b"\n") + 1 for r in raws])
    raw = b"\n".join(raws).translate(_NORMAL_LINES)
    starts, words = located_hashes(raw)
    bounds = np.searchsorted(starts, np.flatnonzero(np.frombuffer(raw, np.uint8) == 10))
    count = np.diff(np.concatenate(([0], bounds, [len(starts)])))
    line = np.flatnonzero(count >= MIN_WORDS)
    words = words[np.repeat(count >= MIN_WORDS, count)]
    count = count[line]
    begin = np.cumsum(count) - count
    place = np.arange(1, len(words) + 1) - np.repeat(begin, count)
    sums = np.add.reduceat(mix(words + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), begin) if len(line) else words[:0]
    ids = signed(mix(sums + mix(count.astype(np.uint64))))
    owner = np.searchsorted(first, line, "right") - 1
    return owner, line - first[owner], count, ids, words


def sketched(count: np.ndarray, words: np.ndarray, common: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """SimHashes, parities, numbers of distinct word pairs, join keys of the wanted lines, how many keys each line has, and their places; the others' are 0.

    Last come further parities, of long lines alone.
    """
    many, rich, sims = (np.zeros(len(count), np.int64) for _ in range(3))
    odd, wide = np.zeros((len(count), PARITIES), np.int64), np.zeros((0, WIDE), np.int64)
    words, count = words[np.repeat(wanted, count)], count[wanted]
    if not len(count):
        return sims, odd, rich, np.empty(0, np.int64), many, np.empty(0, np.uint8), wide
    pairs, own, places = distinct_pairs(words, count, common)
    rich[wanted] = own
    keys, many[wanted], places = line_keys(pairs, own, count, places)
    sims[wanted] = simhashes(np.cumsum(own) - own, own, pairs)
    odd[wanted] = parities(np.cumsum(count) - count, words, PARITIES)
    if (long := count >= LONG).any():
        n = count[long]
        wide = parities(np.cumsum(n) - n, occurrences(n, words[np.repeat(long, count)]), WIDE)
    return sims, odd, rich, keys, many, places, wide


def hashed_lines(text: str, common: tuple[np.ndarray, np.ndarray] = _NONE) -> tuple[np.ndarray, ...]:
    """Numbers, ids, SimHashes and words of a text's lines of MIN_WORDS words and more, then their keys and how many each has."""
    _, line, count, ids, words = parted([text])
    if not len(line):
        return tuple(np.empty(0, np.int64) for _ in range(6))
    sims, _, _, keys, many, *_ = sketched(count, words, common, np.ones(len(line), bool))
    return line, ids, sims, count, keys, many


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, id, n, d, s, o0 to o3, wide, keys, places): lines of MIN_WORDS words and more, ``id`` hashing the normalised line of n words, d distinct pairs.

    A key's place is a byte. A task gives a line's keys and SimHashes once, not for each equal line, as long as it remembers it;
    rows without keys have none.
    """
    common = common_words(docs)

    def start():
        seen: set = set()

        def unseen(names):
            if len(seen) > SEEN:
                seen.clear()
            return np.array([not (n in seen or seen.add(n)) for n in names.tolist()], bool)

        def step(ids, texts):
            owner, line, count, names, words = parted([t if i is not None else None for i, t in zip(ids, texts, strict=True)])
            if not len(line):
                return [[] for _ in range(9 + PARITIES)]
            new = unseen(names)
            sims, odd, rich, keys, many, places, more = sketched(count, words, common, new)
            has = new & (count >= LONG)
            wide = pa.ListArray.from_arrays(pa.array(WIDE * np.append(0, np.cumsum(has)), pa.int32()), pa.array(more.ravel()))
            ends = pa.array(np.append(0, np.cumsum(many)), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(keys))
            bytes_ = pa.Array.from_buffers(pa.binary(), len(many), [None, ends.buffers()[1], pa.py_buffer(places.tobytes())])
            return pa.array(ids).take(pa.array(owner)), line, names, count, rich, sims, *odd.T, wide, lists, bytes_

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, line int, id bigint, n int, d int, s bigint, {', '.join(f'{c} bigint' for c in _ODD)}, wide array<bigint>, keys array<bigint>, places binary", start)


#: Keys that a task holds before it deals them out, or sorts them.
HELD = 1 << 20
#: Parts that keys are dealt out in: as many at least, and no more than so many keys in one on average.
PARTS, PART_KEYS = 1024, 1 << 21


#: Rows of a key that are met one by one: of more, those of a centre and of groups (``link_groups``).
FEW = 32


def _at(n: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Length and place as two bytes; longer lines are long, and their pairs may be anywhere."""
    return (np.minimum(n, ANYWHERE) << 8 | np.where(n < ANYWHERE, places, ANYWHERE)).astype(np.uint16).view(np.int16)


def may_meet(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether lines may be linked by a pair of words that they have at ``x`` and ``y`` (``_at``), one pair untouched by any edit."""
    x, y = x.view(np.uint16), y.view(np.uint16)
    n, m, p, q = ((v >> 8 if high else v & 255).astype(np.int32) for high in (True, False) for v in (x, y))
    left, more = p - q, n - m
    most = np.maximum(n, m) // 5
    placed = (p < ANYWHERE) & (q < ANYWHERE)
    return (np.abs(more) <= most) & (~placed | (np.abs(left) + np.abs(more - left) <= most))


def _dealt(sketches: DataFrame, parts: int, held: int) -> DataFrame:
    """(part, keys, ids, at): the join keys of many lines, the lines they are of and where, a row a part; a key is 32 bits of its part.

    Of ``sketches`` without n and places lines may have their keys anywhere.
    """
    placed = "places" in sketches.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(ids, keys, at):
            ids, keys, at = np.concatenate(ids), np.concatenate(keys).view(np.uint64), np.concatenate(at)
            part = (keys % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
            keys = (keys // np.uint64(parts)).astype(np.uint32).view(np.int32)[order]
            n = np.bincount(part, minlength=parts)
            some = np.flatnonzero(n)
            ends = pa.array(np.append(0, np.cumsum(n[some])), pa.int32())
            lists = (pa.ListArray.from_arrays(ends, pa.array(v)) for v in (keys, ids[order], at[order]))
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *lists], names=["part", "keys", "ids", "at"])

        ids, keys, at, size = [], [], [], 0
        for batch in batches:
            lists = batch.column(1)
            many = np.diff(lists.offsets.to_numpy())
            ids.append(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), many))
            keys.append(lists.flatten().to_numpy(zero_copy_only=False))
            if placed:
                n = np.repeat(batch.column(2).to_numpy(zero_copy_only=False), many)
                at.append(_at(n, np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8)))
            else:
                at.append(np.full(len(ids[-1]), -1, np.int16))
            size += len(ids[-1])
            if size >= held:
                yield blocks(ids, keys, at)
                ids, keys, at, size = [], [], [], 0
        if size:
            yield blocks(ids, keys, at)

    return sketches.select("id", "keys", *(["n", "places"] if placed else [])).mapInArrow(run, "part int, keys array<int>, ids array<bigint>, at array<smallint>")


class Few:
    """Lines of keys that have no more than ``FEW``: ``add`` gives the pairs of them that may meet, and the rows of keys that have more.

    What is remembered is at most so many rows a key.
    """

    def __init__(self, few: int):
        self.few = few
        self.keys, self.ids, self.at = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int16)
        #: Keys that have had more; their rows are not remembered.
        self.full = np.empty(0, np.uint64)

    @staticmethod
    def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        return begin, np.diff(np.append(begin, len(keys)))

    def add(self, keys: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Both lines of pairs, then keys and lines of rows of full keys."""
        return self.sorted_out(keys, ids, at)[:4]

    def sorted_out(self, keys: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """As ``add``, and where the rows of full keys have them."""
        if not self.few:
            return ids[:0], ids[:0], keys, ids, at
        old = np.append(np.ones(len(self.keys), bool), np.zeros(len(keys), bool))
        keys, ids, at = np.concatenate((self.keys, keys)), np.concatenate((self.ids, ids)), np.concatenate((self.at, at))
        order = np.argsort(keys, kind="stable")
        keys, ids, at, old = keys[order], ids[order], at[order], old[order]
        begin, n = self._runs(keys)
        if (n > self.few).any():
            # Equal lines of several tasks count once, the one that came first.
            many = np.flatnonzero(np.repeat(n > self.few, n))
            many = many[np.lexsort((ids[many], keys[many]))]
            again = many[1:][(keys[many[1:]] == keys[many[:-1]]) & (ids[many[1:]] == ids[many[:-1]])]
            keys, ids, at, old = (np.delete(v, again) for v in (keys, ids, at, old))
            begin, n = self._runs(keys)
        known = np.searchsorted(self.full, keys[begin])
        known = self.full[np.minimum(known, len(self.full) - 1)] == keys[begin] if len(self.full) else np.zeros(len(begin), bool)
        over = (n > self.few) | known
        self.full = np.union1d(self.full, keys[begin][over])
        gone = np.repeat(over, n)
        rows = keys[gone], ids[gone], at[gone]
        keys, ids, at, old = keys[~gone], ids[~gone], at[~gone], old[~gone]
        nth = np.arange(len(keys)) - np.repeat(np.cumsum(n[~over]) - n[~over], n[~over])
        a, b = [ids[:0]], [ids[:0]]
        last = np.flatnonzero((nth > 0) & ~old)
        for back in range(1, self.few):
            last = last[nth[last] >= back]
            if not len(last):
                break
            other = last - back
            met = may_meet(at[last], at[other]) & (ids[last] != ids[other])
            x, y = ids[last[met]], ids[other[met]]
            a.append(np.maximum(x, y))
            b.append(np.minimum(x, y))
        self.keys, self.ids, self.at = keys, ids, at
        return np.concatenate(a), np.concatenate(b), *rows


class Shared:
    """Which of the keys that come in, part by part, more than one line has: ``add`` gives those lines' rows.

    Of a key only the line that came first is remembered, as the centre of those that follow, so that
    memory follows the number of distinct keys and a key may have any number of lines.
    """

    def __init__(self):
        self.keys, self.ids, self.at = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int16)
        #: Lines of each key so far; those that came twice count twice.
        self.n = np.empty(0, np.int64)

    def add(self, keys: np.ndarray, ids: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """(id, key, n, centre) of lines whose key others have too, and ``at`` if given; n is the number of the key's lines so far. A line may come again."""
        times = np.concatenate((self.n, np.ones(len(keys), np.int64)))
        places = np.concatenate((self.at, np.zeros(len(keys), np.int16) if at is None else at))
        keys, ids = np.concatenate((self.keys, keys)), np.concatenate((self.ids, ids))
        order = np.argsort(keys, kind="stable")  # a centre comes before new lines
        keys, ids, times, places = keys[order], ids[order], times[order], places[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        centre = ids[first][owner]
        other = ids != centre
        shared = np.bincount(owner[other], minlength=len(first)) > 0
        # The centre's own row goes out with the first other line.
        new = other.copy()
        new[first] = shared & (times[first] == 1)
        times[~other & (np.arange(len(keys)) != first[owner])] = 0
        self.keys, self.ids, self.at, self.n = keys[first], ids[first], places[first], np.add.reduceat(times, first) if len(first) else times
        found = ids[new], keys[new].view(np.int64), self.n[owner[new]], centre[new]
        return found if at is None else (*found, places[new])


def _met(dealt: DataFrame, held: int, few: int) -> DataFrame:
    """(id, key, n, centre, at): pairs of ``Few``, without key and place, and ``Shared`` rows of the other keys of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scarce, known, keys, ids, at, size = Few(few), Shared(), [], [], [], 0

        def found():
            a, b, *rest = scarce.sorted_out(np.concatenate(keys), np.concatenate(ids), np.concatenate(at))
            both = np.unique(np.stack((a, b), axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
            one = np.ones(len(both), np.int64)
            rows = known.add(*rest)
            nokey, nowhere = (pa.nulls(len(both), kind) for kind in (pa.int64(), pa.int16()))
            columns = zip((both[:, 0], nokey, one, both[:, 1], nowhere), rows, [*[pa.int64()] * 4, pa.int16()], strict=True)
            return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(x, kind), pa.array(y, kind)]) for x, y, kind in columns], names=["id", "key", "n", "centre", "at"])

        for batch in batches:
            parts, lists, lines_, places = batch.columns
            part = np.repeat(parts.to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())).astype(np.uint64)
            keys.append(part << np.uint64(32) | lists.flatten().to_numpy(zero_copy_only=False).view(np.uint32))
            ids.append(lines_.flatten().to_numpy(zero_copy_only=False))
            at.append(places.flatten().to_numpy(zero_copy_only=False))
            size += len(part)
            if size >= held:
                yield found()
                keys, ids, at, size = [], [], [], 0
        if size:
            yield found()

    return dealt.mapInArrow(run, "id bigint, key bigint, n bigint, centre bigint, at smallint")


def shared_keys(sketches: DataFrame, parts: int = PARTS, held: int = HELD, few: int = 0) -> DataFrame:
    """(id, key, n, centre, at) of the lines of ``sketches`` (id, keys, n and places or neither) whose key more than ``few`` other lines have too, each once.

    As ``shared_buckets``, but that keys travel in blocks, all are shuffled once and sorted by the task they come to,
    the centre is any line of the key and n is how many it had as the line came. Of keys with no more than ``few`` rows
    come the pairs (id, centre) that may meet, without a key.
    """
    met = _met(_dealt(sketches, parts, held).repartition("part"), held, few)
    # A pair comes from one key or many, a row of a key from its part alone.
    other = F.when(F.col("key").isNull(), F.col("centre"))
    return met.groupBy("id", "key", other.alias("other")).agg(F.max("n").alias("n"), F.min("centre").alias("centre"), F.max("at").alias("at")).drop("other")


def with_previous(rows: DataFrame) -> DataFrame:
    """``rows`` (id, key, at) with ``previous``: of the line's rows the one before, as its key and how many words before it stands.

    Lines that have both their keys and those before in common, as far before, meet by those before already, as far apart as here.
    """
    place = F.col("at").bitwiseAND(ANYWHERE)
    by = Window.partitionBy("id").orderBy("place")
    rows = rows.withColumn("place", place)
    # Keys have KEY_BITS bits and some more, a distance eight.
    before = F.lag("key").over(by) * (ANYWHERE + 1) + F.col("place") - F.lag("place").over(by)
    return rows.withColumn("previous", F.when(F.col("place") < ANYWHERE, before)).drop("place")


#: Rows of large keys that are paired at once, and pairs that are sifted at once.
PAIRED, SIFTED = 1 << 16, 1 << 20


def sift(x: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows ``a`` and ``b`` of ``x`` (n, d, s, odd, wide) may be linked: as ``likely`` in ``repeated_lines``."""
    n, m = x["n"][a], x["n"][b]
    longer = np.maximum(n, m)
    most = _edits(longer)
    apart = np.abs(n - m)
    turned = 2 * most - apart
    bits = lambda name, p, q: np.bitwise_count((x[name][p] ^ x[name][q]).view(np.uint64)).sum(axis=1, dtype=np.int64)
    good = np.flatnonzero((apart <= most) & (bits("odd", a, b) <= turned))
    a, b, turned, most = a[good], b[good], turned[good], most[good]
    cosine = np.maximum(0.0, 1 - 2 * most / np.maximum(x["d"][a], x["d"][b]))
    close = bits("s", a, b) <= np.maximum(DISTANCE, np.arccos(cosine) * (64 / math.pi) + SLACK)
    long = np.flatnonzero((x["n"][a] >= LONG) & (x["n"][b] >= LONG) & close)
    close[long] = bits("wide", a[long], b[long]) <= turned[long]
    return good[close]


def pairs_within(group: np.ndarray, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the likely pairs of rows of one ``group``; groups come in order, ``x`` as ``sift`` and ``_met_by_key`` have it.

    A group's rows are sorted by length, so that each is held only against those that aren't too short for it.
    """
    order = np.lexsort((x["n"], group))
    group, x = group[order], {name: v[order] for name, v in x.items()}
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    many = np.diff(np.append(begin, len(group)))
    nth = np.arange(len(group)) - np.repeat(begin, many)
    n, at, comp, alone, previous = (x[c] for c in ("n", "at", "comp", "alone", "previous"))
    least = n - _edits(n)
    a, b, found, held = [], [], [np.empty((0, 2), np.int64)], 0

    def sifted():
        p, q = np.concatenate(a), np.concatenate(b)
        good = sift(x, p, q)
        p, q = x["id"][p[good]], x["id"][q[good]]
        found.append(np.unique(np.stack((np.minimum(p, q), np.maximum(p, q)), axis=1), axis=0))

    last, back = np.arange(len(group)), 0
    while len(last):
        back += 1
        last = last[nth[last] >= back]
        last = last[n[last - back] >= least[last]]
        other = last - back
        met = (comp[last] != comp[other]) & (alone[last] | (x["block"][last] != x["block"][other]))
        met &= (previous[last] != previous[other]) | (previous[last] == NO_KEY)
        p = last[met]
        p = p[may_meet(at[p], at[p - back])]
        if len(p):
            a.append(p)
            b.append(p - back)
            held += len(p)
        if held >= SIFTED:
            sifted()
            a, b, held = [], [], 0
    if held:
        sifted()
    both = np.unique(np.concatenate(found), axis=0)
    return both[:, 0], both[:, 1]


#: Stands for no previous key; keys have no sign.
NO_KEY = -1


def _met_by_key(rows: DataFrame) -> DataFrame:
    """(a, b): the likely pairs of two groups among the members of large keys that meet (``link_groups``), where no pair of words before makes them meet."""
    plain = ["id", "comp", "block", "at", "n", "d"]
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    rows = rows.select("key", "i", "j", *plain, F.coalesce("previous", F.lit(NO_KEY)).alias("previous"), "s", *_ODD, "wide")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table):
            c = {name: table[name].combine_chunks() for name in table.column_names}
            whole = lambda name: c[name].to_numpy(zero_copy_only=False)
            key, i, j = whole("key"), whole("i"), whole("j")
            new = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
            wide = np.zeros((len(key), WIDE), np.int64)
            wide[pc.list_value_length(c["wide"]).fill_null(0).to_numpy() > 0] = c["wide"].flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDE)
            x = {name: whole(name) for name in (*plain, "previous")}
            x |= {"n": x["n"].astype(np.int64), "alone": i == j, "s": whole("s")[:, None], "odd": np.stack([whole(o) for o in _ODD], axis=1), "wide": wide}
            a, b = pairs_within(np.cumsum(new), x)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PAIRED:
                table = pa.Table.from_batches(held)
                # The last key's rows may go on.
                same = np.ones(size, bool)
                for name in ("key", "i", "j"):
                    v = table[name].to_numpy()
                    same &= v == v[-1]
                begin = int(np.argmax(same))
                if begin:
                    yield found(table.slice(0, begin))
                held = table.slice(begin).to_batches()
                size -= begin
        if size:
            yield found(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a bigint, b bigint")


def _normalised(joined: DataFrame) -> DataFrame:
    """(id, payload): wanted lines, normalised."""

    def start():
        def step(texts, wanted):
            out = [[], []]
            for text, rows in zip(texts, wanted, strict=True):
                parts = text.split("\n")
                for r in rows:
                    out[0].append(r["id"])
                    out[1].append(normalise(parts[r["line"]]))
            return out

        return step

    return map_batches(joined, ["text", "wanted"], "id bigint, payload binary", start)


#: Pairs, and bytes of them, that are compared at once: lines of about one length share the steps of a table.
COMPARED, COMPARED_BYTES = 8192, 1 << 23


def _verified(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashes(texts):
            starts, words = located_hashes(b"\n".join(texts))
            lengths = np.cumsum([0] + [len(t) + 1 for t in texts])
            return np.split(words, np.searchsorted(starts, lengths[1:-1]))

        def linked(held):
            a, b, x, y = pa.Table.from_batches(held).columns
            good = pa.array(np.flatnonzero(similar_pairs(hashes(x.to_pylist()), hashes(y.to_pylist()))))
            return pa.RecordBatch.from_arrays([c.combine_chunks().take(good) for c in (a, b)], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= COMPARED or size >= COMPARED_BYTES:
                yield linked(held)
                held, rows, size = [], 0, 0
        if held:
            yield linked(held)

    small_batches(pairs.sparkSession)
    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


#: Bits that documents are set in before their texts are shuffled, 64 a row of a table that is broadcast.
MARKS = 1 << 22


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most of those whose doc_id isn't among ``ids``: the rest share a bit with one that is. However many there are, the bits are as many."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    row, place = F.shiftright(bit, 6), bit.bitwiseAND(63).cast("int")
    marks = ids.select(row.alias("_row"), place.alias("_place")).withColumn("_bit", F.expr("shiftleft(1L, _place)"))
    marks = marks.groupBy("_row").agg(F.bit_or("_bit").alias("_bits"))
    rows = docs.withColumns({"_mark_row": row, "_mark": place})
    met = (F.col("_mark_row") == F.col("_row")) & (F.expr("shiftrightunsigned(_bits, _mark) & 1") == 1)
    return rows.join(F.broadcast(marks), met, "left_semi").drop("_mark_row", "_mark")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, gone): the lines of each document that are not the first of their group, by number."""
    spark, mark = docs.sparkSession, written()
    sketched = cut(lines(docs))
    many = sketched.agg(F.sum(F.size("keys"))).first()[0] or 0
    keyed = sketched.where(F.size("keys") > 0).select("id", "keys", "n", "places")
    shared = cut(shared_keys(keyed, max(PARTS, many // PART_KEYS), few=FEW))
    found = cut(sketched.withColumn("own", F.size("keys") > 0).drop("keys", "places"))
    drop_written(spark, mark, keep=2)
    # The smallest place stands for all equal lines.
    sims = (F.max(F.when(F.col("own"), F.col(c))).alias(c) for c in ("d", "s", *_ODD, "wide"))
    distinct = cut(found.groupBy("id").agg(F.min("n").alias("n"), *sims, F.min(F.struct("doc_id", "line")).alias("at")))

    def likely(a, b):
        bits = lambda c: F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}")))
        longer, apart = F.greatest(f"{a}n", f"{b}n"), F.abs(F.col(f"{a}n") - F.col(f"{b}n"))
        most = F.floor((1 - SIMILARITY) * longer + 1e-9)
        cosine = least_cosine(longer, F.greatest(f"{a}d", f"{b}d"))
        close = bits("s") <= F.greatest(F.lit(DISTANCE), most_bits(cosine))
        # A word put in place of another turns two parities, a word more or less just one.
        turned = 2 * most - apart
        wide = F.zip_with(f"{a}wide", f"{b}wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        both = F.least(f"{a}n", f"{b}n") >= LONG
        wide = ~both | (F.aggregate(wide, F.lit(0), lambda n, x: n + x) <= turned)
        return (apart <= most) & (sum(map(bits, _ODD[1:]), bits(_ODD[0])) <= turned) & close & wide

    def fetch(ids):
        places = ids.join(distinct, "id").groupBy("at.doc_id").agg(F.collect_list(F.struct("id", "at.line")).alias("wanted"))
        places = cut(places)
        return _normalised(_marked(docs.select("doc_id", "text"), places).join(places, "doc_id"))

    comps = link_groups(distinct.select("id", "n", "d", "s", *_ODD, "wide"), shared, likely, None, fetch, _verified, with_previous, _met_by_key)
    grouped = found.join(comps.withColumnRenamed("node", "id"), "id", "left").select("doc_id", "line", F.coalesce("comp", "id").alias("comp"))
    firsts = grouped.groupBy("comp").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = grouped.join(firsts, "comp").where(F.col("first") != F.struct("doc_id", "line"))
    gone = cut(gone.groupBy("doc_id").agg(F.collect_list("line").alias("gone")))
    drop_written(spark, mark, keep=1)
    return gone


def _with_lines_left(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` with ``_tidewater_gone``, the numbers of its repeated lines (null: none), and ``_tidewater_text`` without them."""
    gone = gone.select(F.col("doc_id").alias("_tidewater_id"), F.col("gone").alias("_tidewater_gone"))
    rows = docs.join(gone, docs["doc_id"] == gone["_tidewater_id"], "left").drop("_tidewater_id")
    kept = lambda parts: F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_tidewater_gone"))
    left = lambda parts: F.array_join(F.transform(kept(parts), lambda k: F.element_at(parts, k + 1)), "\n")
    # As the variable of an outer transform, the text's lines are split once and not for each line kept.
    text = F.transform(F.array(F.split("text", "\n", -1)), left)[0]
    return rows.withColumn("_tidewater_text", F.when(F.col("_tidewater_gone").isNotNull(), text).otherwise(F.col("text")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, text): each text without lines whose group has an earlier one.

    Lines end at line feeds and order is by doc_id, then line. A null text stays null with 0 lines,
    an empty one has one empty line; lines under MIN_WORDS normalised words stay. Rows that repeat a
    doc_id count once, with their smallest text; rows with a null one pass unchanged. Texts and lines
    may be of any length.
    """
    docs = one_per_id(docs)
    rows = _with_lines_left(docs, repeated_lines(docs))
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1, F.lit(0)).cast("long")
    n_removed = F.coalesce(F.when(F.col("_tidewater_gone").isNotNull(), F.size("_tidewater_gone")), F.lit(0)).cast("long")
    return rows.select("doc_id", n_lines.alias("n_lines"), n_removed.alias("n_removed"), F.col("_tidewater_text").alias("text"))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that ``deduplicate`` gives, all other columns as they were.

    n_chars, if there, follows a changed text. Documents that lose all their words go; of rows that
    repeat a doc_id the one with the smallest text stays.
    """
    docs = first_rows(docs)
    rows = _with_lines_left(docs, repeated_lines(docs.select("doc_id", "text")))
    lost = F.col("_tidewater_gone").isNotNull()
    rows = rows.where(~lost | F.col("_tidewater_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("_tidewater_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(lost, F.length("_tidewater_text").cast(kind)).otherwise(F.col("n_chars"))
    return rows.select(*(new[c].alias(c) if c in new else docs[c] for c in docs.columns))
