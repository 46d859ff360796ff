"""Benchmark decontamination by Wu-Manber search over words.

The patterns are a benchmark's windows: 10 consecutive words of an item, or the whole of a shorter
one. Patterns of one length are searched together. At a position the last two words of the text's
window form a block; the shift table says how far the window can move because no pattern holds
that block nearer its end, so most positions are skipped unread. Where the shift is 0 the block's
bucket, split by the patterns' first block, gives the few patterns to compare word by word.

Patterns are searched in blocks of items of bounded size, each in one pass over the documents, so
neither the driver nor a task holds more of a benchmark than ``BLOCK_CHARS``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, map_batches, small_batches

WINDOW = 10
#: Characters of benchmark text that one pass over the documents searches for.
BLOCK_CHARS = 8_000_000
#: Lower-case letters, digits and all beyond ASCII stand for themselves; the rest parts words.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split() if text else []


#: The last matcher that this worker has built, by the name of its block: tasks that follow use it again.
_built: dict[str, tuple] = {}


def _prepared(name: str, make: Callable[[], tuple]) -> tuple:
    if name not in _built:
        _built.clear()
        _built[name] = make()
    return _built[name]


class Matcher:
    """Wu-Manber tables of word sequences; of each sequence the numbers of the items that hold it."""

    def __init__(self, items: list[list[bytes]], window: int = WINDOW):
        patterns: dict[int, dict[tuple, list[int]]] = {}
        for number, item in enumerate(items):
            n = min(window, len(item))
            for at in range(len(item) - n + 1) if n else ():
                holders = patterns.setdefault(n, {}).setdefault(tuple(item[at : at + n]), [])
                if not holders or holders[-1] != number:
                    holders.append(number)
        self.tables = [self._table(n, found) for n, found in sorted(patterns.items())]

    @staticmethod
    def _table(n: int, patterns: dict) -> tuple:
        block = min(2, n)
        shift: dict[tuple, int] = {}
        buckets: dict[tuple, dict[tuple, list]] = {}
        for pattern, holders in patterns.items():
            for end in range(block, n + 1):
                key = pattern[end - block : end]
                shift[key] = min(shift.get(key, n), n - end)
            buckets.setdefault(pattern[n - block :], {}).setdefault(pattern[:block], []).append((pattern, holders))
        return n, block, shift, buckets

    def search(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word intervals of the occurrences, joined where they meet, and the numbers of the items found."""
        edge: dict[int, int] = {}
        items: set[int] = set()
        for n, block, shift, buckets in self.tables:
            default = n - block + 1
            end = n
            while end <= len(text):
                key = tuple(text[end - block : end])
                move = shift.get(key, default)
                if move:
                    end += move
                    continue
                begin = end - n
                for pattern, holders in buckets[key].get(tuple(text[begin : begin + block]), ()):
                    if tuple(text[begin:end]) == pattern:
                        edge[begin] = max(edge.get(begin, 0), end)
                        items.update(holders)
                end += 1
        return joined(edge.items()), items


def joined(intervals) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(intervals):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


def _search(docs: DataFrame, items: list[tuple]) -> DataFrame:
    """(doc_id, h, n_words, spans, items) of one block of items; h hashes the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(items)
    block = uuid.uuid4().hex

    def start():
        names, matcher = _prepared(block, lambda: ([None if i is None else str(i) for i, _ in shared.value], Matcher([words(t) for _, t in shared.value])))

        def step(ids, hashes, texts):
            out = [ids, hashes, [], [], []]
            for text in texts:
                parts = words(text)
                spans, found = matcher.search(parts)
                out[2].append(len(parts))
                out[3].append([{"begin": b, "end": e} for b, e in spans])
                out[4].append(sorted({names[k] for k in found} - {None}))
            return out

        return step

    hashed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    schema = f"doc_id {kind}, h bigint, n_words bigint, spans array<struct<begin:int,end:int>>, items array<string>"
    return map_batches(hashed, ["doc_id", "h", "text"], schema, start)


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The benchmark's items in as many blocks as its characters need, one at a time."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(blocks))
    for k in range(blocks):
        yield [tuple(r) for r in items.where(block == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans) of whole documents.

    A word is hit if it lies in an occurrence of a window of ``benchmark`` (item_id, text); spans are
    the hit intervals by word number; items those with occurring windows, as their ids' text,
    sorted. Null and empty texts have no words, nothing found gives the hash of the empty string.
    An item with a null id hits words and isn't listed. Rows that agree in doc_id and text give as many
    rows as they are, however many blocks a benchmark needs; texts may be of any length.
    """
    docs = docs.select("doc_id", "text")
    found = [_search(docs, items) for items in _blocks(benchmark, block_chars)]
    if len(found) > 1:
        # Equal rows have equal results: their number comes back as copies of one.
        rows = reduce(DataFrame.union, [f.withColumn("block", F.lit(k)) for k, f in enumerate(found)]).groupBy("doc_id", "h")
        copies = F.count_if(F.col("block") == 0).alias("copies")
        merged = rows.agg(copies, F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        # Blocks' intervals may overlap: the hit words of a document are counted once.
        words_of = F.transform("spans", lambda s: F.sequence(s["begin"], s["end"] - 1))
        hit = F.size(F.array_distinct(F.flatten(words_of)))
        merged = merged.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    else:
        merged = found[0]
        hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"])
    return merged.select(
        "doc_id",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
    )


def _clean_text(shared: Broadcast) -> Callable[[Column], Column]:
    block = uuid.uuid4().hex

    @F.pandas_udf("boolean")
    def clean_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        (matcher,) = _prepared(block, lambda: (Matcher([words(t) for t in shared.value]),))
        for texts in batches:
            yield pd.Series([not (isinstance(t, str) and matcher.search(words(t))[0]) for t in texts], dtype=bool)

    return clean_text


def clean(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without documents in which a window occurs, all columns as they were; null and empty texts stay.

    Nothing is joined or shuffled: every block of items is one filter on the text.
    """
    small_batches(docs.sparkSession)
    for nth, items in enumerate(_blocks(benchmark, block_chars)):
        if nth:
            docs = cut(docs)  # one matcher in a worker's memory at a time
        clean_text = _clean_text(docs.sparkSession.sparkContext.broadcast([t for _, t in items]))
        docs = docs.where(clean_text("text"))
    return docs
