"""Texts that travel, and pairs that are compared at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewater.llm import lines


@pytest.mark.parametrize("kind", ["long", "string"])
def test_documents_of_no_wanted_line_do_not_travel(spark, kind):
    docs = spark.range(4000).select(F.col("id").cast(kind).alias("doc_id"), F.lit("text").alias("text"))
    ids = docs.where("cast(doc_id AS long) % 40 = 0").select("doc_id")
    kept = {r.doc_id for r in lines._marked(docs, ids.union(ids)).collect()}
    assert kept >= {r.doc_id for r in ids.collect()} and len(kept) < 110


def test_pairs_of_many_batches_are_compared_at_once(spark):
    """More than an Arrow batch holds."""
    words = "one two three four five six seven eight nine ten".split()
    texts = [" ".join(words[:k] + [chr(97 + k)] * n + words[k + n :]).encode() for k in range(9) for n in (1, 2, 3)]
    rows = [(k, k + 10_000, b" ".join(map(str.encode, words)), texts[k % len(texts)]) for k in range(1500)]
    pairs = spark.createDataFrame(rows, "a long, b long, x binary, y binary").coalesce(1)
    got = {(r.a, r.b) for r in lines._verified(pairs).collect()}
    assert got == {(a, b) for a, b, x, y in rows if lines.edit_similar(x.split(), y.split())} and 0 < len(got) < 1500
