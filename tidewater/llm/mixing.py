"""Mixing sources to target weights with a time-varying curriculum.

Targets share a budget of words by weight, up to ``REPEATS`` times a source's size; what a source
can't give is shared out again by weight. A source's weight may change over training, linearly from
(1 + tilt) to (1 - tilt) times its mean: its cumulative demand after the fraction t of training is
the integral of that schedule, and the occurrence that ends at the share c of the source's target
is due when demand reaches c, so inverting the integral gives the training position. Documents of a
source come in an order that hashes their ids, again from the start once it is used up.

Cumulative sizes within a source need no task that sees the whole source: a document's place is its
bucket's offset (a small sum over buckets) plus its rank inside the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut, first_rows

#: Fixed weights of the sources in code-point order, over and over.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
REPEATS = 2
#: How far the schedule of each of those weights tilts to the start of training (negative: to its end).
TILTS = (-0.5, 0.0, 0.5)
#: Documents of a bucket, about.
BUCKET_DOCS = 4096
_WORDS = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): words of whole texts; null texts have none."""
    # Dropping all but the first character of each word leaves as many characters as there are words.
    firsts = F.regexp_replace("text", r"[\x20\x09-\x0D]*([^\x20\x09-\x0D])[^\x20\x09-\x0D]*[\x20\x09-\x0D]*", "x")
    blank = F.regexp_replace("text", r"[\x20\x09-\x0D]+", "") == ""
    size = F.when(F.col("text").isNull() | blank, 0).otherwise(F.length(firsts)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, tilt, target): one row a source.

    Sources are a small table: one row each, however many documents. Sorted by how soon they fill,
    the level of words per weight follows from running sums: a source that would get more than its
    limit at the level of those not yet full gets its limit.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    nth = (F.row_number().over(place) - 1) % len(WEIGHTS)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (nth + 1).cast("int"))
    totals = totals.select("source", "source_size", pick(WEIGHTS).alias("weight"), pick(TILTS).alias("tilt"))
    limit = F.col("source_size") * REPEATS
    order = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    budget = F.sum("source_size").over(whole) * BUDGET
    level = (budget - F.coalesce(F.sum(limit).over(before), F.lit(0))) / F.sum("weight").over(after)
    filled = totals.withColumn("limit", limit).withColumn("level", level)
    # The first source that does not fill sets the level of all that follow; levels fall from there on.
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(whole)
    share = F.coalesce(F.col("weight") * F.col("open_level"), F.col("limit").cast("double"))
    return filled.withColumn("open_level", open_level).select(
        "source", "source_size", "weight", "tilt", F.least(F.col("limit").cast("double"), share).alias("target")
    )


def position(share: Column, tilt: Column) -> Column:
    """When a source's demand reaches ``share`` of its target: the integral (1 + k) t - k t**2 inverted."""
    root = F.sqrt(F.greatest((1 + tilt) * (1 + tilt) - 4 * tilt * share, F.lit(0.0)))
    return F.when(tilt == 0, share).otherwise((1 + tilt - root) / (2 * tilt) + 0.0)


#: Buckets whose sums one task adds up.
GROUP_DIGITS = 3


def _offsets(sums: DataFrame) -> DataFrame:
    """(s, b, offset): words of a source in buckets before ``b``; groups of buckets are added up first, then buckets within each."""
    sums = sums.withColumn("g", F.expr(f"substring(bucket, 1, greatest(0, length(bucket) - {GROUP_DIGITS}))"))
    groups = sums.groupBy("source", "g").agg(F.sum("n").alias("n"))
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col("source").alias("s"), F.col("g").alias("h"), F.coalesce(F.sum("n").over(earlier("source", "g")), F.lit(0)).alias("before"))
    inner = sums.withColumn("within", F.coalesce(F.sum("n").over(earlier("source", "g", "bucket")), F.lit(0)))
    both = inner.join(groups, F.col("source").eqNullSafe(F.col("s")) & (F.col("g") == F.col("h")))
    return both.select("s", F.col("bucket").alias("b"), (F.col("before") + F.col("within")).alias("offset"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, positions): how often, and when, each document is used.

    Each source takes its target rounded to whole words: all of its documents once for each whole
    multiple of its size, then, in hashed order, documents until the rest is used; only the last of
    these is taken in part. ``positions`` has the training position, 0 to 1, of each occurrence.
    Rows are kept as they are: repeated ids are further documents, null sources a source of their
    own, null and empty texts have size 0 and take nothing. Without any words all targets are 0.
    """
    # Texts are read once; all else works on the small table of sizes.
    sized = cut(sizes(docs))
    # As many buckets a source as keep all of them small, however large the largest source is: a power of 16, so that buckets sort as hashes do.
    most = sized.groupBy("source").count().agg(F.max("count")).first()[0] or 1
    digits = 1
    while 16**digits * BUCKET_DOCS < most:
        digits += 1
    bucket = F.substring("h", 1, digits)
    # Rows that agree in all of these are interchangeable.
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("bucket", bucket).withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    sums = cut(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n")))
    offsets = _offsets(sums)
    goals = targets(sized).withColumnRenamed("source", "g")
    placed = rows.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    placed = placed.join(goals, F.col("source").eqNullSafe(F.col("g")))
    begin = F.col("offset") + F.col("inner")
    goal = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, (goal / F.col("source_size")).cast("long")).otherwise(F.lit(0).cast("long"))
    placed = placed.withColumn("begin", begin).withColumn("goal", goal).withColumn("epochs", epochs)
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("goal") - F.col("epochs") * F.col("source_size") - F.col("begin")))
    taken = F.col("epochs") * F.col("size") + last
    uses = F.when(F.col("size") == 0, 0).otherwise(F.col("epochs") + (last > 0).cast("long"))
    share = lambda k: (k * F.col("source_size") + F.col("begin")) / F.col("goal").cast("double")
    positions = F.when(uses > 0, F.transform(F.sequence(F.lit(0).cast("long"), uses - 1), lambda k: position(share(k), F.col("tilt")))).otherwise(F.array().cast("array<double>"))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", positions.alias("positions"))


def curriculum(docs: DataFrame) -> DataFrame:
    """``docs`` in training order: one row an occurrence, with ``taken`` and ``position``, range-sorted by position.

    ``taken`` is the document's words over all its occurrences; columns of ``docs`` that are named
    ``taken`` or ``position`` are replaced. A document that isn't taken goes;
    of rows that repeat a doc_id the one with the smallest text counts. Rows with a null doc_id all
    count, each for itself: it is told from others by its place in the order of its columns' hash.
    """
    docs = first_rows(docs)
    # Nulls get a number each, so that no two of them meet in the join.
    columns = [F.col(c).cast("string") for c in ("text", "source") if c in docs.columns]
    nameless = docs.where(F.col("doc_id").isNull()).withColumn("_tidewater_key", F.xxhash64(*columns))
    same = Window.partitionBy("_tidewater_key").orderBy(*columns)
    nameless = nameless.withColumn("_tidewater_key", F.concat_ws(":", F.lit("null"), "_tidewater_key", F.row_number().over(same)))
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("_tidewater_key", F.col("doc_id").cast("string"))
    keyed = cut(named.unionByName(nameless))
    plan = mix(keyed.select(F.col("_tidewater_key").alias("doc_id"), "text", "source")).where("taken > 0")
    plan = plan.select(F.col("doc_id").alias("_tidewater_key"), "taken", F.explode("positions").alias("position"))
    plain = keyed.select("_tidewater_key", *(c for c in docs.columns if c not in ("taken", "position")))
    out = plain.join(plan, "_tidewater_key").drop("_tidewater_key")
    return out.repartitionByRange("position").sortWithinPartitions("position", "doc_id")
