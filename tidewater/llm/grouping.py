"""Connected groups from buckets of candidates, without all pairs of a group.

``link_groups`` takes nodes that share a bucket as candidates. Each bucket first links its members
with one centre, its smallest member. What those links connect needs no further look: only members
of one bucket that are still in different groups are paired, so a bucket of n copies costs n pairs
and not n squared, and yet no link between groups is missed.

A bucket may be common to a large part of all nodes. Counting is pre-aggregated, members meet their
centre in salted pieces, and the members left to pair are dealt out in blocks, each two of which
meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, drop_written, written

#: Members of a bucket that one task takes.
PIECE = 4096


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the smallest node it reaches.

    Alternating large-star and small-star rounds: neighbours move to the smallest neighbour until
    every edge points at its group's minimum. No list of neighbours is gathered; a hub is a join
    key whose partition Spark can split.
    """
    spark = links.sparkSession
    mark = written()
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        drop_written(spark, mark, keep=1)
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows of ``buckets`` (id, key, ...) in buckets of more than one row, with the bucket's size n and its centre."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("centre")).where("n > 1")
    return buckets.join(sizes, "key")


def _paired(rows: DataFrame) -> DataFrame:
    """``rows`` (key, id, ...) with ``meet``: any two rows of a key agree in exactly one ``meet``.

    A key of few rows has one. A larger one is dealt out in blocks by hashed id; rows of blocks i and
    j meet as (i, j), rows of one block as (i, i), so that no task gets more than two blocks.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("blocks"))
    rows = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    place = lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))
    return rows.withColumn("meet", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), place))).drop("blocks")


def _joined(rows: DataFrame, likely: Callable[[str, str], Column], first: Callable[[str, str], Column] | None) -> DataFrame:
    """The likely pairs (a, b) of ``rows`` (key, meet, block, id, comp and the columns of nodes) that meet and are of two groups."""
    left = rows.select(*(F.col(c).alias(f"l_{c}") for c in rows.columns))
    right = rows.select(*(F.col(c).alias(f"r_{c}") for c in rows.columns))
    # Two rows of one block share every meet of that block: only (i, i) counts.
    once = (F.col("l_block") != F.col("r_block")) | (F.col("l_meet.i") == F.col("l_meet.j"))
    pairs = left.join(
        right,
        (F.col("l_key") == F.col("r_key"))
        & (F.col("l_meet") == F.col("r_meet"))
        & (F.col("l_id") < F.col("r_id"))
        & (F.col("l_comp") != F.col("r_comp"))
        & once
        & (first("l_", "r_") if first else F.lit(True))
        & likely("l_", "r_"),
    )
    return pairs.select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


def link_groups(
    nodes: DataFrame,
    shared: DataFrame,
    likely: Callable[[str, str], Column],
    first: Callable[[str, str], Column] | None,
    fetch: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame], DataFrame],
    mark: Callable[[DataFrame], DataFrame] | None = None,
    meet: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, comp) of all nodes that some link touches.

    nodes: (id, further columns); shared: (id, key, n, centre, further columns), as ``shared_buckets`` gives it, a table.
    A row of it without a key is a pair (id, centre) that is compared as it is; its id is in no bucket by that.
    Tables made on the way are deleted as soon as nothing reads them.
    ``likely(l, r)`` is a cheap condition on the further columns of two nodes, given their column
    prefixes; it must hold for every link. ``first(l, r)`` holds in just one of the buckets two nodes
    share, given also ``l_key``; it keeps a pair from being compared once per bucket; without it pairs
    are made distinct. ``fetch`` gives (id, payload) for the ids (id) that can be compared at all;
    ``verify`` keeps the true links (a, b) of pairs (a, b, x, y), x and y being the payloads.
    ``meet`` takes the place of the join that pairs a bucket's members and of ``first`` there: of rows of key, i, j, block, comp and
    the columns of nodes and ``shared`` it gives the likely pairs (a, b) of those that agree in (key, i, j), of two groups, and of two
    blocks where i <> j. ``mark`` adds columns to the members of buckets before that; they come dealt out by id.
    """
    spark = nodes.sparkSession
    ids = shared.select("id").union(shared.where("key is null").select("centre")).distinct()
    nodes = cut(nodes.join(ids, "id", "left_semi"))
    left = nodes.select(*(F.col(c).alias(f"l_{c}") for c in nodes.columns))
    right = nodes.select(*(F.col(c).alias(f"r_{c}") for c in nodes.columns))
    # A centre may have any number of members: they are dealt out by salt, and the centre is there for each salt.
    star = shared.where("id <> centre").groupBy("id", "centre").agg(F.max("n").alias("n"))
    salts = F.ceil(F.col("n") / PIECE).cast("int")
    copies = star.groupBy(F.col("centre").alias("_c")).agg(F.max(salts).alias("salts")).join(right, F.col("_c") == F.col("r_id"))
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    members = star.join(left, star["id"] == F.col("l_id")).withColumn("_s", F.pmod(F.xxhash64("id"), salts).cast("int"))
    star = members.join(copies, (F.col("centre") == F.col("_c")) & (F.col("_s") == F.col("_salt"))).where(likely("l_", "r_"))
    begin = written()
    star = cut(star.select(F.col("l_id").alias("a"), F.col("r_id").alias("b")))

    def verified(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        begin = written()
        payload = cut(fetch(ids))
        pairs = pairs.join(payload.select(F.col("id").alias("a"), F.col("payload").alias("x")), "a")
        links = cut(verify(pairs.join(payload.select(F.col("id").alias("b"), F.col("payload").alias("y")), "b")))
        drop_written(spark, begin, keep=1)
        return links

    comps = cut(connected_components(verified(star)))
    drop_written(spark, begin, keep=1)

    grouped = shared.where("key is not null").drop("n", "centre").join(comps.withColumnRenamed("node", "id"), "id", "left")
    grouped = grouped.withColumn("comp", F.coalesce("comp", "id"))
    mixed = grouped.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    begin = written()
    open_rows = _paired((mark(grouped) if mark else grouped).join(mixed, "key")).join(nodes, "id")
    if meet:
        pairs = meet(open_rows.select("*", "meet.i", "meet.j").drop("meet"))
    else:
        pairs = _joined(cut(open_rows), likely, first)
    pairs = cut(pairs if first else pairs.distinct())
    drop_written(spark, begin, keep=1)
    more = verified(pairs)
    # The groups found so far stand for their members.
    seen = comps.select(F.col("node").alias("a"), F.col("comp").alias("b"))
    return connected_components(seen.union(more))
