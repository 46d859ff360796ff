"""Keyed state on disk: small changes per batch, merged when read, compacted bucket by bucket.

Keys are hashed to buckets. A batch writes a change file only in the buckets that its keys fall into:
``root/state_bucket=<k>/state_batch=<id>/state_kind=change``. A reader merges a bucket's last base with the changes after it.
Where a bucket has gathered enough changes, the batch also writes its base, all its keys' rows, and marks it
as whole with an empty file; only marked bases are read. A batch that comes again after a crash writes the
same folders over. Names and marks are all there is: a restart needs nothing in memory.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: Changes of a bucket from which it is compacted.
CHANGES = 8


class Layout(NamedTuple):
    """Batches that have changes, and the batches of whole bases, by bucket, and the time before which rows have expired."""

    changes: dict[int, list[int]]
    bases: dict[int, list[int]]
    cutoff: int | None


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(files, folder) -> list[str]:
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def _touch(spark: SparkSession, path: str) -> None:
    files, make = _files(spark, path)
    files.create(make(path), True).close()


def layout(spark: SparkSession, root: str, before: int | None = None) -> Layout:
    """What lies under ``root``, of batches before ``before`` if that is given: one listing a bucket."""
    files, path = _files(spark, root)
    changes, bases, cutoffs = defaultdict(list), defaultdict(list), []
    early = lambda batch: before is None or batch < before
    for bucket in (n for n in _names(files, path(root)) if n.startswith("state_bucket=")):
        k = int(bucket.removeprefix("state_bucket="))
        for name in _names(files, path(f"{root}/{bucket}")):
            batch = int(name.removeprefix("state_batch="))
            if early(batch) and files.exists(path(f"{root}/{bucket}/{name}/state_kind=change")):
                changes[k].append(batch)
    for mark in _names(files, path(f"{root}/_whole")):
        k, batch = map(int, mark.split("."))
        if early(batch):
            bases[k].append(batch)
    for mark in _names(files, path(f"{root}/_cutoff")):
        batch, cutoff = map(int, mark.split("."))
        if early(batch):
            cutoffs.append(cutoff)
    return Layout({k: sorted(v) for k, v in changes.items()}, {k: sorted(v) for k, v in bases.items()}, max(cutoffs, default=None))


def _merged(spark: SparkSession, root: str, there: Layout, keys: list[str], order: str, buckets: list[int] | None = None) -> DataFrame | None:
    """Each key's last row by ``order``, of equal ones the newer batch's, of all buckets or some."""
    from tidewater.operators.staging import keep_first

    files, path = _files(spark, root)
    paths = []
    for k in sorted(there.changes.keys() | there.bases.keys()) if buckets is None else buckets:
        base = there.bases.get(k, [-1])[-1]
        whole = f"{root}/state_bucket={k}/state_batch={base}/state_kind=base"
        paths += [whole] * (base >= 0 and files.exists(path(whole)))  # all its rows may have expired
        paths += [f"{root}/state_bucket={k}/state_batch={b}/state_kind=change" for b in there.changes.get(k, []) if b > base]
    if not paths:
        return None
    rows = spark.read.option("basePath", root).parquet(*paths)
    rows = keep_first(rows, ["state_bucket", *keys], [F.desc(order), F.desc("state_batch")])
    return rows if there.cutoff is None else rows.where(F.unix_micros("last_event_ts") >= there.cutoff)


def last_state(spark: SparkSession, root: str, keys: list[str] | None = None, order: str | None = None, before: int | None = None) -> DataFrame | None:
    """The state of all keys after the last batch, or before batch ``before``; None if there is none.

    Keys and order are those the state was written with; they are read from its folder unless given.
    """
    files, path = _files(spark, root)
    if keys is None or order is None:
        names = _names(files, path(f"{root}/_keys"))
        if not names:
            return None
        keys, order = names[0].split(".")[:-1], names[0].split(".")[-1]
    rows = _merged(spark, root, layout(spark, root, before), keys, order)
    return None if rows is None else rows.drop("state_bucket", "state_batch", "state_kind")


def upsert(batch: DataFrame, batch_id: int, root: str, keys: list[str], order: str, ttl: int | None = None, buckets: int = BUCKETS, changes: int = CHANGES) -> None:
    """Bring the state under ``root`` up to date with a batch: a change in each bucket that it has keys of.

    With ``ttl``, rows whose last_event_ts lies so many seconds before the newest one of any batch have
    expired: readers don't see them, and compaction leaves them out.
    """
    from tidewater.operators.staging import keep_first

    spark = batch.sparkSession
    rows = batch.withColumns({"state_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"), "state_batch": F.lit(batch_id), "state_kind": F.lit("change")})
    rows = keep_first(rows, ["state_bucket", *keys], [F.desc(order)]).persist()
    try:
        about = rows.agg(F.collect_set("state_bucket").alias("touched"), *([F.max(F.unix_micros("last_event_ts")).alias("newest")] if ttl is not None else [])).first()
        if not about.touched:
            return
        _touch(spark, f"{root}/_keys/{'.'.join((*keys, order))}")
        write = lambda d: d.repartition("state_bucket").write.partitionBy("state_bucket", "state_batch", "state_kind").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)
        write(rows)
        if ttl is not None and about.newest is not None:
            _touch(spark, f"{root}/_cutoff/{batch_id}.{about.newest - ttl * 1_000_000}")
    finally:
        rows.unpersist()
    there = layout(spark, root, batch_id + 1)
    full = [k for k in about.touched if len([b for b in there.changes.get(k, []) if b > there.bases.get(k, [-1])[-1]]) >= changes]
    if full:
        write(_merged(spark, root, there, keys, order, full).withColumns({"state_batch": F.lit(batch_id), "state_kind": F.lit("base")}))
        for k in full:
            _touch(spark, f"{root}/_whole/{k}.{batch_id}")
        _clean(spark, root, there, full)


def _clean(spark: SparkSession, root: str, there: Layout, buckets: list[int]) -> None:
    """Let go of what lies before the last base but one: a batch that comes again still finds what it began with."""
    files, path = _files(spark, root)
    for k in buckets:
        kept = there.bases.get(k, [-1])[-1]
        for batch in sorted({*there.changes.get(k, []), *there.bases.get(k, [])}):
            if batch < kept:
                files.delete(path(f"{root}/_whole/{k}.{batch}"), False)
                files.delete(path(f"{root}/state_bucket={k}/state_batch={batch}"), True)
