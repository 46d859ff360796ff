"""Ranks and running sums along one global order, without a task that holds all of it.

Rows are range-partitioned by the order, sorted and added up within their partition as they are written
once, each with the number of its partition. Sums of whole partitions, a row each, give what comes before
a partition. Where the order ends in a column that tells rows apart, rows of one value spread over
partitions like any others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.sources.lake import written

#: Rows that a task sorts, where their number is known.
ROWS = 1_000_000


def parts_of(spark: SparkSession, rows: int = 0) -> int:
    """How many partitions ``rows`` are dealt over: no fewer than a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-rows // ROWS))


def _placed(rows: DataFrame, order: list, parts: int | None) -> DataFrame:
    return rows.repartitionByRange(parts or parts_of(rows.sparkSession), *order)


def ranged(rows: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """``rows``, written, with ``_part``: all rows of a partition come before those of the next one by ``order``."""
    return written(_placed(rows, order, parts).withColumn("_part", F.spark_partition_id()), "ranged")


def _added(rows: DataFrame, values: list[str], sums: list[str]) -> DataFrame:
    """``rows`` with ``sums``, the ``values`` added up from the beginning of a partition."""
    schema = rows.select("*", *(F.col(v).alias(s) for v, s in zip(values, sums, strict=True))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = dict.fromkeys(values, 0)
        for batch in batches:
            if batch.num_rows:
                own = [np.cumsum(batch.column(v).to_numpy(zero_copy_only=False), dtype=np.int64) + done[v] for v in values]
                done = {v: int(a[-1]) for v, a in zip(values, own, strict=True)}
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, own)], names=[*batch.schema.names, *sums])

    return rows.mapInArrow(run, schema)


def running(rows: DataFrame, order: list, sums: dict[str, Column], by: tuple[str, ...] = (), parts: int | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``rows`` with each of ``sums`` added up to and including each row by ``order``, from zero in each group of ``by``.

    Values are whole numbers, null counts as zero. Rows that tie in ``order`` come in any order. Of the
    columns ``by`` and those of ``keep`` stay (all, without it); others aren't written. Groups are few: a
    row for each partition that a group has rows in is broadcast.
    """
    kept = list(dict.fromkeys([*by, *(rows.columns if keep is None else keep)]))
    values, own = [f"_value_{k}" for k in sums], [f"_own_{k}" for k in sums]
    placed = _placed(rows, [*by, *order], parts).sortWithinPartitions(*by, *order)
    placed = placed.select(*kept, F.spark_partition_id().alias("_part"), *(F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias(c) for c, v in zip(values, sums.values(), strict=True)))
    table = written(_added(placed, values, own), "running")
    whole = table.groupBy("_part", *by).agg(*(F.sum(v).alias(f"_{k}") for k, v in zip(sums, values, strict=True)))
    earlier = lambda w, k: F.coalesce(F.sum(f"_{k}").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = Window.partitionBy(*by).orderBy("_part")
    # A partition's own sums run on over its groups, which lie in it one after another.
    inside = Window.partitionBy("_part").orderBy(*by)
    offset = lambda k: earlier(before, k) - earlier(inside, k) if by else earlier(before, k)
    offsets = whole.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_{c}_") for c in by), *(offset(k).alias(f"_{k}") for k in sums))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in by), F.col("_part") == F.col("_p"))
    out = table.join(F.broadcast(offsets), same)
    return out.withColumns({k: F.col(f"_{k}") + F.col(f"_own_{k}") for k in sums}).select(*kept, *(k for k in sums if k not in kept))


def ranked(rows: DataFrame, strata: list[str], order: list, name: str = "rank", parts: int | None = None) -> DataFrame:
    """``rows`` with their rank, from 1, by ``order`` within each stratum."""
    return running(rows, order, {name: F.lit(1)}, tuple(strata), parts)
