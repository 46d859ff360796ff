"""Shuffle files of a written table are not kept."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidewater.llm.common import cut


def _shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(blocks.size()) if (name := blocks.apply(k).getName()).startswith("shuffle_")}


def test_shuffles_go_as_a_table_is_written(spark):
    rows = spark.range(20_000).withColumn("key", F.col("id") % 5000)
    before = _shuffle_files(spark)
    several = rows.groupBy("key").agg(F.max("id").alias("last")).where("last > 10")
    assert cut(rows.join(several.hint("merge"), "key")).count() == 20_000
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.5)
    # The count's own shuffle, of one row a task, is all that may be there.
    assert len(left) <= 4
