"""Lineage of generation runs: a tree stored as parent pointers.

Ways up are followed by doubling: a table of jumps of 2^k steps is joined with itself, so a way of depth d
takes log2(d) rounds. Each round is written, which keeps plans short and lets lost executors read a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.lake import written

MAX_DEPTH = 64


def _known(runs: DataFrame) -> DataFrame:
    """``runs`` with ``up``, the parent where that is itself a run."""
    parents = runs.select(F.col("run_id").alias("parent_run_id"), F.col("run_id").alias("up")).distinct()
    return runs.where("parent_run_id IS NOT NULL").join(parents, "parent_run_id", "left").select(*runs.columns, "up").unionByName(runs.where("parent_run_id IS NULL").withColumn("up", F.lit(None).cast("string")))


def ends(runs: DataFrame) -> DataFrame:
    """(start_run, top, depth, is_cycle, all_real), a row a run: where its way up ends, and whether all runs on it are real.

    Only open ways are joined in a round; the others are set aside. Where no way ends in a round, each open
    one stands at another open one and none will ever end: they go round in cycles. Their top is null, their
    depth the number of steps after which a run comes again, as far as MAX_DEPTH.
    """
    spark = runs.sparkSession
    first = _known(runs.select("run_id", "parent_run_id", "source_type"))
    state = first.select(F.col("run_id").alias("run"), "up", F.col("run_id").alias("top"), F.lit(1).cast("long").alias("steps"), F.coalesce(F.col("source_type") == "real", F.lit(False)).alias("real"))
    state, last = written(state, "ends"), -1
    while (going := state.where("up IS NOT NULL").count()) not in (0, last):
        last, open_ways = going, state.where("up IS NOT NULL")
        jump = state.select(F.col("run").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"), F.col("steps").alias("_steps"), F.col("real").alias("_real"))
        moved = open_ways.join(jump, "up").select("run", F.col("_up").alias("up"), F.col("_top").alias("top"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("real") & F.col("_real")).alias("real"))
        state = written(state.where("up IS NULL").unionByName(moved), "ends")
    ended = state.where("up IS NULL").select(F.col("run").alias("start_run"), "top", (F.col("steps") - 1).cast("int").alias("depth"), F.lit(False).alias("is_cycle"), F.col("real").alias("all_real"))
    if not going:
        return ended
    cyclic = state.where("up IS NOT NULL").select(F.col("run").alias("run_id"))
    # All that a cyclic way meets is cyclic too, so these runs are walked among themselves.
    turns = walk(spark, runs.join(cyclic, "run_id", "left_semi")).groupBy("start_run")
    turns = turns.agg(F.max("depth").alias("depth"), F.bool_and(F.coalesce(F.col("source_type") == "real", F.lit(False))).alias("all_real"))
    return ended.unionByName(turns.select("start_run", F.lit(None).cast("string").alias("top"), "depth", F.lit(True).alias("is_cycle"), "all_real"))


def walk(spark: SparkSession, runs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(start_run, run, depth, path, is_cycle, source_type, root): every run's way up to its root, a row a step.

    A way that comes back to a run it has seen is flagged and goes no further. For ends, cycles and roots
    alone ``ends`` is enough, which has a row a run.
    """
    known = written(_known(runs.select("run_id", "parent_run_id", "source_type", "root_run_id")), "walk")
    ways = known.select(F.col("run_id").alias("start_run"), F.col("run_id").alias("run"), F.lit(0).alias("depth"), F.array("run_id").alias("path"))
    jumps = known.where("up IS NOT NULL").select("run_id", "up", F.array("run_id").alias("before"))
    length = 1
    while length <= max_depth + 1 and not jumps.isEmpty():
        onward = ways.withColumnRenamed("start_run", "up")
        further = jumps.join(onward, "up").select(F.col("run_id").alias("start_run"), "run", (F.col("depth") + length).alias("depth"), F.concat("before", "path").alias("path"))
        again = jumps.select(F.col("run_id").alias("up"), F.col("up").alias("_up"), F.col("before").alias("_before"))
        double = jumps.join(again, "up").select("run_id", F.col("_up").alias("up"), F.concat("before", "_before").alias("before"))
        fresh = further.where((F.col("depth") <= max_depth) & (F.size(F.array_distinct(F.slice("path", 1, F.col("depth")))) == F.col("depth")))
        ways = written(ways.unionByName(fresh), "walk")
        # Where a run comes again on a jump, nothing that lies beyond it counts.
        jumps = written(double.where(F.size(F.array_distinct("before")) == F.size("before")), "walk")
        length *= 2
    seen = F.array_contains(F.slice("path", 1, F.col("depth")), F.col("run"))
    about = known.select(F.col("run_id").alias("run"), "source_type", F.col("root_run_id").alias("root"))
    return ways.join(about, "run").select("start_run", "run", "depth", "path", seen.alias("is_cycle"), "source_type", "root")


def cycles(ended: DataFrame) -> DataFrame:
    return ended.where("is_cycle").select("start_run")


def wrong_roots(runs: DataFrame, ended: DataFrame) -> DataFrame:
    """Runs whose declared root isn't the run their way up ends in."""
    own = runs.select(F.col("run_id").alias("start_run"), F.col("root_run_id").alias("root"))
    return ended.join(own, "start_run").where("NOT is_cycle AND NOT (root <=> top)").select("start_run", "root", "top")


def real_roots(ended: DataFrame) -> DataFrame:
    """Runs all of whose ancestors, themselves included, are real."""
    return ended.where("all_real").select("start_run", "depth")


def ineligible(runs: DataFrame) -> DataFrame:
    """Rows that break a row rule: a run that is its own parent, or a real one made by a run that isn't."""
    parent = runs.select(F.col("run_id").alias("parent_run_id"), F.col("source_type").alias("parent_type"))
    rows = runs.join(parent, "parent_run_id", "left")
    own = F.col("run_id") == F.col("parent_run_id")
    mixed = (F.col("source_type") == "real") & (F.col("parent_type") != "real")
    reason = F.when(own, "self_parent").when(mixed, "real_from_synthetic")
    return rows.select("run_id", reason.alias("reason")).where(F.col("reason").isNotNull())
