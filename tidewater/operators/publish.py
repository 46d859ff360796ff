"""Versioned feature tables: shards, activation by pointer, rollback, retention and audit.

A version is a Parquet partition written whole; readers go through a one-row pointer table that is
overwritten last, so they see all of one version or all of another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.scalars import hash_shard
from tidewater.operators.quality import latest
from tidewater.sources.lake import read_or_empty


def with_shards(rows: DataFrame, key: str, shards: int) -> DataFrame:
    return rows.withColumn("shard_id", hash_shard(F.col(key), shards))


def publish(rows: DataFrame, root: str, version: str, key: str, shards: int) -> DataFrame:
    """Write a version, a folder a shard; the same input gives the same folders, so a retry just overwrites."""
    out = with_shards(rows, key, shards).withColumn("feature_version", F.lit(version))
    out.repartition("shard_id").write.partitionBy("feature_version", "shard_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)
    return rows.sparkSession.read.parquet(root).where(F.col("feature_version") == version)


def pending_shards(planned: DataFrame, done: DataFrame) -> DataFrame:
    """Shards of a plan that no successful attempt has finished."""
    finished = done.where("status = 'success'").select("feature_version", "shard_id")
    return planned.join(finished, ["feature_version", "shard_id"], "left_anti")


SHARD_LOG = "status string, rows_written long, attempt int, updated_at timestamp, feature_version string, shard_id int"


def shard_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of shard attempts; each attempt is a file in its shard's own folder, and that file is the shard's commit."""
    return read_or_empty(spark, path, SHARD_LOG)


def resume(rows: DataFrame, root: str, log: str, version: str, key: str, shards: int, at_once: int = 16, after: Callable[[list[int]], None] | None = None) -> list[int]:
    """Publish the shards of a version that the log doesn't have as done, ``at_once`` in a job; the numbers of those written.

    A job overwrites its shards' folders whole, then a log row a shard commits them, so a run that dies
    costs the shards of one job: the next one goes on with what is pending and counts their attempt up.
    ``rows`` should be a table, as each job reads it. ``after`` is called when a job's shards are
    committed.
    """
    spark = rows.sparkSession
    planned = spark.range(shards).select(F.lit(version).alias("feature_version"), F.col("id").cast("int").alias("shard_id"))
    pending = sorted(r.shard_id for r in pending_shards(planned, shard_log(spark, log)).collect())
    written: list[int] = []
    for begin in range(0, len(pending), at_once):
        now = pending[begin : begin + at_once]
        ours = spark.createDataFrame([(version, k) for k in now], "feature_version string, shard_id int")
        tries = shard_log(spark, log).groupBy("feature_version", "shard_id").agg(F.max("attempt").alias("tried"))
        started = ours.join(tries, ["feature_version", "shard_id"], "left").withColumn("attempt", F.coalesce("tried", F.lit(0)) + 1).drop("tried")
        started = spark.createDataFrame(started.collect(), "feature_version string, shard_id int, attempt int")  # at_once rows
        _log_shards(started.withColumns({"status": F.lit("started"), "rows_written": F.lit(None).cast("long")}), log)
        part = with_shards(rows, key, shards).where(F.col("shard_id").isin(now)).withColumn("feature_version", F.lit(version))
        part.repartition("shard_id").write.partitionBy("feature_version", "shard_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)
        there = spark.read.parquet(root).where((F.col("feature_version") == version) & F.col("shard_id").isin(now)).groupBy("shard_id").agg(F.count("*").alias("rows_written"))
        _log_shards(started.join(there, "shard_id", "left").withColumns({"status": F.lit("success"), "rows_written": F.coalesce("rows_written", F.lit(0).cast("long"))}), log)
        written += now
        if after:
            after(now)
    return written


def _log_shards(rows: DataFrame, log: str) -> None:
    rows = rows.withColumn("updated_at", F.current_timestamp()).select("status", "rows_written", "attempt", "updated_at", "feature_version", "shard_id")
    rows.repartition("shard_id").write.partitionBy("feature_version", "shard_id").mode("append").parquet(log)


def record(log: str, kind: str, keys: DataFrame, status: str, at: Column | None = None) -> None:
    """Append (kind, key, status, updated_at) rows of runs, syncs or shards to an audit log; ``audit_state`` tells where each stands."""
    rows = keys.select(F.lit(kind).alias("kind"), F.col(keys.columns[0]).cast("string").alias("key"), F.lit(status).alias("status"), (F.current_timestamp() if at is None else at).alias("updated_at"))
    rows.write.mode("append").parquet(log)


def activatable(syncs: DataFrame) -> DataFrame:
    """Versions that are validated and whole."""
    return latest(syncs, ["feature_version"], [F.desc("finished_at")]).where("status = 'validated' AND completed_shards = total_shards")


def activate(spark: SparkSession, pointer_path: str, version: str, at: str, current: DataFrame | None) -> str | None:
    """Point readers at ``version``; gives the version that was active before."""
    before = current.first() if current is not None else None
    previous = before.active_version if before else None
    row = spark.createDataFrame([(version, previous, at)], "active_version string, previous_version string, activated_at string")
    row.coalesce(1).write.mode("overwrite").parquet(pointer_path)
    return previous


def active_version(syncs: DataFrame) -> DataFrame:
    """The version activated last."""
    live = syncs.where(F.col("activated_at").isNotNull())
    return live.agg(F.max_by("feature_version", F.struct("activated_at", "feature_version")).alias("feature_version"), F.max("activated_at").alias("activated_at"))


def rollback_target(syncs: DataFrame, pointer: DataFrame) -> DataFrame:
    """The newest version, other than the active one, that has been active before."""
    others = syncs.where(F.col("activated_at").isNotNull()).join(pointer, syncs["feature_version"] == pointer["active_version"], "left_anti")
    return active_version(others)


def expired(versions: DataFrame, pointer: DataFrame, keep: int) -> DataFrame:
    """Versions beyond the newest ``keep`` that aren't active."""
    nth = F.row_number().over(Window.orderBy(F.desc("created_at"), F.desc("feature_version")))
    old = versions.withColumn("nth", nth).where(F.col("nth") > keep).drop("nth")
    return old.join(pointer, old["feature_version"] == pointer["active_version"], "left_anti")


def delete_versions(spark: SparkSession, root: str, versions: list[str]) -> None:
    """Remove version folders through the file system that holds them."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for v in versions:
        folder = path(f"{root}/feature_version={v}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def retire(syncs: DataFrame, keep: DataFrame) -> DataFrame:
    """Sync rows of versions not in ``keep``, with status retired."""
    return syncs.join(keep.select("feature_version"), "feature_version", "left_anti").withColumn("status", F.lit("retired"))


def shard_totals(syncs: DataFrame, shards: DataFrame) -> DataFrame:
    """Sync rows with their shards' totals; the latest attempt of each shard counts."""
    now = latest(shards, ["feature_version", "shard_id"], [F.desc("updated_at"), F.desc("attempt")])
    sums = now.groupBy("feature_version").agg(F.count_if(F.col("status") == "success").alias("completed_shards"), F.sum(F.when(F.col("status") == "success", F.col("rows_written"))).alias("written_rows"))
    base = syncs.drop("completed_shards", "written_rows")
    return base.join(sums, "feature_version", "left").na.fill(0, ["completed_shards", "written_rows"])


def progress(syncs: DataFrame) -> DataFrame:
    done = F.round(100.0 * F.col("completed_shards") / F.nullif(F.col("total_shards"), F.lit(0)), 2)
    return syncs.withColumn("percent", done)


def audit_state(log: DataFrame, keys: list[str]) -> DataFrame:
    """An append-only log's current state: the latest row of each key, and how many there were."""
    tries = log.groupBy(*keys).agg(F.count("*").alias("attempts"))
    return latest(log, keys, [F.desc("updated_at")]).join(tries, keys)


def recent(log: DataFrame, n: int, *order: Column) -> DataFrame:
    """The last ``n`` rows of a log by ``order``."""
    return log.orderBy(*order).limit(n)


def latest_sync_shards(syncs: DataFrame, shards: DataFrame, order: str = "started_at") -> DataFrame:
    """The current state of the shards of the sync that is last by ``order``; its row is the only one broadcast."""
    last = syncs.agg(F.max_by("feature_version", F.struct(order, "feature_version")).alias("feature_version"))
    now = latest(shards, ["feature_version", "shard_id"], [F.desc("updated_at"), F.desc("attempt")])
    return now.join(F.broadcast(last), "feature_version")


def latest_partition(rows: DataFrame, asked: str) -> DataFrame:
    """The asked day if it has rows, or else the latest day there is."""
    day = F.to_date(F.lit(asked))
    return rows.agg(F.coalesce(F.max(F.when(F.col("dt") == day, F.col("dt"))), F.max("dt")).alias("dt"))


def serve(pointer: DataFrame, published: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """Rows of the active version with the overlay's columns where there are any."""
    live = published.join(F.broadcast(pointer.select(F.col("active_version").alias("feature_version")).limit(1)), "feature_version")
    return live.join(overlay, key, "left")


def sample_keys(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The n keys whose hashes come first: the same ones whenever they are asked for."""
    return rows.select(key).distinct().orderBy(F.sha2(F.col(key).cast("string"), 256)).limit(n)
