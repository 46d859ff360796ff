"""Reading and writing lake tables: CSV and Parquet sources, partitioned and replay-safe sinks."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scalars import derived_user_id, hash_shard

FEATURES = [f"f{i}" for i in range(83)]

#: The columns of the event lake.
EVENT_SCHEMA = (
    "event_id string, user_id string, event_type string, event_ts double, session_id string, platform string, item_id string,"
    " category_id string, price double, quantity int, schema_version int, ingested_at double, kafka_partition int, kafka_offset long"
)
CSV_SCHEMA = "data_id string, label int, is_treat int, " + ", ".join(f"{f} double" for f in FEATURES)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, under ``spark.checkpoint.dir``; a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"spark-{name}-", dir="/tmp")


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in a scratch folder: what follows reads it and doesn't compute them again, whatever is lost."""
    path = scratch(rows.sparkSession, name)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_csv_split(spark: SparkSession, path: str, split: str, dt: str, row_limit: int | None = None) -> DataFrame:
    """One CSV split with header, as snapshot rows: derived user id, split, partition date and feature time."""
    rows = spark.read.csv(path, header=True, schema=CSV_SCHEMA)
    if row_limit is not None:
        rows = rows.limit(row_limit)
    day = F.to_date(F.lit(dt))
    return rows.select(
        derived_user_id(F.col("data_id")).alias("user_id"),
        "*",
        F.lit(split).alias("split"),
        F.to_timestamp(day).alias("feature_ts"),
        day.alias("dt"),
    )


def load_splits(spark: SparkSession, paths: dict[str, str], dt: str, row_limit: int | None = None) -> DataFrame:
    """All splits that exist, as one set; a path that is missing or holds no rows is skipped."""
    found = []
    for split, path in paths.items():
        try:
            rows = read_csv_split(spark, path, split, dt, row_limit)
            if not rows.isEmpty():
                found.append(rows)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        raise FileNotFoundError(f"no split to load among {sorted(paths)}")
    return reduce(DataFrame.unionByName, found)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet under ``path`` as ``schema``, or no rows of it where nothing is there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def by_shard(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """``rows`` written with a folder a shard, in ``_shard``, so that a shard's reader opens no other."""
    path = scratch(rows.sparkSession, "shards")
    rows.withColumn("_shard", hash_shard(F.col(key), shards)).repartition("_shard").write.partitionBy("_shard").parquet(path)
    return rows.sparkSession.read.parquet(path)


def shard(rows: DataFrame, key: str, shard_id: int, shards: int, columns: list[str]) -> DataFrame:
    """One of ``shards`` disjoint parts by hashed key, with only the columns asked for; of a table from ``by_shard``, its folder alone."""
    own = F.col("_shard") if "_shard" in rows.columns else hash_shard(F.col(key), shards)
    return rows.where(own == shard_id).select(*columns)


def members(rows: DataFrame, ids: DataFrame, key: str, day: str | None = None) -> DataFrame:
    """Rows of the keys that ``ids`` lists, of one partition day if it is given."""
    rows = rows if day is None else rows.where(F.col("dt") == F.to_date(F.lit(day)))
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def append(rows: DataFrame, path: str) -> None:
    """Add rows to a log; what is there stays."""
    rows.write.mode("append").parquet(path)


def land_counted(rows: DataFrame, root: str, by: list[str]) -> int:
    """Write to a root of its own and count what can be read back; fails if that isn't what was given."""
    write_partitions(rows, root, by)
    given, there = rows.count(), rows.sparkSession.read.parquet(root).join(rows.select(*by).distinct(), by, "left_semi").count()
    if given != there:
        raise ValueError(f"{root}: {given} rows given, {there} landed")
    return there


def write_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite just the partitions that ``rows`` holds; other partitions stay."""
    rows.repartition(*by).write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").option("compression", "snappy").mode("overwrite").parquet(path)


def compact(landed: DataFrame, key: str, order: str, target_files: int = 1) -> DataFrame:
    """An hour's small files as few, one row a key, the first by ``order``."""
    from tidewater.operators.staging import keep_first

    return keep_first(landed, [key], [order]).coalesce(target_files)


def offset_conflicts(landed: DataFrame, replayed: DataFrame) -> DataFrame:
    """Replayed rows whose place in the log is taken by another payload; a replay with none is safe to write again."""
    place = ["kafka_partition", "kafka_offset"]
    payload = [c for c in landed.columns if c not in (*place, "ingested_at")]
    hashed = lambda d: d.select(*place, F.xxhash64(*payload).alias("payload"))
    ours = hashed(landed).withColumnRenamed("payload", "landed_payload")
    return hashed(replayed).join(ours, place).where("payload <> landed_payload")


def reconcile_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(table_name, expected_rows, actual_rows, matches) for tables on either side."""
    both = expected.withColumnRenamed("rows", "expected_rows").join(actual.withColumnRenamed("rows", "actual_rows"), "table_name", "full")
    return both.withColumn("matches", F.coalesce(F.col("expected_rows") == F.col("actual_rows"), F.lit(False)))


def partition_profile(rows: DataFrame, partition: str, user: str) -> DataFrame:
    """Rows, users, files and bytes behind each partition."""
    seen = rows.select(partition, user, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    files = seen.groupBy(partition, "file").agg(F.max("bytes").alias("bytes"))
    files = files.groupBy(partition).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return seen.groupBy(partition).agg(F.count("*").alias("rows"), F.countDistinct(user).alias("users")).join(files, partition)
