"""The event stream: decode, validate, de-duplicate, count, and keep session state.

Every function takes a DataFrame, streaming or not, so batch twins and tests use the same code; the
sinks at the end run on micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.functions.scalars import BUCKET_SECONDS, bucket_start, epoch_seconds, window_cutoff
from tidewater.streaming.state import last_state, upsert  # noqa: F401

#: Event types, required fields and what each type counts towards.
EVENT_TYPES = ("app_open", "page_view", "search", "add_to_cart", "checkout", "order", "voucher_view", "voucher_claim")
REQUIRED = ("event_id", "user_id", "event_type", "event_ts")
COUNTERS = {"page_view": "page_view", "add_to_cart": "add_to_cart", "order": "order", "search": "search_cnt"}
FUTURE_SKEW_SECONDS = 300
ALLOWED_LATENESS_SECONDS = 600
DEDUP_MEMORY = "24 hours"
WATERMARK = "1 hour"
SESSION_TTL_SECONDS = 3600
TRIGGER_SECONDS = 30
PAYLOAD = "event_id string, user_id string, event_type string, event_ts string, session_id string, platform string, item_id string, category_id string, price double, quantity int, schema_version int"


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets: int = 2000) -> DataFrame:
    """The topic as value, partition, offset and broker time; needs Spark's Kafka package on the cluster."""
    rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    rows = rows.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_offsets).load()
    return rows.select(F.col("value").cast("string"), "partition", "offset", "timestamp")


def file_source(spark: SparkSession, path: str, schema: str, max_files: int | None = 1) -> DataFrame:
    """Files as they come, so many a batch; with None all there are."""
    rows = spark.readStream.schema(schema)
    return (rows if max_files is None else rows.option("maxFilesPerTrigger", max_files)).parquet(path)


def decode(raw: DataFrame) -> DataFrame:
    """Rows with ``e``, the parsed event (null if it isn't a JSON object), and ``reason`` it is invalid (null if valid)."""
    rows = raw.withColumn("e", F.from_json("value", PAYLOAD))
    broken = F.coalesce(F.try_parse_json("value").isNull() | ~F.startswith(F.ltrim("value"), F.lit("{")), F.lit(True))
    return rows.withColumn("reason", F.when(broken, "invalid_json").otherwise(invalid_reason(lambda c: F.col(f"e.{c}"))))


def invalid_reason(field) -> Column:
    """Why an event can't be used, by the first rule that it breaks; null if none."""
    at = field("event_ts").try_cast("double")
    reason = None
    for name in REQUIRED:
        empty = field(name).isNull() | (field(name).cast("string") == "")
        reason = F.when(empty, f"missing_field:{name}") if reason is None else reason.when(empty, f"missing_field:{name}")
    reason = reason.when(~field("event_type").isin(*EVENT_TYPES), F.concat(F.lit("unknown_event_type:"), field("event_type")))
    bad = at.isNull() | F.isnan(at) | (at <= 0)
    return reason.when(bad, "bad_event_ts").when(~F.startswith(field("user_id"), F.lit("U")), "bad_user_id")


def accepted(decoded: DataFrame) -> DataFrame:
    """Valid events with log place and ingest time (the broker's, or else the event's own)."""
    rows = decoded.where(F.col("reason").isNull())
    at = F.col("e.event_ts").try_cast("double")
    return rows.select(
        "e.event_id", "e.user_id", "e.event_type", F.timestamp_micros((at * 1e6).cast("long")).alias("event_ts"), "e.session_id", "e.platform",
        "e.item_id", "e.category_id", F.coalesce("e.price", F.lit(0.0)).alias("price"), F.coalesce("e.quantity", F.lit(0)).alias("quantity"),
        F.coalesce("e.schema_version", F.lit(1)).alias("schema_version"),
        F.coalesce("timestamp", F.timestamp_micros((at * 1e6).cast("long"))).alias("ingested_at"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
    )


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select("value", "partition", "offset", "reason")


def drop_replays(events: DataFrame, memory: str = DEDUP_MEMORY) -> DataFrame:
    """Each event id once within ``memory`` of event time; state older than that is let go."""
    return events.withWatermark("event_ts", memory).dropDuplicatesWithinWatermark(["event_id"])


def lateness(event_ts: Column, now: Column) -> Column:
    """What happens to an event that arrives ``now``, both in epoch seconds."""
    return (
        F.when(event_ts > now + FUTURE_SKEW_SECONDS, "future_dropped")
        .when(bucket_start(event_ts) < window_cutoff(now), "late_dropped")
        .when(now - event_ts > ALLOWED_LATENESS_SECONDS, "late_accepted")
        .otherwise("applied")
    )


def _counts() -> list[Column]:
    kinds = [F.count_if(F.col("event_type") == k).alias(c) for k, c in COUNTERS.items()]
    gmv = F.sum(F.when(F.col("event_type") == "order", F.col("price") * F.col("quantity")).otherwise(0.0)).alias("gmv")
    return [F.count("*").alias("events"), *kinds, gmv, F.max("event_ts").alias("last_event_ts")]


def buckets(events: DataFrame) -> DataFrame:
    """Five-minute counters by user; of a stream, with a watermark set before."""
    w = F.window("event_ts", f"{BUCKET_SECONDS} seconds")
    return events.groupBy("user_id", w.alias("w")).agg(*_counts()).select("user_id", F.col("w.start").alias("bucket"), *(c for c in ("events", *COUNTERS.values(), "gmv", "last_event_ts")))


def overlay(bucketed: DataFrame, now: Column) -> DataFrame:
    """Values of the last hour (twelve buckets) and of the current bucket at ``now`` (epoch seconds), by user."""
    start = epoch_seconds(F.col("bucket")).cast("long")
    rows = bucketed.where((start >= window_cutoff(now)) & (start <= bucket_start(now)))
    current = start == bucket_start(now)
    names = ["events", *COUNTERS.values(), "gmv"]
    hour = [F.sum(c).alias(f"rt_{c}_1h") for c in names]
    five = [F.coalesce(F.sum(F.when(current, F.col(c))), F.lit(0)).alias(f"rt_{c}_5m") for c in ("page_view", "add_to_cart", "search_cnt", "gmv")]
    return rows.groupBy("user_id").agg(*hour, *five, F.max("last_event_ts").alias("last_event_ts"))


def active_users(overlaid: DataFrame, now: Column, seconds: int = BUCKET_SECONDS) -> DataFrame:
    return overlaid.where(epoch_seconds(F.col("last_event_ts")) >= now - seconds)


SESSION = "user_id string, session_id string, session_start double, session_end double, session_len double"


def _session_step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A user's latest session: another one takes over only if it isn't older; the same one grows at both ends."""
    if state.hasTimedOut:
        state.remove()
        return
    session, begin, end = state.get if state.exists else (None, 0.0, 0.0)
    rows = pd.concat(list(batches)).sort_values(["event_s", "session_id"])
    for name, at in zip(rows["session_id"], rows["event_s"], strict=True):
        if not isinstance(name, str) or not name:
            continue
        if session == name:
            begin, end = min(begin, at), max(end, at)
        elif session is None or at >= end:
            session, begin, end = name, at, at
    if session is not None:
        state.update((session, begin, end))
        state.setTimeoutTimestamp(max(int(end * 1000) + SESSION_TTL_SECONDS * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": [key[0]], "session_id": [session], "session_start": [begin], "session_end": [end], "session_len": [end - begin]})


def session_state(events: DataFrame) -> DataFrame:
    """The latest session of each user, a row whenever events of the user arrive.

    ``events`` need a watermark: a user's state goes once that is SESSION_TTL_SECONDS past the user's last event.
    """
    rows = events.select("event_ts", "user_id", "session_id", epoch_seconds(F.col("event_ts")).alias("event_s"))
    return rows.groupBy("user_id").applyInPandasWithState(_session_step, SESSION, "session_id string, begin double, end double", "update", GroupStateTimeout.EventTimeTimeout)


def latest_sessions(events: DataFrame) -> DataFrame:
    """The batch twin of ``session_state`` on events in order."""
    parts = events.where(F.coalesce("session_id", F.lit("")) != "").groupBy("user_id", "session_id").agg(F.min("event_ts").alias("a"), F.max("event_ts").alias("b"))
    last = parts.groupBy("user_id").agg(F.max(F.struct("b", "session_id", "a")).alias("s"))
    a, b = epoch_seconds(F.col("s.a")), epoch_seconds(F.col("s.b"))
    return last.select("user_id", "s.session_id", a.alias("session_start"), b.alias("session_end"), (b - a).alias("session_len"))


class OffsetConflict(ValueError):
    """A place in the log came again with another payload."""


#: Folders of the lake and of the dead letters: objects are named by where they lie in the log.
LAKE_NAMES = ["dt", "hour", "kafka_partition", "first_offset", "last_offset"]
DEAD_NAMES = ["partition", "first_offset", "last_offset"]


def _there(spark: SparkSession, paths: list[str]) -> list[str]:
    make, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    return [p for p in paths if make(p).getFileSystem(conf).exists(make(p))]


def landed(spark: SparkSession, lake: str, days: list[str] | None = None) -> DataFrame | None:
    """What has landed, of all days or some; only their folders are listed. None if nothing has."""
    paths = _there(spark, [lake] if days is None else [f"{lake}/dt={d}" for d in days])
    return spark.read.option("basePath", lake).parquet(*paths) if paths else None


def dead_letters(spark: SparkSession, dlq: str) -> DataFrame | None:
    return spark.read.parquet(dlq) if _there(spark, [dlq]) else None


def _unlanded(rows: DataFrame, before: DataFrame | None, place: list[str], names: list[str]) -> DataFrame:
    """``rows`` whose place in the log hasn't landed, each place once, with the range of offsets that names their folder.

    Ranges are read off folder names first: of what has landed, only folders that overlap the rows' are opened.
    """
    rows = rows.dropDuplicates(place)
    if before is not None:
        low, high = rows.agg(F.min(place[1]), F.max(place[1])).first()
        if low is None:
            return rows.withColumns({"first_offset": F.lit(0).cast("long"), "last_offset": F.lit(0).cast("long")})
        near = before.where((F.col("first_offset") <= high) & (F.col("last_offset") >= low)).select(*(F.col(c).cast(rows.schema[c].dataType) for c in place))
        rows = rows.join(near, place, "left_anti")
    by = names[:-2]
    # A row an object that will be written.
    ranges = rows.groupBy(*by).agg(F.min(place[1]).alias("first_offset"), F.max(place[1]).alias("last_offset"))
    return rows.join(ranges, by)


def land(batch: DataFrame, batch_id: int, lake: str, dlq: str) -> dict[str, int]:
    """One micro-batch: valid rows to the lake, others to the dead letters; the number of each that is new.

    Objects are named by day, hour, log partition and first and last offset, and a place in the log lands
    once, whatever batch it comes in: after a crash, with a lost checkpoint or with other batch sizes, what
    has landed is left out and only the rest is added. So nothing is ever overwritten, and it doesn't matter
    which of the two sinks a crash left behind. A place that has landed on the same day, or stands in the
    batch, with another payload fails the batch before anything is written.
    """
    spark = batch.sparkSession
    decoded = decode(batch).persist()
    try:
        rows = accepted(decoded).withColumns({"dt": F.to_date("event_ts"), "hour": F.hour("event_ts")})
        place = ["kafka_partition", "kafka_offset"]
        about = rows.agg(F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"), F.collect_set(F.col("dt").cast("string")).alias("days")).first()
        before = landed(spark, lake, sorted(about.days)) if about.days else None
        payload = [c for c in rows.columns if c not in (*place, "ingested_at", "dt", "hour")]
        hashed = rows.select(*place, F.xxhash64(*payload).alias("h"))
        if before is not None:
            near = before.where((F.col("first_offset") <= about.high) & (F.col("last_offset") >= about.low))
            hashed = hashed.unionByName(near.select(*(F.col(c).cast(rows.schema[c].dataType) for c in place), F.xxhash64(*payload).alias("h")))
        if not hashed.groupBy(*place).agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").isEmpty():
            raise OffsetConflict(f"batch {batch_id}: offsets {about.low} to {about.high} have landed with another payload")
        fresh = _unlanded(rows, before, place, LAKE_NAMES).persist()
        dead = _unlanded(rejected(decoded), dead_letters(spark, dlq), ["partition", "offset"], DEAD_NAMES).persist()
        try:
            counts = {"landed": fresh.count(), "dead": dead.count()}
            if counts["landed"]:
                fresh.repartition(*LAKE_NAMES).sortWithinPartitions(*LAKE_NAMES, "kafka_offset").write.partitionBy(*LAKE_NAMES).mode("append").parquet(lake)
            if counts["dead"]:
                dead.repartition(*DEAD_NAMES).write.partitionBy(*DEAD_NAMES).mode("append").parquet(dlq)
            return counts
        finally:
            fresh.unpersist()
            dead.unpersist()
    finally:
        decoded.unpersist()


def start_landing(messages: DataFrame, lake: str, dlq: str, checkpoint: str, once: bool = False):
    """The running query that lands ``messages``, a batch every TRIGGER_SECONDS; with ``once`` it ends when all there is has landed."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{TRIGGER_SECONDS} seconds"}
    writer = messages.writeStream.foreachBatch(lambda b, i: land(b, i, lake, dlq)).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def observed_lag(events: DataFrame, now: Column, name: str = "lag") -> DataFrame:
    """``events``, of which each batch reports how many seconds they took (n, p50_s, p95_s, max_s) as an observed metric."""
    seconds = epoch_seconds(now) - epoch_seconds(F.col("event_ts"))
    quantile = lambda q: F.percentile_approx(seconds, q, 10_000)
    return events.observe(name, F.count("*").alias("n"), quantile(0.5).alias("p50_s"), quantile(0.95).alias("p95_s"), F.max(seconds).alias("max_s"))


def merge_latest(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Overlay upsert: of each key the row that is last by ``order``, the new one if equal."""
    from tidewater.operators.staging import keep_first

    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_first(both, [key], [F.desc(order), F.desc("_new")]).drop("_new")


def unexpired(overlaid: DataFrame, now: Column, ttl: int = 3600) -> DataFrame:
    return overlaid.where(epoch_seconds(F.col("last_event_ts")) >= now - ttl)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run what has arrived to a Parquet table and read it."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
