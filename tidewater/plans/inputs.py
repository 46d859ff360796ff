"""The jobs' inputs, derived by Spark from the given tables, and the same as SQL relations.

``RELATIONS`` holds one SQL sub-select a name; ``sql(body, *names)`` puts those in front of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scalars import derived_user_id, epoch_seconds
from tidewater.operators.behaviour import sessions
from tidewater.operators.staging import app_events, user_snapshot, witness_events
from tidewater.sources.lake import FEATURES, scratch  # noqa: F401

AS_OF = "2024-01-31 00:00:00"
DAY = "2024-01-30"
ENCODING = "enc_v4"
KINDS = {"view": "page_view", "click": "add_to_cart", "purchase": "order", "signup": "voucher_claim", "error": "search"}
WITNESS_KINDS = {"view": "EVT_F5", "click": "EVT_F18", "purchase": "EVT_ORDER_PAID", "signup": "EVT_SESSION_STARTED", "error": "EVT_SESSION_STARTED"}


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def _when(column: str, values: dict[str, str]):
    return F.element_at(F.create_map(*(F.lit(x) for p in values.items() for x in p)), F.col(column))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt out over as many tasks as a shuffle has: a table of few, narrow columns is a small file, which one task would read and widen."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), key)


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as they landed: every seventh a second time, later and at another price, every 97th without a user."""
    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 7, "0")))
    first = e.select(
        F.col("event_id").cast("string").alias("event_id"), user.alias("user_id"), _when("event_type", KINDS).alias("event_type"),
        epoch_seconds(F.col("ts")).alias("event_ts"), F.lit(None).cast("string").alias("session_id"), F.col("value").alias("price"),
        (k % 3 + 1).alias("quantity"), (epoch_seconds(F.col("ts")) + 5).alias("ingested_at"),
        (F.col("event_id") % 3).cast("int").alias("kafka_partition"), F.col("event_id").alias("kafka_offset"),
    )
    again = first.where(F.col("event_id").cast("long") % 7 == 0).withColumns({"price": F.col("price") + 1, "ingested_at": F.col("ingested_at") + 85, "kafka_offset": F.col("kafka_offset") + 10_000_000})
    return first.unionByName(again)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_events(landed_events(spark, sf_dir))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(events(spark, sf_dir))


def witness_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as witnesses, known up to nine hours after they happen, with generator columns that staging drops."""
    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    target = F.concat(F.lit("t"), F.col("user_id"))
    rows = e.select(
        F.col("event_id").cast("string").alias("event_id"), F.concat(F.lit("U"), F.col("user_id")).alias("customer_id"), target.alias("target_id"),
        _when("event_type", WITNESS_KINDS).alias("event_type"), epoch_seconds(F.col("ts")).alias("event_ts"),
        (epoch_seconds(F.col("ts")) + 3600 * (F.col("event_id") % 10)).alias("observation_ts"), F.lit("real").alias("source_type"),
        F.lit("run-0").alias("generation_run_id"), F.lit("generator").alias("gen_reason"), F.lit(0).alias("day_offset"),
    )
    again = rows.where(F.col("event_id").cast("long") % 11 == 0).withColumn("observation_ts", F.col("observation_ts") + 60)
    return rows.unionByName(again)


def witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness_events(witness_raw(spark, sf_dir))


def boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference time for each user, and for one user in ten a time before any event."""
    users = read(spark, sf_dir, "events").select("user_id").distinct()
    at = F.when(F.col("user_id") % 10 == 3, "2023-12-31 00:00:00").when(F.col("user_id") % 2 == 0, "2024-01-25 00:00:00").otherwise("2024-01-20 12:00:00")
    return users.select(F.concat(F.lit("t"), F.col("user_id")).alias("target_id"), at.cast("timestamp").alias("reference_ts"))


def snapshot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as snapshot rows with 83 features, one in ten with an older second row, some values missing."""
    c = dealt(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    key = F.col("c_custkey")
    split = F.when(key % 5 == 0, "test").otherwise("train")
    data_id = F.concat_ws("_", split, key)
    value = lambda i: F.when((key + i) % 50 != 0, ((key * (i + 3)) % 97) / F.lit(97.0))
    day = F.date_sub(F.to_date(F.lit(DAY)), (key % 3 * 20).cast("int"))
    rows = c.select(
        derived_user_id(data_id).alias("user_id"), data_id.alias("data_id"), split.alias("split"), day.alias("dt"),
        (day.cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(12))).alias("feature_ts"),
        (key % 7 == 0).cast("int").alias("label"), (key % 2).cast("int").alias("is_treat"), *(value(i).alias(f"f{i}") for i in range(83)), key.alias("c_custkey"),
    )
    old = rows.where("c_custkey % 10 = 0").withColumns({"feature_ts": F.col("feature_ts") - F.make_dt_interval(F.lit(0), F.lit(3)), "label": F.lit(1) - F.col("label")})
    return rows.unionByName(old).drop("c_custkey")


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_snapshot(snapshot_raw(spark, sf_dir))


def event_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature times for the realtime window: a second and a half after each event."""
    e = events(spark, sf_dir)
    at = F.col("event_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1.5))
    return e.select("user_id", F.to_date(at).alias("dt"), at.alias("feature_ts")).distinct()


def trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A randomised trial: orders, treated by hashed key, with an effect that grows with the score; (key, y, w, score, tie)."""
    o = dealt(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    key = F.col("o_orderkey")
    part = lambda salt: F.conv(F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 6), 16, 10).cast("double") / 16777216.0
    w = (part("w") < 0.5).cast("int")
    score = F.floor(part("s") * 1000) / 1000
    y = (part("y") < 0.05 + 0.3 * score * w).cast("int")
    return o.select(key.alias("key"), y.alias("y"), w.alias("w"), score.alias("score"), F.md5(key.cast("string")).alias("tie"))


_part = "CAST(('0x' || substr(md5('{0}' || CAST(o_orderkey AS VARCHAR)), 1, 6)) AS BIGINT) / 16777216.0"
_features = ", ".join(f"CASE WHEN (c_custkey + {i}) % 50 <> 0 THEN ((c_custkey * {i + 3}) % 97) / CAST(97.0 AS DOUBLE) END AS f{i}" for i in range(83))
_head = f"""SELECT CASE WHEN c_custkey % 5 = 0 THEN 'T' ELSE 'U' END || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(7, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS user_id,
 CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END || '_' || c_custkey AS data_id, CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
 CAST(DATE '{DAY}' - CAST(c_custkey % 3 * 20 AS INTEGER) AS DATE) AS dt"""

RELATIONS = {
    "landed": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 97 <> 0 THEN 'U' || lpad(CAST(user_id AS VARCHAR), 7, '0') END AS user_id,
  {_case('event_type', KINDS)} AS event_type, ts AS event_ts, value AS price, CAST(json_extract(props, '$.k') AS INTEGER) % 3 + 1 AS quantity,
  ts + INTERVAL 5 SECOND AS ingested_at, CAST(event_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), CASE WHEN event_id % 97 <> 0 THEN 'U' || lpad(CAST(user_id AS VARCHAR), 7, '0') END,
  {_case('event_type', KINDS)}, ts, value + 1, CAST(json_extract(props, '$.k') AS INTEGER) % 3 + 1, ts + INTERVAL 90 SECOND, CAST(event_id % 3 AS INTEGER), event_id + 10000000 FROM events WHERE event_id % 7 = 0""",
    "ev": """
SELECT event_id, user_id, event_type, price, quantity, price * quantity AS gmv, event_ts, CAST(event_ts AS DATE) AS event_date, ingested_at
FROM landed WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at, kafka_partition, kafka_offset) = 1""",
    "flagged": """
SELECT *, CASE WHEN epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER (PARTITION BY user_id ORDER BY event_ts, event_id) <= 1800000000 THEN 0 ELSE 1 END AS new_session FROM ev""",
    "sess": """
SELECT * EXCLUDE (new_session), user_id || '-' || sum(new_session) OVER (PARTITION BY user_id ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS session_id FROM flagged""",
    "wit": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, 'U' || user_id AS customer_id, 't' || user_id AS target_id, {_case('event_type', WITNESS_KINDS)} AS event_type,
  ts AS event_ts, ts + to_hours(event_id % 10) AS observation_ts, 'real' AS source_type, 'run-0' AS generation_run_id FROM events""",
    "bnd": """
SELECT DISTINCT 't' || user_id AS target_id, CASE WHEN user_id % 10 = 3 THEN TIMESTAMP '2023-12-31 00:00:00' WHEN user_id % 2 = 0 THEN TIMESTAMP '2024-01-25 00:00:00' ELSE TIMESTAMP '2024-01-20 12:00:00' END AS reference_ts FROM events""",
    "snap": f"""
{_head}, CAST(DATE '{DAY}' - CAST(c_custkey % 3 * 20 AS INTEGER) AS TIMESTAMP) + INTERVAL 12 HOUR AS feature_ts, CAST(c_custkey % 7 = 0 AS INTEGER) AS label, CAST(c_custkey % 2 AS INTEGER) AS is_treat, {_features} FROM customer""",
    "esnap": """
SELECT DISTINCT user_id, CAST(event_ts + to_microseconds(1500000) AS DATE) AS dt, event_ts + to_microseconds(1500000) AS feature_ts FROM ev""",
    "draws": f"""
SELECT o_orderkey, CAST(({_part.format('w')}) < 0.5 AS INTEGER) AS w, floor(({_part.format('s')}) * 1000) / 1000 AS score, {_part.format('y')} AS u FROM orders""",
    "trial": """
SELECT o_orderkey AS key, CAST(u < 0.05 + 0.3 * score * w AS INTEGER) AS y, w, score, md5(CAST(o_orderkey AS VARCHAR)) AS tie FROM draws""",
}


def sql(body: str, recursive: bool = False) -> str:
    """``body`` behind the relations it can use; those it doesn't use cost nothing."""
    head = ", ".join(f"{name} AS ({text})" for name, text in RELATIONS.items())
    rest = body.strip()
    link = f", {rest[5:]}" if rest.upper().startswith("WITH ") else f" {rest}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}{link}"
