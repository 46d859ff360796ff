"""Queries of stream jobs over several batches and restarts, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators.staging import keep_first
from tidewater.plans import inputs as I
from tidewater.plans import operations as O
from tidewater.plans.inputs import sql
from tidewater.streaming import decisions, health, state
from tidewater.streaming import events as stream

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(oracle: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql(oracle)
        return f

    return register


def _delivered(rows, path: str, part, parts: range):
    """Rows of each part written as one delivery, of as many files as tasks make it; after each its number, for a stream to take it as a batch."""
    for k in parts:
        rows.where(part == k).write.mode("append").parquet(path)
        yield k


_MESSAGE = "value string, partition int, offset long, timestamp timestamp"


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(hour(ts) // 12 * 12 AS INTEGER) AS hour, CAST(event_id % 3 AS INTEGER) AS kafka_partition, count(*) AS n_rows, min(event_id) AS low, max(event_id) AS high
FROM events WHERE event_id % 20 > 4 GROUP BY ALL""")
def landing_restart(spark, sf):
    """Messages in four deliveries: two landed one by one, then all four with an empty checkpoint, three in the first batch. Each lands once.

    Event times are cut to half days, as every object of an hour is a file.
    """
    root = I.scratch(spark, "landing")
    e = I.dealt(I.read(spark, sf, "events"), "event_id").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = O.messages(e.withColumn("ts", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 43_200) * 43_200)))
    last = e.agg(F.max("event_id")).first()[0]
    part = F.floor(F.col("offset") * 4 / (last + 1))

    def land(checkpoint: str, files: int | None = None) -> None:
        messages = stream.file_source(spark, f"{root}/in", _MESSAGE, files)
        stream.start_landing(messages, f"{root}/lake", f"{root}/dlq", f"{root}/{checkpoint}", once=True).awaitTermination()

    for k in _delivered(rows, f"{root}/in", part, range(4)):
        if k < 2:
            land("checkpoint-1")
    files = len(spark.read.schema(_MESSAGE).parquet(f"{root}/in").inputFiles())
    land("checkpoint-3", -(-files * 3 // 4))
    there = stream.landed(spark, f"{root}/lake")
    return there.groupBy(F.col("dt").cast("string").alias("day"), "hour", "kafka_partition").agg(F.count("*").alias("n_rows"), F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"))


@query("""SELECT user_id, epoch_us(last_ts) AS last_us, n FROM (SELECT 'U' || user_id AS user_id, max(ts) AS last_ts, count(*) AS n FROM events GROUP BY user_id) WHERE last_ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def keyed_state(spark, sf):
    """Each user's last event and number of events, brought up to date by six batches; users silent for a day have expired."""
    root = I.scratch(spark, "keyed")
    e = I.read(spark, sf, "events").select(F.concat(F.lit("U"), F.col("user_id")).alias("user_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    last = e.agg(F.max("event_id")).first()[0]
    for k in range(6):
        seen = e.where(F.col("event_id") * 6 < (k + 1) * (last + 1))
        new = seen.where(F.col("event_id") * 6 >= k * (last + 1)).select("user_id").distinct()
        batch = seen.join(new, "user_id", "left_semi").groupBy("user_id").agg(F.max("ts").alias("last_event_ts"), F.count("*").alias("n"))
        state.upsert(batch, k, f"{root}/state", ["user_id"], "n", ttl=86_400, buckets=16, changes=3)
    return state.last_state(spark, f"{root}/state").select("user_id", F.unix_micros("last_event_ts").alias("last_us"), "n")


def _arrivals(spark, sf):
    """Events as they arrive: most after five seconds, some much later or before their time, some twice."""
    e = I.read(spark, sf, "events").withColumn("event_ts", F.col("ts").cast("timestamp"))
    k = F.col("event_id") % 10
    delay = F.when(k == 0, 7200).when(k == 1, 900).when(k == 2, -600).otherwise(5)
    rows = e.select(
        F.col("event_id").cast("string").alias("event_id"), F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 7, "0")).alias("user_id"), I._when("event_type", I.KINDS).alias("event_type"), "event_ts",
        F.timestamp_micros(F.unix_micros("event_ts") + delay.cast("long") * 1_000_000).alias("ingested_at"), F.col("value").alias("price"), F.lit(1).alias("quantity"),
    )
    again = rows.where(F.col("event_id").cast("long") % 7 == 3).withColumn("ingested_at", F.col("ingested_at") + F.make_dt_interval(secs=F.lit(60)))
    return rows.unionByName(again)


_ARRIVED = "event_id string, user_id string, event_type string, event_ts timestamp, ingested_at timestamp, price double, quantity int"
_ARRIVALS = """WITH first AS (SELECT event_id, 'U' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS user_id, event_type, ts, value, epoch_us(ts) + CAST(1000000 AS BIGINT) * CASE event_id % 10 WHEN 0 THEN 7200 WHEN 1 THEN 900 WHEN 2 THEN -600 ELSE 5 END AS arrival_us, 0 AS copy FROM events),
arr AS (SELECT * FROM first UNION ALL SELECT * REPLACE (arrival_us + 60000000 AS arrival_us, 1 AS copy) FROM first WHERE event_id % 7 = 3),
act AS (SELECT *, arrival_us / 1e6 AS a, epoch_us(ts) / 1e6 AS t FROM arr),
kept AS (SELECT *, CASE WHEN t > a + 300 THEN 'future_dropped' WHEN floor(t / 300) * 300 < floor(a / 300) * 300 - 3300 THEN 'late_dropped' WHEN copy = 1 THEN 'deduplicated' ELSE 'applied' END AS action FROM act),
clock AS (SELECT user_id, max(a) AS as_of FROM kept GROUP BY user_id),
hour AS (SELECT c.user_id, as_of, count(k.user_id) AS n, max(t) AS last_s FROM clock c LEFT JOIN kept k ON k.user_id = c.user_id AND k.action = 'applied' AND floor(t / 300) * 300 BETWEEN floor(as_of / 300) * 300 - 3300 AND floor(as_of / 300) * 300 GROUP BY ALL)"""


def _decided(spark, sf):
    """The stream of arrivals in four batches with a restart after each: folders of overlays and decisions."""
    root = I.scratch(spark, "decisions")
    rows = _arrivals(spark, sf)
    # Deliveries by arrival, cut at whole seconds, so that what comes together stays together.
    low, high = rows.agg(F.min(F.unix_seconds("ingested_at")), F.max(F.unix_seconds("ingested_at"))).first()
    part = F.floor((F.unix_seconds("ingested_at") - low) * 4 / (high - low + 1))
    s = I.snapshot(spark, sf).select("user_id", "f1")
    two = O._syncs(spark, sf).orderBy(F.desc("activated_at"), "feature_version").limit(2).select("feature_version")
    published, pointer = s.crossJoin(F.broadcast(two)), O._pointer(spark, sf)
    effect = decisions.constant(spark, F.col("f1") + 0.01 * F.col("rt_events_1h") - 0.5)
    for _ in _delivered(rows, f"{root}/in", part, range(4)):
        arriving = stream.file_source(spark, f"{root}/in", _ARRIVED, None).withWatermark("event_ts", "3 hours")
        decided = lambda batch: decisions.decide_active(batch, pointer, published, {"f1": 0.25, "rt_events_1h": 0.0}, effect)
        decisions.start_deciding(arriving, root, f"{root}/checkpoint", decided, once=True).awaitTermination()
    return spark.read.parquet(f"{root}/overlay"), spark.read.parquet(f"{root}/decisions")


@query(f"""{_ARRIVALS} SELECT action, CAST(n AS BIGINT) AS n FROM (SELECT action, count(*) AS n FROM kept GROUP BY action UNION ALL SELECT 'late_accepted', count(*) FROM kept WHERE action IN ('applied', 'deduplicated') AND a - t > 600)""")
def stream_late_policy(spark, sf):
    """What became of every event, as the keyed state of the stream decided it."""
    return decisions.actions(_decided(spark, sf)[0])


@query(f"""{_ARRIVALS}, v AS (SELECT arg_max('v' || strftime(d, '%Y%m%d'), d) AS active FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE day(CAST(ts AS DATE)) % 3 = 0)),
m AS (SELECT h.*, last_s >= as_of - 300 AS is_active, s.user_id IS NOT NULL AS known, coalesce(s.f1, 0.25) + 0.01 * n - 0.5 AS score FROM hour h LEFT JOIN snap s ON s.user_id = h.user_id)
SELECT user_id, n AS rt_events_1h, CASE WHEN is_active AND known THEN active END AS feature_version, CASE WHEN is_active THEN round(score, 9) END AS score,
 CASE WHEN NOT coalesce(is_active, false) THEN NULL WHEN score >= 0.0070347543 THEN 'SEND_VOUCHER' ELSE 'NO_VOUCHER' END AS decision FROM m, v""")
def stream_decisions(spark, sf):
    """Each user's last hour as the stream left it, and the decision if the user was active then."""
    overlays, decided = _decided(spark, sf)
    last = keep_first(overlays, ["user_id"], [F.desc("as_of"), F.desc("batch")]).select("user_id", "as_of", "rt_events_1h")
    rows = last.join(decided.select("user_id", "as_of", "feature_version", "score", "decision"), ["user_id", "as_of"], "left")
    return rows.select("user_id", F.col("rt_events_1h").cast("long").alias("rt_events_1h"), "feature_version", F.round("score", 9).alias("score"), "decision")


_LAG = f"{_ARRIVALS}, lag AS (SELECT event_id % 3 AS batch, a - t AS s FROM act WHERE copy = 0)"


def _lagged(spark, sf):
    root = I.scratch(spark, "lag")
    first = keep_first(_arrivals(spark, sf), ["event_id"], ["ingested_at"])
    log = health.LagLog(spark, f"{root}/log")
    spark.streams.addListener(log)
    try:
        for _ in _delivered(first, f"{root}/in", F.col("event_id").cast("long") % 3, range(3)):
            seen = stream.observed_lag(stream.file_source(spark, f"{root}/in", _ARRIVED, None), F.col("ingested_at"))
            stream.run_to_table(seen, f"{root}/out", f"{root}/checkpoint")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    return root, health.lag_log(spark, f"{root}/log")


@query(f"{_LAG} SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n, quantile_disc(s, 0.5) AS p50_s, quantile_disc(s, 0.95) AS p95_s, max(s) AS max_s FROM lag GROUP BY batch")
def lag_by_batch(spark, sf):
    """Lag as each batch of a stream observed it, appended to a table by a listener."""
    return _lagged(spark, sf)[1].drop("query")


@query(f"""{_LAG} SELECT 'new_files' AS check_name, true AS passed, CAST(count(DISTINCT batch) AS DOUBLE) AS observed, 1.0 AS threshold FROM lag
UNION ALL SELECT 'p95_lag', max(p) < 300, max(p), 300.0 FROM (SELECT quantile_disc(s, 0.95) AS p FROM lag GROUP BY batch)
UNION ALL SELECT 'overlay_age', max(age) < 900, round(max(age), 3), 900.0 FROM (SELECT (SELECT max(epoch_us(ts)) FROM events) / 1e6 - max(epoch_us(ts)) / 1e6 AS age FROM events GROUP BY user_id ORDER BY sha256('U' || lpad(CAST(user_id AS VARCHAR), 7, '0')) LIMIT 20)""")
def stream_health(spark, sf):
    """New files, lag and overlay age as check rows, after a stream of three batches."""
    root, log = _lagged(spark, sf)
    came = spark.read.parquet(f"{root}/in")
    overlaid = came.groupBy("user_id").agg(F.max("event_ts").alias("last_event_ts"))
    now = came.agg(S.epoch_seconds(F.max("event_ts"))).first()[0]
    rows = health.health([health.new_files(came, F.lit("2000-01-01").cast("timestamp")), health.lag_below(log), health.overlay_age(overlaid, F.lit(now))])
    return rows.withColumn("observed", F.round("observed", 3))
