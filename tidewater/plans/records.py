"""Queries of reads by key and day, logs, counters, constraints, reconstruction tables and model decisions, each beside its SQL."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import encoding, marts, publish, quality, reconstruct, uplift
from tidewater.plans import inputs as I
from tidewater.plans import operations as O
from tidewater.plans.inputs import sql
from tidewater.sources import lake
from tidewater.streaming import events as stream

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(oracle: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql(oracle)
        return f

    return register


# Reads

@query("SELECT user_id, f0, f1 FROM snap")
def shard_scan(spark, sf):
    """All eight hashed shards, laid out once, each read by itself and from its own folder: together they are the table."""
    s = lake.by_shard(I.snapshot(spark, sf).select("user_id", "f0", "f1"), "user_id", 8)
    parts = [lake.shard(s, "user_id", k, 8, ["user_id", "f0", "f1"]) for k in range(8)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("""SELECT CAST(dt AS VARCHAR) AS read, count(*) AS n FROM snap WHERE dt = DATE '2024-01-10' GROUP BY dt UNION ALL SELECT 'all', count(*) FROM snap""")
def logical_date_read(spark, sf):
    s = I.snapshot(spark, sf)
    one, every = marts.one_day(s, "2024-01-10"), marts.one_day(s, None)
    return one.groupBy(F.col("dt").cast("string").alias("read")).agg(F.count("*").alias("n")).union(every.agg(F.lit("all"), F.count("*")))


@query("""SELECT user_id, f0, f1 FROM snap WHERE dt = DATE '2024-01-30' AND user_id IN (SELECT user_id FROM ev)""")
def fetch_users(spark, sf):
    """A day's snapshot rows of the users who have events."""
    return lake.members(I.snapshot(spark, sf), I.events(spark, sf), "user_id", I.DAY).select("user_id", "f0", "f1")


# Publication and logs

@query(f"{O._SYNC} SELECT feature_version, shard_id, status, rows_written FROM now WHERE feature_version = (SELECT max(feature_version) FROM sync)")
def latest_sync_shards(spark, sf):
    rows = publish.latest_sync_shards(O._syncs(spark, sf), O._shards(spark, sf), "created_at")
    return rows.select("feature_version", "shard_id", "status", "rows_written")


@query(f"{O._SYNC} SELECT feature_version, shard_id, rows_written FROM shard ORDER BY updated_at DESC, rows_written DESC LIMIT 20")
def recent_audit(spark, sf):
    """The last twenty rows of the shard log: a report's limit."""
    rows = publish.recent(O._shards(spark, sf), 20, F.desc("updated_at"), F.desc("rows_written"))
    return rows.select("feature_version", "shard_id", "rows_written")


@query(f"{O._SYNC} SELECT n.feature_version, n.shard_id, n.status, t.attempts FROM now n JOIN (SELECT feature_version, shard_id, count(*) AS attempts FROM shard GROUP BY ALL) t USING (feature_version, shard_id)")
def audit_log(spark, sf):
    """Shard attempts appended in two goes, and each shard's state and number of attempts from the log."""
    path, rows = I.scratch(spark, "audit"), O._shards(spark, sf)
    lake.append(rows.where("shard_id < 12"), path)
    lake.append(rows.where("shard_id >= 12"), path)
    return publish.audit_state(spark.read.parquet(path), ["feature_version", "shard_id"]).select("feature_version", "shard_id", "status", "attempts")


@query("""SELECT user_id, CAST(count(*) AS BIGINT) AS n_logged FROM (SELECT user_id FROM snap UNION ALL SELECT user_id FROM snap WHERE split = 'test') WHERE CAST(('0x' || substr(sha256(user_id), 1, 8)) AS BIGINT) < 0.25 * 4294967296 GROUP BY user_id""")
def decision_log_append(spark, sf):
    """A quarter of the decisions of two requests, appended; the same users whenever they are asked for."""
    path, s = I.scratch(spark, "decisions"), I.snapshot(spark, sf)
    for rows in (s, s.where("split = 'test'")):
        lake.append(uplift.log_sample(rows.select("user_id"), 0.25, "user_id"), path)
    return spark.read.parquet(path).groupBy("user_id").agg(F.count("*").alias("n_logged"))


# Counters and quality

_DECISION = "CASE WHEN f1 IS NULL THEN 'NO_DECISION' WHEN f1 - 0.5 >= 0.0070347543 THEN 'SEND_VOUCHER' ELSE 'NO_VOUCHER' END"
_LATE = f"""CASE WHEN epoch(ts) > epoch(TIMESTAMP '{O._NOW}') + 300 THEN 'future_dropped' WHEN floor(epoch(ts) / 300) * 300 < floor(epoch(TIMESTAMP '{O._NOW}') / 300) * 300 - 3300 THEN 'late_dropped'
 WHEN epoch(TIMESTAMP '{O._NOW}') - epoch(ts) > 600 THEN 'late_accepted' ELSE 'applied' END"""


@query(f"""SELECT counter, label, count(*) AS n FROM (SELECT 'events' AS counter, event_type AS label FROM ev UNION ALL SELECT 'dead_letters', {O._REASON} FROM events
 UNION ALL SELECT 'lateness', {_LATE} FROM events UNION ALL SELECT 'decisions', {_DECISION} FROM snap) WHERE label IS NOT NULL GROUP BY ALL""")
def operational_counters(spark, sf):
    now = S.epoch_seconds(F.lit(O._NOW).cast("timestamp"))
    decision, _ = uplift.decide(F.col("f1") - 0.5)
    e = I.read(spark, sf, "events")
    return quality.tally({
        "events": (I.events(spark, sf), F.col("event_type")),
        "dead_letters": (stream.decode(O._messages(spark, sf)), F.col("reason")),
        "lateness": (e, stream.lateness(S.epoch_seconds(F.col("ts").cast("timestamp")), now)),
        "decisions": (I.snapshot(spark, sf), decision),
    })


_THIRTY = [f"f{i}" for i in range(30)]
_OFF = "CAST(substr(user_id, 2) AS BIGINT) % 4 = 0"


@query("WITH few AS (SELECT * FROM snap ORDER BY sha256(user_id) LIMIT 100) " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, count(*) AS n_compared, count(*) FILTER (WHERE {_OFF} AND {f} IS NOT NULL) AS n_mismatched, CAST(0 AS BIGINT) AS n_missing FROM few" for f in _THIRTY))
def sampled_consistency(spark, sf):
    """Thirty features of the hundred users whose hashes come first, against a copy that is off in every fourth."""
    s = I.snapshot(spark, sf)
    few = s.join(publish.sample_keys(s, "user_id", 100), "user_id", "left_semi").select("user_id", *_THIRTY)
    off = F.substring("user_id", 2, 20).cast("long") % 4 == 0
    copy = s.select("user_id", *(F.when(off, F.col(c) + 0.01).otherwise(F.col(c)).alias(c) for c in _THIRTY))
    return quality.reconcile(few, copy, "user_id", _THIRTY, 1e-4)


@query("""SELECT 'republished' AS copy, count(*) AS n_rows, true AS stable FROM snap UNION ALL SELECT 'changed', count(*), count(*) FILTER (WHERE CAST(substr(user_id, 2) AS BIGINT) % 13 = 0 AND f0 IS NOT NULL) = 0 FROM snap""")
def checksum_stability(spark, sf):
    """The snapshot's checksum when it is prepared, against that of a written copy, and of a copy with changes."""
    columns = ["user_id", "label", *lake.FEATURES]
    path, s = I.scratch(spark, "checksum"), I.snapshot(spark, sf).select("user_id", "label", *lake.FEATURES)
    s.write.parquet(path)
    before, copy = quality.checksum(s, columns), spark.read.parquet(path)
    changed = copy.withColumn("f0", F.when(F.substring("user_id", 2, 20).cast("long") % 13 == 0, F.col("f0") + 1).otherwise(F.col("f0")))
    rows = [quality.same_checksum(before, quality.checksum(c, columns)).withColumn("copy", F.lit(n)) for n, c in (("republished", copy), ("changed", changed))]
    return rows[0].union(rows[1]).select("copy", "n_rows", "stable")


@query(f"""{O._EVENTS} SELECT 'quarantine_has_events' AS rule, count(*) AS n FROM dec WHERE reason IS NOT NULL AND {O._NTH} IN (SELECT user_id FROM events)
UNION ALL SELECT 'objective_missing', count(*) FROM bnd2 WHERE free_min IS NULL UNION ALL SELECT 'solved_with_reason', count(*) FROM ok WHERE reason IS NOT NULL
UNION ALL SELECT 'event_after_as_of', count(*) FROM (SELECT target_id FROM made GROUP BY target_id HAVING max(made_s) >= epoch(TIMESTAMP '2024-01-30 12:00:00'))""")
def reconstruction_constraints(spark, sf):
    """Rows that break each rule, with lake events as those of set-aside targets and an as_of twelve hours early."""
    ready, aside = reconstruct.solvable(O._decoded(spark, sf))
    plans = reconstruct.plan(ready, O.SEED).withColumn("reference_ts", F.lit(O.REFERENCE).cast("timestamp"))
    last = reconstruct.materialise(plans, O.SEED).groupBy("target_id").agg(F.max("event_ts").alias("last"))
    seen = I.read(spark, sf, "events").select(F.concat(F.lit("r"), F.col("user_id")).alias("target_id"))
    return quality.violations({
        "quarantine_has_events": aside.join(seen, "target_id", "left_semi"),
        "objective_missing": plans.where("free_min IS NULL"),
        "solved_with_reason": plans.where("reason IS NOT NULL"),
        "event_after_as_of": last.where(F.col("last") >= F.lit("2024-01-30 12:00:00").cast("timestamp")),
    })


# Reconstruction

_TIERS = {"f1": ("recency", "T1", "exact"), "f2": ("last_recency", "T1", "exact"), "f5": ("browse", "T2", "relative"), "f18": ("promo", "T3", "exact")}


def _report(spark, sf) -> DataFrame:
    """Gate A of targets of which some say one day more than their events; with each feature's name and tier."""
    plans = O._plans(spark, sf)
    wrong = F.substring("target_id", 2, 20).cast("long") % 17 == 0
    targets = plans.select("target_id", "f1", F.when(wrong, F.col("f2") + 1).otherwise(F.col("f2")).alias("f2"), "f5", "f18")
    gated = reconstruct.gate_a(targets, plans.select("target_id", "reference_ts"), reconstruct.materialise(plans, O.SEED))
    aliases = spark.createDataFrame([(k, *v) for k, v in _TIERS.items()], "feature string, name string, tier string, regime string")
    return reconstruct.feature_report(gated, aliases)


_REPORT = f"""{O._TARGETS}, rep AS (SELECT target_id, feature, name, tier, regime, NOT (feature = 'f2' AND {O._NTH} % 17 = 0) AS ok FROM ok,
 (VALUES {", ".join(f"('{k}', '{n}', '{t}', '{r}')" for k, (n, t, r) in _TIERS.items())}) AS a(feature, name, tier, regime))"""


@query(f"{_REPORT} SELECT target_id, feature, name, tier, regime, ok FROM rep")
def feature_report(spark, sf):
    return _report(spark, sf).select("target_id", "feature", "name", "tier", "regime", "ok")


@query(f"{_REPORT} SELECT tier, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok FROM rep GROUP BY tier")
def gate_by_tier(spark, sf):
    return reconstruct.tier_summary(_report(spark, sf))


@query(f"""{O._EVENTS} SELECT 'plans' AS table_name, count(*) AS n_rows FROM ok UNION ALL SELECT 'events', count(*) FROM made UNION ALL SELECT 'boundary', count(*) FROM ok UNION ALL SELECT 'targets', count(*) FROM ok
UNION ALL SELECT 'passthrough_source', count(*) FROM ok UNION ALL SELECT 'objective', count(*) FROM ok UNION ALL SELECT 'customer_attribute', count(*) FROM ok
UNION ALL SELECT 'quarantine', count(*) FROM dec WHERE reason IS NOT NULL UNION ALL SELECT 'landed', count(*) FROM made UNION ALL SELECT 'audit', count(*) FROM made
UNION ALL SELECT 'encoding_map', 2 * count(*) FROM (SELECT DISTINCT n5, n18 FROM ok) UNION ALL SELECT 'onehot_layout', count(DISTINCT {O._NTH} % 5) FROM ok""")
def reconstruction_manifest(spark, sf):
    """The tables of a reconstruction, written and counted, and its events landed in a root of their own."""
    root = I.scratch(spark, "reconstruction")
    ready, aside = reconstruct.solvable(O._decoded(spark, sf))
    plans = reconstruct.plan(ready, O.SEED).withColumn("reference_ts", F.lit(O.REFERENCE).cast("timestamp"))
    levels = ready.select("target_id", F.lit("segment").alias("attr_name"), (F.substring("target_id", 2, 20).cast("int") % 5).alias("level_id"))
    pairs = encoding.encoding_map(encoding.value_dictionary(ready, ["n5", "n18"]), I.ENCODING, "counts", ["n5", "n18"])
    names = F.concat(F.lit("segment_"), F.col("level_id")).alias("column_name")
    layout = levels.select(F.lit(I.ENCODING).alias("encoding_version"), "attr_name", F.col("level_id").alias("level_index"), names).distinct()
    manifest = reconstruct.emit(plans, aside, levels, ["f1", "f2"], root, O.SEED, pairs, layout)
    events = spark.read.parquet(f"{root}/events").withColumn("dt", F.to_date("event_ts"))
    landed = lake.land_counted(events, f"{root}/lake-synthetic", ["dt"])
    return manifest.unionByName(spark.createDataFrame([("landed", landed)], "table_name string, n_rows long"))


# Decisions

@query("""WITH fit AS (SELECT regr_slope(z, score) AS a, regr_intercept(z, score) AS b FROM (SELECT score, CAST(2 * y * (2 * w - 1) AS DOUBLE) AS z FROM trial)),
m AS (SELECT user_id, coalesce(CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 3 = 0 THEN f2 END, f1, 0.0) AS f1 FROM snap)
SELECT user_id, round(a * f1 + b, 9) AS effect, CASE WHEN a * f1 + b >= 0.0070347543 THEN 'SEND_VOUCHER' ELSE 'NO_VOUCHER' END AS decision FROM m, fit""")
def model_decisions(spark, sf):
    """Merge, vector, fitted model, decision: effects of a trial, by a regression of the transformed outcome, for all users.

    Every third user has a realtime value that takes the batch value's place.
    """
    trial = I.trial(spark, sf).select(F.col("score").alias("f1"), (2.0 * F.col("y") * (2 * F.col("w") - 1)).alias("z"))
    model = LinearRegression(featuresCol="features", labelCol="z", predictionCol="effect", solver="normal", regParam=0.0, standardization=False).fit(uplift.assemble(trial, ["f1"]))
    s = I.snapshot(spark, sf)
    batch = s.select("user_id", "f1")
    over = s.where((F.substring("user_id", 2, 20).cast("long") % 3 == 0) & F.col("f2").isNotNull()).select("user_id", F.col("f2").alias("f1"))
    merged = marts.merge_overlay(batch, over, {"f1": 0.0}, "user_id")
    scored = model.transform(uplift.assemble(merged.select("user_id", "f1"), ["f1"]))
    decision, _ = uplift.decide(F.col("effect"))
    return scored.select("user_id", F.round("effect", 9).alias("effect"), decision.alias("decision"))
