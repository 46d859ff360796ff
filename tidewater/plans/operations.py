"""Queries of quality, publication, lineage, reconstruction, streaming, uplift and decision jobs, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import lineage, publish, quality, reconstruct, uplift
from tidewater.operators.staging import keep_first
from tidewater.plans import inputs as I
from tidewater.plans.inputs import sql
from tidewater.sources import lake
from tidewater.streaming import events as stream

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(oracle: str | None = None, recursive: bool = False):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE_SQL[f.__name__] = sql(oracle, recursive)
        return f

    return register


# Quality

_TYPES = ["page_view", "add_to_cart", "order", "voucher_claim"]


@query("""SELECT 'not_null:user_id' AS check_name, 'snapshot' AS target, true AS passed, 0.0 AS observed, 0.0 AS threshold, 'error' AS severity
UNION ALL SELECT 'null_rate:f0', 'snapshot', avg(CAST(f0 IS NULL AS INTEGER)) <= 0.01, avg(CAST(f0 IS NULL AS INTEGER)), 0.01, 'warn' FROM snap
UNION ALL SELECT 'at_least_zero:f1', 'snapshot', true, 0.0, 0.0, 'error'
UNION ALL SELECT 'accepted_values:label', 'snapshot', true, 0.0, 0.0, 'error'
UNION ALL SELECT 'min_rows', 'snapshot', count(*) >= 100, count(*), 100.0, 'error' FROM snap
UNION ALL SELECT 'freshness:feature_ts', 'snapshot', true, 12.0, 26.0, 'error'
UNION ALL SELECT 'accepted_values:event_type', 'events', count(*) = 0, count(*), 0.0, 'error' FROM ev WHERE event_type = 'search'
UNION ALL SELECT 'unique:user_id', 'snapshot', true, 0.0, 0.0, 'error'""")
def dq_results(spark, sf):
    s = I.snapshot(spark, sf)
    checks = [
        quality.not_null("snapshot", "user_id"), quality.null_rate_below("snapshot", "f0", 0.01), quality.at_least_zero("snapshot", "f1"),
        quality.accepted_values("snapshot", "label", [0, 1]), quality.min_rows("snapshot", 100), quality.fresh("snapshot", "feature_ts", I.as_of()),
    ]
    e = quality.run_checks(I.events(spark, sf), [quality.accepted_values("events", "event_type", _TYPES)])
    return quality.run_checks(s, checks).unionByName(e).unionByName(quality.unique(s, "snapshot", "user_id"))


@query("""SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids FROM ev WHERE event_type = 'search'""")
def dq_failing_rows(spark, sf):
    rows = quality.failing(I.events(spark, sf), F.col("event_type").isin(_TYPES), "accepted_values:event_type")
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_ids"))


@query("""SELECT count(*) + 7 AS n_checks, count(*) FILTER (WHERE n > 0) + (SELECT CAST(avg(CAST(f0 IS NULL AS INTEGER)) > 0.01 AS INTEGER) FROM snap) + (SELECT CAST(count(*) < 100 AS INTEGER) FROM snap) AS n_failed,
 count(*) FILTER (WHERE n > 0) + (SELECT CAST(count(*) < 100 AS INTEGER) FROM snap) = 0 AS ok FROM (SELECT count(*) AS n FROM ev WHERE event_type = 'search')""")
def dq_verdict(spark, sf):
    return quality.verdict(dq_results(spark, sf))


@query(" UNION ALL ".join(f"SELECT 'f{k}' AS feature, avg(CAST(f{k} IS NULL AS INTEGER)) AS null_rate, round(avg(f{k}), 9) AS mean, round(median(f{k}), 9) AS median, min(f{k}) AS low, max(f{k}) AS high FROM snap" for k in (0, 1, 40, 82)))
def feature_profile(spark, sf):
    s, c = I.snapshot(spark, sf), ["f0", "f1", "f40", "f82"]
    rows = quality.null_rates(s, c).join(quality.means(s, c), "feature").join(quality.column_stats(s, c), "feature")
    return rows.withColumns({k: F.round(k, 9) for k in ("mean", "median")})


@query("SELECT feature, null_rate FROM (" + " UNION ALL ".join(f"SELECT 'f{k}' AS feature, avg(CAST(f{k} IS NULL AS INTEGER)) AS null_rate FROM snap" for k in range(83)) + ") ORDER BY null_rate DESC, feature LIMIT 10")
def worst_null_features(spark, sf):
    return quality.worst_null_rates(I.snapshot(spark, sf), lake.FEATURES, 10)


@query("""SELECT count(*) AS n_rows, CAST(sum(is_treat) AS BIGINT) AS n_treated, CAST(sum(label) AS BIGINT) AS n_positive, avg(is_treat) AS treatment_ratio, avg(label) AS conversion,
 avg(label) FILTER (WHERE is_treat = 1) AS conversion_treated, avg(label) FILTER (WHERE is_treat = 0) AS conversion_control FROM snap""")
def training_stats(spark, sf):
    return quality.check_trainable(I.snapshot(spark, sf), 100)


@query()
def table_checksum(spark, sf):
    return quality.checksum(I.snapshot(spark, sf), ["user_id", "label", *lake.FEATURES[:5]])


@query("""SELECT DISTINCT user_id FROM snap WHERE split = 'train' AND user_id IN (SELECT user_id FROM ev WHERE CAST(event_id AS BIGINT) % 50 = 0)""")
def contamination_check(spark, sf):
    synthetic = I.events(spark, sf).where(F.col("event_id").cast("long") % 50 == 0)
    return quality.contaminated(I.snapshot(spark, sf).where("split = 'train'"), synthetic, "user_id")


@query("""SELECT event_type AS target, count(*) FILTER (WHERE value >= 50) AS passed, count(*) FILTER (WHERE value < 50) AS failed, epoch_us(max(ts)) AS last_us FROM events WHERE ts >= TIMESTAMP '2024-01-30' GROUP BY event_type""")
def dq_rollup(spark, sf):
    results = I.read(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("checked_at"), F.col("event_type").alias("target"), (F.col("value") >= 50).alias("passed"))
    r = quality.rollup(results, F.lit("2024-01-30").cast("timestamp"))
    return r.select("target", "passed", "failed", F.unix_micros("last_checked").alias("last_us"))


@query("""SELECT rule, n FROM (SELECT 'payload_keys' AS rule, count(*) AS n FROM events WHERE len(json_keys(props)) <> 1
UNION ALL SELECT 'label_key', count(*) FROM events WHERE json_exists(props, '$.label')
UNION ALL SELECT 'train_only', count(*) FROM snap WHERE split <> 'train'
UNION ALL SELECT 'positive_value', count(*) FROM events WHERE value <= 1)""")
def constraint_checks(spark, sf):
    e, s = I.read(spark, sf, "events"), I.snapshot(spark, sf)
    rows = e.agg(
        F.count_if(S.json_key_count(F.col("props")) != 1).alias("payload_keys"), F.count_if(F.get_json_object("props", "$.label").isNotNull()).alias("label_key"),
        F.count_if(F.col("value") <= 1).alias("positive_value"),
    ).crossJoin(s.agg(F.count_if(F.col("split") != "train").alias("train_only")))
    return rows.unpivot([], ["payload_keys", "label_key", "train_only", "positive_value"], "rule", "n")


@query("""SELECT 'events' AS source, count(*) AS n_rows, 'ready' AS state FROM events UNION ALL SELECT 'no_rows', 0, 'empty' UNION ALL SELECT 'not_there', 0, 'missing'""")
def source_readiness(spark, sf):
    e = I.read(spark, sf, "events")
    return quality.source_readiness({"events": e, "no_rows": e.where("event_id < 0"), "not_there": None})


@query("""SELECT count(*) AS n, quantile_cont(s, 0.5) AS p50_s, quantile_cont(s, 0.95) AS p95_s, max(s) AS max_s FROM (SELECT CAST(epoch_us(ingested_at) - epoch_us(event_ts) AS DOUBLE) / 1e6 AS s FROM landed)""")
def ingest_lag(spark, sf):
    seconds = F.round((F.col("ingested_at") - F.col("event_ts")) * 1e6) / 1e6
    return quality.lag_percentiles(I.landed_events(spark, sf), seconds)


@query("""SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM ev GROUP BY event_type""")
def event_counters(spark, sf):
    return I.events(spark, sf).groupBy("event_type").agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"))


# Publication

_KEYS = ["f0", "f1", "f9"]


@query()
def hash_shards(spark, sf):
    s = publish.with_shards(I.snapshot(spark, sf), "user_id", 8)
    return s.groupBy("shard_id").agg(F.count("*").alias("n_rows"))


@query("""SELECT user_id, f0, f1 FROM snap""")
def publish_version(spark, sf):
    """Written by shard, twice (a retry overwrites), and read back."""
    root = I.scratch(spark, "publish")
    rows = I.snapshot(spark, sf).select("user_id", "f0", "f1")
    publish.publish(rows, root, "v20240130", "user_id", 8)
    return publish.publish(rows, root, "v20240130", "user_id", 8).select("user_id", "f0", "f1")


@query(" UNION ALL ".join(f"SELECT '{f}' AS feature, count(*) FILTER (WHERE CAST(substr(user_id, 2) AS BIGINT) % 9 <> 0) AS n_compared, count(*) FILTER (WHERE CAST(substr(user_id, 2) AS BIGINT) % 9 <> 0 AND CAST(substr(user_id, 2) AS BIGINT) % 4 = 0 AND {f} IS NOT NULL) AS n_mismatched, count(*) FILTER (WHERE CAST(substr(user_id, 2) AS BIGINT) % 9 = 0) AS n_missing FROM snap" for f in _KEYS))
def validate_published(spark, sf):
    """A published copy that lacks every ninth user and is off by 0.01 in every fourth."""
    s = I.snapshot(spark, sf).select("user_id", *_KEYS)
    k = F.substring("user_id", 2, 20).cast("long")
    copy = s.where(k % 9 != 0).withColumns({c: F.when(k % 4 == 0, F.col(c) + 0.01).otherwise(F.col(c)) for c in _KEYS})
    return quality.reconcile(s, copy, "user_id", _KEYS, 1e-4)


def _syncs(spark, sf):
    """One sync a day of events, as many shards as hours with events."""
    e = I.read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    day = F.to_date("ts")
    d = e.groupBy(day.alias("day")).agg(F.count("*").alias("expected_rows"))
    n = F.dayofmonth("day")
    return d.select(
        F.concat(F.lit("v"), F.date_format("day", "yyyyMMdd")).alias("feature_version"), F.lit(24).alias("total_shards"), "expected_rows",
        F.when(n % 4 != 0, "validated").otherwise("failed").alias("status"), F.when(n % 3 == 0, F.date_format("day", "yyyy-MM-dd")).alias("activated_at"), F.col("day").alias("created_at"), F.col("day").alias("finished_at"),
    )


def _shards(spark, sf):
    """Attempts at the shards: an event of the hour is an attempt, its value over 20 a success."""
    e = I.read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(
        F.concat(F.lit("v"), F.date_format("ts", "yyyyMMdd")).alias("feature_version"), F.hour("ts").alias("shard_id"), F.when(F.col("value") > 20, "success").otherwise("failed").alias("status"),
        F.col("event_id").alias("rows_written"), F.lit(1).alias("attempt"), F.col("ts").alias("updated_at"),
    )


_SYNC = """WITH sync AS (SELECT 'v' || strftime(CAST(ts AS DATE), '%Y%m%d') AS feature_version, 24 AS total_shards, count(*) AS expected_rows, CASE WHEN day(CAST(ts AS DATE)) % 4 <> 0 THEN 'validated' ELSE 'failed' END AS status,
 CASE WHEN day(CAST(ts AS DATE)) % 3 = 0 THEN strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS activated_at, CAST(ts AS DATE) AS created_at FROM events GROUP BY CAST(ts AS DATE)),
shard AS (SELECT 'v' || strftime(ts, '%Y%m%d') AS feature_version, CAST(hour(ts) AS INTEGER) AS shard_id, CASE WHEN value > 20 THEN 'success' ELSE 'failed' END AS status, event_id AS rows_written, ts AS updated_at FROM events),
now AS (SELECT * FROM shard QUALIFY row_number() OVER (PARTITION BY feature_version, shard_id ORDER BY updated_at DESC) = 1),
tot AS (SELECT feature_version, count(*) FILTER (WHERE status = 'success') AS completed_shards, CAST(coalesce(sum(rows_written) FILTER (WHERE status = 'success'), 0) AS BIGINT) AS written_rows FROM now GROUP BY feature_version)"""


@query(f"""{_SYNC} SELECT feature_version, CAST(s.shard_id AS INTEGER) AS shard_id FROM (SELECT DISTINCT feature_version, unnest(range(0, 25)) AS shard_id FROM sync) s
 WHERE NOT EXISTS (SELECT 1 FROM shard d WHERE d.feature_version = s.feature_version AND d.shard_id = s.shard_id AND d.status = 'success')""")
def pending_shards(spark, sf):
    planned = _syncs(spark, sf).select("feature_version", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("shard_id"))
    return publish.pending_shards(planned, _shards(spark, sf))


@query(f"""{_SYNC} SELECT sync.feature_version, total_shards, expected_rows, coalesce(completed_shards, 0) AS completed_shards, coalesce(written_rows, 0) AS written_rows, round(100.0 * coalesce(completed_shards, 0) / total_shards, 2) AS percent
 FROM sync LEFT JOIN tot ON tot.feature_version = sync.feature_version""")
def sync_progress(spark, sf):
    p = publish.progress(publish.shard_totals(_syncs(spark, sf), _shards(spark, sf)))
    return p.select("feature_version", "total_shards", "expected_rows", "completed_shards", "written_rows", "percent")


@query(f"""{_SYNC} SELECT feature_version, attempts, CAST(shard_id AS INTEGER) AS shard_id, status FROM now JOIN (SELECT feature_version, shard_id, count(*) AS attempts FROM shard GROUP BY ALL) USING (feature_version, shard_id)""")
def audit_current(spark, sf):
    a = publish.audit_state(_shards(spark, sf), ["feature_version", "shard_id"])
    return a.select("feature_version", "shard_id", "attempts", "status")


@query(f"""{_SYNC} SELECT feature_version FROM sync JOIN tot USING (feature_version) WHERE status = 'validated' AND completed_shards >= 12""")
def activatable_versions(spark, sf):
    s = publish.shard_totals(_syncs(spark, sf), _shards(spark, sf)).withColumn("total_shards", F.least("completed_shards", F.lit(12))).withColumn("completed_shards", F.least("completed_shards", F.lit(12)))
    return publish.activatable(s.where("total_shards = 12")).select("feature_version")


@query(f"""{_SYNC} SELECT arg_max(feature_version, activated_at) AS feature_version, max(activated_at) AS activated_at FROM sync WHERE activated_at IS NOT NULL""")
def active_pointer(spark, sf):
    return publish.active_version(_syncs(spark, sf))


def _pointer(spark, sf):
    return publish.active_version(_syncs(spark, sf)).select(F.col("feature_version").alias("active_version"))


@query(f"""{_SYNC} SELECT feature_version, activated_at FROM sync WHERE activated_at IS NOT NULL AND feature_version <> (SELECT arg_max(feature_version, activated_at) FROM sync WHERE activated_at IS NOT NULL) ORDER BY activated_at DESC LIMIT 1""")
def rollback_target(spark, sf):
    return publish.rollback_target(_syncs(spark, sf), _pointer(spark, sf))


@query(f"""{_SYNC} SELECT feature_version FROM (SELECT *, row_number() OVER (ORDER BY created_at DESC) AS nth FROM sync) WHERE nth > 2 AND feature_version <> (SELECT arg_max(feature_version, activated_at) FROM sync WHERE activated_at IS NOT NULL)""")
def version_gc(spark, sf):
    return publish.expired(_syncs(spark, sf), _pointer(spark, sf), 2).select("feature_version")


@query(f"""{_SYNC} SELECT feature_version, 'retired' AS status FROM sync WHERE feature_version NOT IN (SELECT feature_version FROM sync ORDER BY created_at DESC LIMIT 3)""")
def retired_versions(spark, sf):
    keep = _syncs(spark, sf).orderBy(F.desc("created_at")).limit(3)
    return publish.retire(_syncs(spark, sf), keep).select("feature_version", "status")


@query("""SELECT a AS published_rows, b AS mart_rows, CAST(abs(a - b) AS DOUBLE) / b AS gap, CAST(abs(a - b) AS DOUBLE) / b <= 0.01 AS ok FROM (SELECT count(*) FILTER (WHERE CAST(substr(user_id, 2) AS BIGINT) % 200 <> 1) AS a, count(*) AS b FROM snap)""")
def volume_check(spark, sf):
    s = I.snapshot(spark, sf)
    return quality.volume(s.where(F.substring("user_id", 2, 20).cast("long") % 200 != 1), s, 0.01)


@query("""SELECT user_id FROM (SELECT DISTINCT user_id FROM snap) ORDER BY sha256(user_id) LIMIT 100""")
def sampled_users(spark, sf):
    return publish.sample_keys(I.snapshot(spark, sf), "user_id", 100)


@query("""SELECT CAST(coalesce(max(dt) FILTER (WHERE dt = DATE '2030-01-01'), max(dt)) AS VARCHAR) AS dt FROM snap""")
def latest_partition(spark, sf):
    return publish.latest_partition(I.snapshot(spark, sf), "2030-01-01").select(F.col("dt").cast("string").alias("dt"))


@query("""SELECT CAST(ts AS DATE)::VARCHAR AS day, 'v' || strftime(ts, '%Y%m%d') AS version, count(*) AS n FROM events GROUP BY ALL""")
def version_names(spark, sf):
    e = I.read(spark, sf, "events")
    spelling = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyyMMdd")).otherwise(F.date_format("ts", "yyyy/MM/dd"))
    v = S.version_of(spelling)
    return e.select(S.date_of(v).cast("string").alias("day"), v.alias("version")).groupBy("day", "version").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS status, count(*) AS n_runs, round(avg(value), 6) AS mean_s FROM events GROUP BY 1""")
def run_summary(spark, sf):
    e = I.read(spark, sf, "events").withColumn("started_at", F.col("ts").cast("timestamp"))
    end = F.timestamp_micros(F.unix_micros("started_at") + F.round(F.col("value") * 1e6).cast("long"))
    runs = e.select(F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("status"), "started_at", end.alias("finished_at"))
    return quality.run_summary(runs).withColumn("mean_s", F.round("mean_s", 6))


@query("""WITH e AS (SELECT 'part-' || CAST(p_size AS VARCHAR) AS table_name, count(*) AS expected_rows FROM part GROUP BY p_size), a AS (SELECT 'part-' || CAST(p_size AS VARCHAR) AS table_name, count(*) AS actual_rows FROM part WHERE p_partkey % 100 <> 7 GROUP BY p_size)
SELECT table_name, expected_rows, actual_rows, coalesce(expected_rows = actual_rows, false) AS matches FROM e FULL JOIN a USING (table_name)""")
def reconcile_counts(spark, sf):
    p = I.read(spark, sf, "part")
    count = lambda d: d.groupBy(F.concat(F.lit("part-"), F.col("p_size")).alias("table_name")).agg(F.count("*").alias("rows"))
    return lake.reconcile_counts(count(p), count(p.where("p_partkey % 100 <> 7")))


# Lineage: runs are customers, a run's parent its key halved; two runs that point at each other, and one that is its own parent.

def _runs(spark, sf):
    k = F.col("c_custkey")
    tree = I.read(spark, sf, "customer").select(
        k.cast("string").alias("run_id"), F.when(k > 1, F.floor(k / 2).cast("string")).alias("parent_run_id"), F.when(k % 37 == 5, "synthetic").otherwise("real").alias("source_type"),
        F.when(k % 101 == 50, "wrong").when(k == 0, "0").otherwise("1").alias("root_run_id"),
    )
    odd = spark.createDataFrame([("x1", "x2", "real", "x1"), ("x2", "x1", "real", "x1"), ("x3", "x3", "real", "x3")], tree.schema)
    return tree.union(odd)


_RUNS = """runs AS (SELECT CAST(c_custkey AS VARCHAR) AS run_id, CASE WHEN c_custkey > 1 THEN CAST(c_custkey // 2 AS VARCHAR) END AS parent_run_id, CASE WHEN c_custkey % 37 = 5 THEN 'synthetic' ELSE 'real' END AS source_type,
 CASE WHEN c_custkey % 101 = 50 THEN 'wrong' WHEN c_custkey = 0 THEN '0' ELSE '1' END AS root FROM customer UNION ALL VALUES ('x1', 'x2', 'real', 'x1'), ('x2', 'x1', 'real', 'x1'), ('x3', 'x3', 'real', 'x3')),
up(start_run, run, parent, depth, path, is_cycle, source_type, root) AS (SELECT run_id, run_id, parent_run_id, 0, [run_id], false, source_type, root FROM runs
 UNION ALL SELECT up.start_run, r.run_id, r.parent_run_id, up.depth + 1, list_append(up.path, r.run_id), list_contains(up.path, r.run_id), r.source_type, r.root FROM up JOIN runs r ON r.run_id = up.parent WHERE NOT up.is_cycle AND up.depth < 64)"""


@query(f"WITH {_RUNS} SELECT start_run, run, depth, array_to_string(path, '/') AS path, is_cycle FROM up", True)
def lineage_walk(spark, sf):
    return lineage.walk(spark, _runs(spark, sf)).select("start_run", "run", "depth", F.concat_ws("/", "path").alias("path"), "is_cycle")


@query(f"WITH {_RUNS} SELECT DISTINCT start_run FROM up WHERE is_cycle", True)
def lineage_cycles(spark, sf):
    return lineage.cycles(lineage.ends(_runs(spark, sf)))


@query(f"""WITH {_RUNS} SELECT t.start_run, r.root, t.top FROM (SELECT start_run, arg_max(run, depth) AS top, bool_or(is_cycle) AS c FROM up GROUP BY start_run) t JOIN runs r ON r.run_id = t.start_run WHERE NOT c AND r.root IS DISTINCT FROM t.top""", True)
def single_root(spark, sf):
    runs = _runs(spark, sf)
    return lineage.wrong_roots(runs, lineage.ends(runs))


@query(f"""WITH {_RUNS} SELECT start_run, max(depth) AS depth FROM up GROUP BY start_run HAVING bool_and(source_type = 'real')""", True)
def real_roots(spark, sf):
    return lineage.real_roots(lineage.ends(_runs(spark, sf)))


@query(f"""WITH {_RUNS} SELECT r.run_id, CASE WHEN r.run_id = r.parent_run_id THEN 'self_parent' ELSE 'real_from_synthetic' END AS reason FROM runs r LEFT JOIN runs p ON p.run_id = r.parent_run_id
 WHERE r.run_id = r.parent_run_id OR (r.source_type = 'real' AND p.source_type <> 'real')""", True)
def ineligible_runs(spark, sf):
    return lineage.ineligible(_runs(spark, sf))


# Reconstruction: customers' targets from small counts, some of them contradictory.

SEED = 7
REFERENCE = "2024-01-30 23:59:59"


def _targets(spark, sf):
    k = F.col("c_custkey")
    n5, n18 = k % 23 + 1, k % 11 + 1
    d1 = F.when(k % 41 == 7, -1).otherwise(k % 45)
    return I.read(spark, sf, "customer").select(
        F.concat(F.lit("r"), k).alias("target_id"), F.ln(n5.cast("double")).alias("f5"), F.round(F.log10(n18.cast("double")), 6).alias("f18"),
        d1.cast("double").alias("f1"), (k % 45 % 7).cast("double").alias("f2"), F.round(F.log10((k % 29 + 1).cast("double")), 6).alias("f30"),
    )


def _decoded(spark, sf):
    return reconstruct.decode(_targets(spark, sf))


def _plans(spark, sf):
    ready, _ = reconstruct.solvable(_decoded(spark, sf))
    return reconstruct.plan(ready, SEED).withColumn("reference_ts", F.lit(REFERENCE).cast("timestamp"))


def _kept_plans(spark, sf):
    """Plans for queries that need them more than once: made once and read by target, so that what is joined to them stays where it is."""
    made = lake.written(_plans(spark, sf), "plans")
    return made.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "target_id")


_TARGETS = """WITH t AS (SELECT 'r' || c_custkey AS target_id, c_custkey % 23 + 1 AS n5, c_custkey % 11 + 1 AS n18, CAST(CASE WHEN c_custkey % 41 = 7 THEN -1 ELSE c_custkey % 45 END AS INTEGER) AS d1, CAST(c_custkey % 45 % 7 AS INTEGER) AS d2, c_custkey % 29 + 1 AS n30 FROM customer),
u AS (SELECT *, list_sort(list_distinct(list_filter([d1, d2], lambda d: d < 30))) AS forced FROM t),
dec AS (SELECT *, CAST(len(forced) AS BIGINT) AS nf, CASE WHEN d1 < d2 THEN 'first_after_last' WHEN n30 < len(forced) THEN 'forced_days' END AS reason FROM u),
ok AS (SELECT *, greatest(0, n30 - nf - n5 - n18) AS free_min, CAST(len(list_distinct([d1, d2])) - nf AS BIGINT) AS n_out FROM dec WHERE reason IS NULL),
bnd2 AS (SELECT *, n5 + n18 + nf + free_min AS n_inside FROM ok)"""


@query(f"{_TARGETS} SELECT target_id, n5, n18, n30, d1, d2, reason FROM dec")
def decode_targets(spark, sf):
    return _decoded(spark, sf).select("target_id", "n5", "n18", "n30", "d1", "d2", "reason")


@query(f"{_TARGETS} SELECT reason, count(*) AS n FROM dec WHERE reason IS NOT NULL GROUP BY reason")
def quarantine(spark, sf):
    return reconstruct.solvable(_decoded(spark, sf))[1].groupBy("reason").agg(F.count("*").alias("n"))


@query(f"{_TARGETS} SELECT target_id, free_min, CAST(n_out + greatest(n30, ceil(n_inside / 5.0)) AS BIGINT) AS sessions_min FROM bnd2")
def objective_bound(spark, sf):
    return reconstruct.bound(reconstruct.solvable(_decoded(spark, sf))[0]).select("target_id", "free_min", "sessions_min")


_PLAN = f"""{_TARGETS}, pool AS (SELECT target_id, d, row_number() OVER (PARTITION BY target_id ORDER BY sha256(target_id || chr(31) || '{SEED}' || chr(31) || 'A' || chr(31) || 'day' || d)) AS nth FROM bnd2, unnest(range(0, 30)) AS p(d) WHERE NOT list_contains(forced, CAST(d AS INTEGER))),
days AS (SELECT b.*, CAST(d AS INTEGER) AS day, false AS is_forced FROM bnd2 b JOIN pool p ON p.target_id = b.target_id AND p.nth <= n30 - nf UNION ALL SELECT b.*, d, true FROM bnd2 b, unnest(forced) AS q(d)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY day) - 1 AS i FROM days),
room AS (SELECT *, 1 + greatest(0, least(4, n_inside - n30 - 4 * i)) + CASE WHEN i = 0 THEN greatest(0, n_inside - n30 - 4 * n30) ELSE 0 END - CAST(is_forced AS INTEGER) AS r FROM ranked),
acc AS (SELECT *, coalesce(sum(r) OVER (PARTITION BY target_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM room),
want AS (SELECT target_id, 'f5' AS reason, 0 AS a, n5 AS b FROM bnd2 UNION ALL SELECT target_id, 'f18', n5, n5 + n18 FROM bnd2 UNION ALL SELECT target_id, 'FREE', n5 + n18, n5 + n18 + free_min FROM bnd2),
slot AS (SELECT acc.target_id, want.reason, day, CAST(least(b, low + r) - greatest(a, low) AS BIGINT) AS n FROM acc JOIN want USING (target_id) WHERE least(b, low + r) > greatest(a, low)
 UNION ALL SELECT target_id, 'recency', d, 1 FROM bnd2, unnest(list_distinct([d1, d2])) AS q(d))"""


@query(f"{_PLAN} SELECT target_id, reason, day, n FROM slot")
def witness_plan(spark, sf):
    return reconstruct.merged_slots(_plans(spark, sf))


_EVENTS = f"""{_PLAN}, one AS (SELECT target_id, reason, day, sub_index FROM slot, unnest(range(0, n)) AS q(sub_index)),
nth AS (SELECT *, row_number() OVER (PARTITION BY target_id, reason ORDER BY day, sub_index) - 1 AS occurrence FROM one),
drawn AS (SELECT *, CASE WHEN day = 0 THEN 86399 ELSE 86400 END AS upper, sha256('{SEED}' || chr(31) || reason || chr(31) || day || chr(31) || sub_index) AS h FROM nth),
made AS (SELECT *, epoch(TIMESTAMP '2024-01-30') - day * 86400 + CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % upper AS made_s FROM drawn)"""


@query(f"""{_EVENTS} SELECT target_id, CASE reason WHEN 'f5' THEN 'EVT_F5' WHEN 'f18' THEN 'EVT_F18' WHEN 'recency' THEN 'EVT_ORDER_PAID' ELSE 'EVT_SESSION_STARTED' END AS event_type, CAST(made_s AS BIGINT) AS event_s, reason AS gen_reason, occurrence,
 substr(g, 1, 8) || '-' || substr(g, 9, 4) || '-5' || substr(g, 14, 3) || '-' || substr('89ab', 1 + CAST(('0x' || substr(g, 17, 1)) AS INTEGER) % 4, 1) || substr(g, 18, 3) || '-' || substr(g, 21, 12) AS event_id
FROM (SELECT *, sha1(from_hex('{S.EVENT_NAMESPACE}') || encode(target_id || ':A:' || reason || ':' || occurrence)) AS g FROM made)""")
def witness_events(spark, sf):
    e = reconstruct.canonical_order(reconstruct.materialise(_plans(spark, sf), SEED))
    return e.select("target_id", "event_type", F.unix_seconds("event_ts").alias("event_s"), "gen_reason", F.col("occurrence").cast("long").alias("occurrence"), "event_id")


@query(f"""{_PLAN} SELECT target_id, count(*) AS active_days, count(*) FILTER (WHERE day < 30) AS days_in_window, CAST(sum(ceil(n / 5.0)) AS BIGINT) AS sessions, CAST(sum(free) AS BIGINT) AS unexplained
FROM (SELECT target_id, day, sum(n) AS n, coalesce(sum(n) FILTER (WHERE reason = 'FREE'), 0) AS free FROM slot GROUP BY target_id, day) GROUP BY target_id""")
def witness_metrics(spark, sf):
    return reconstruct.metrics(_plans(spark, sf))


def _gated(spark, sf):
    plans = _kept_plans(spark, sf)
    made = reconstruct.materialise(plans, SEED)
    return plans, made, reconstruct.gate_a(plans.select("target_id", "f1", "f2", "f5", "f18"), plans.select("target_id", "reference_ts"), made)


@query(f"{_TARGETS} SELECT feature, count(*) AS n, count(*) AS n_ok FROM ok, unnest(['f1', 'f2', 'f5', 'f18']) AS q(feature) GROUP BY feature")
def gate_a(spark, sf):
    return reconstruct.gate_summary(_gated(spark, sf)[2])


_NTH = "CAST(substr(target_id, 2) AS BIGINT)"


@query(f"{_TARGETS} SELECT target_id, {_NTH} % 7 <> 0 AS before_reference, {_NTH} % 13 <> 0 AS feasible, {_NTH} % 11 <> 0 AS provenance, true AS no_label, true AS sane_volume FROM ok")
def gates_b_to_f(spark, sf):
    """Some plans lose their first slot, some events come too late or from elsewhere: the gates must say so."""
    plans, made, _ = _gated(spark, sf)
    nth = F.substring("target_id", 2, 20).cast("long")
    plans = plans.withColumn("slots", F.when(nth % 13 == 0, F.slice("slots", F.lit(2), F.size("slots"))).otherwise(F.col("slots")))
    late = (nth % 7 == 0) & (F.col("gen_reason") == "f5") & (F.col("occurrence") == 0)
    made = made.withColumn("event_ts", F.when(late, F.col("event_ts") + F.make_dt_interval(F.lit(400))).otherwise(F.col("event_ts")))
    made = made.withColumn("source_type", F.when(nth % 11 == 0, "imported").otherwise(F.col("source_type")))
    return reconstruct.gates_b_to_f(plans, made)


@query(f"{_EVENTS} SELECT target_id, n5, n18, CAST(max(made_s) AS BIGINT) AS last_s, CAST(substr(target_id, 2) AS INTEGER) % 5 AS segment FROM made JOIN ok USING (target_id) GROUP BY target_id, n5, n18")
def handoff_state(spark, sf):
    plans, made, gated = _gated(spark, sf)
    levels = plans.select("target_id", F.lit("segment").alias("attr_name"), (F.substring("target_id", 2, 20).cast("int") % 5).alias("level_id"))
    h = reconstruct.handoff(plans, made, levels, gated, reconstruct.gates_b_to_f(plans, made))
    return h.select("target_id", F.col("counters")["n5"].alias("n5"), F.col("counters")["n18"].alias("n18"), F.unix_seconds("last_event_ts").alias("last_s"), F.col("attributes")["segment"].alias("segment"))


@query("""SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 13 = 0) AS n_tampered, count(*) AS n_hashes FROM customer""")
def row_fingerprint(spark, sf):
    t = reconstruct.sealed(_targets(spark, sf), ["target_id"], ["f1", "f2", "f5", "f18", "f30"])
    changed = t.withColumn("f2", F.when(F.substring("target_id", 2, 20).cast("int") % 13 == 0, F.col("f2") + 1).otherwise(F.col("f2")))
    bad = reconstruct.tampered(changed, ["target_id"], ["f1", "f2", "f5", "f18", "f30"]).agg(F.count("*").alias("n_tampered"))
    return t.agg(F.count("*").alias("n"), F.countDistinct("target_hash").alias("n_hashes")).crossJoin(bad)


# Streaming

_NOW = "2024-01-20 12:00:00"


def _messages(spark, sf):
    return messages(I.dealt(I.read(spark, sf, "events"), "event_id").withColumn("ts", F.col("ts").cast("timestamp")))


def messages(e):
    """Events as JSON messages, some of them broken in one way or another."""
    n = F.col("event_id") % 20
    body = F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.when(n == 1, F.lit(None)).otherwise(F.concat(F.when(n == 2, "X").otherwise("U"), F.col("user_id"))).alias("user_id"),
        F.when(n == 3, "teleport").otherwise(I._when("event_type", I.KINDS)).alias("event_type"), F.when(n == 4, F.lit("soon")).otherwise(S.epoch_seconds(F.col("ts")).cast("decimal(20,6)").cast("string")).alias("event_ts"),
        F.concat(F.lit("s"), F.floor(F.col("event_id") / 50)).alias("session_id"), F.col("value").alias("price"), F.lit(1).alias("quantity"),
    )
    return e.select(F.when(n == 0, "{broken").otherwise(F.to_json(body)).alias("value"), (F.col("event_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))


_REASON = "CASE event_id % 20 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'missing_field:user_id' WHEN 2 THEN 'bad_user_id' WHEN 3 THEN 'unknown_event_type:teleport' WHEN 4 THEN 'bad_event_ts' END"


@query(f"SELECT {_REASON} AS reason, count(*) AS n FROM events GROUP BY 1")
def stream_routing(spark, sf):
    return stream.decode(_messages(spark, sf)).groupBy("reason").agg(F.count("*").alias("n"))


def _scratch(spark) -> str:
    return I.scratch(spark, "stream")


_TAKEN = "SELECT event_id, 'U' || user_id AS user_id, event_type, ts AS event_ts, value AS price FROM events WHERE event_id % 20 > 4"


def _stream_of(spark, sf, columns: str):
    # As a pattern, since a stream's plain path must be a folder.
    return stream.file_source(spark, f"{sf}/events.parquet*", columns)


_RAW = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _streamed_events(spark, sf):
    """The events table read as a stream, as typed events."""
    e = _stream_of(spark, sf, _RAW)
    return e.select(
        F.col("event_id").cast("string").alias("event_id"), F.concat(F.lit("U"), F.col("user_id")).alias("user_id"), I._when("event_type", I.KINDS).alias("event_type"), F.col("ts").cast("timestamp").alias("event_ts"),
        F.concat(F.lit("s"), F.floor(F.col("event_id") / 50)).alias("session_id"), F.col("value").alias("price"), F.lit(1).alias("quantity"),
    )


@query(f"SELECT {_REASON} AS reason, CAST(event_id AS VARCHAR) AS event_id FROM events WHERE event_id % 20 < 5")
def stream_dlq(spark, sf):
    """Micro-batches landed by their place in the log; the dead letters read back."""
    root = _scratch(spark)
    raw = _stream_of(spark, sf, _RAW).withColumn("ts", F.date_trunc("day", F.col("ts").cast("timestamp")))
    messages_in = messages(raw)
    run = messages_in.writeStream.foreachBatch(lambda b, i: stream.land(b, i, f"{root}/lake", f"{root}/dlq")).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    dead = stream.dead_letters(spark, f"{root}/dlq")
    return dead.select("reason", F.col("offset").cast("string").alias("event_id"))


@query("SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids FROM events")
def stream_dedup(spark, sf):
    """Every event twice in the stream; once after the replay filter."""
    root = _scratch(spark)
    twice = _streamed_events(spark, sf).select("event_id", "event_ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    rows = stream.run_to_table(stream.drop_replays(twice.drop("copy")), f"{root}/out", f"{root}/state")
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_ids"))


_BUCKETS = """WITH e AS (SELECT 'U' || user_id AS user_id, CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'voucher_claim' ELSE 'search' END AS event_type, ts, value FROM events),
b AS (SELECT user_id, CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS bucket, count(*) AS events, count(*) FILTER (WHERE event_type = 'page_view') AS page_view, count(*) FILTER (WHERE event_type = 'order') AS orders,
 coalesce(sum(value) FILTER (WHERE event_type = 'order'), 0.0) AS gmv, max(ts) AS last_ts FROM e GROUP BY ALL)"""


@query(f"{_BUCKETS} SELECT user_id, bucket, events, page_view, round(gmv, 4) AS gmv FROM b")
def stream_bucket_5m(spark, sf):
    """Five-minute counters in update mode: the last state of each bucket, by a sink that upserts."""
    root = _scratch(spark)
    counted = stream.buckets(_streamed_events(spark, sf).withWatermark("event_ts", stream.WATERMARK))
    run = counted.writeStream.outputMode("update").foreachBatch(lambda b, i: stream.upsert(b, i, f"{root}/overlay", ["user_id", "bucket"], "events"))
    run = run.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    rows = stream.last_state(spark, f"{root}/overlay")
    return rows.select("user_id", F.unix_seconds("bucket").alias("bucket"), "events", "page_view", F.round("gmv", 4).alias("gmv"))


def _overlay(spark, sf, now=None):
    e = I.read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = e.select(F.concat(F.lit("U"), F.col("user_id")).alias("user_id"), I._when("event_type", I.KINDS).alias("event_type"), F.col("ts").alias("event_ts"), F.col("value").alias("price"), F.lit(1).alias("quantity"))
    now = S.epoch_seconds(F.lit(_NOW).cast("timestamp")) if now is None else now
    return stream.overlay(stream.buckets(rows), now), now


_OVER = f"""{_BUCKETS}, o AS (SELECT user_id, CAST(sum(events) AS BIGINT) AS rt_events_1h, CAST(sum(page_view) AS BIGINT) AS rt_page_view_1h, CAST(coalesce(sum(page_view) FILTER (WHERE bucket = epoch(TIMESTAMP '{_NOW}')), 0) AS BIGINT) AS rt_page_view_5m, round(sum(gmv), 4) AS rt_gmv_1h, max(last_ts) AS last_ts
 FROM b WHERE bucket BETWEEN epoch(TIMESTAMP '{_NOW}') - 3300 AND epoch(TIMESTAMP '{_NOW}') GROUP BY user_id)"""


@query(f"{_OVER} SELECT user_id, rt_events_1h, rt_page_view_1h, rt_page_view_5m, rt_gmv_1h, epoch_us(last_ts) AS last_us FROM o")
def overlay_1h(spark, sf):
    o, _ = _overlay(spark, sf)
    return o.select("user_id", "rt_events_1h", "rt_page_view_1h", "rt_page_view_5m", F.round("rt_gmv_1h", 4).alias("rt_gmv_1h"), F.unix_micros("last_event_ts").alias("last_us"))


@query(f"{_OVER.replace(f"epoch(TIMESTAMP '{_NOW}')", '(SELECT floor(epoch(max(ts)) / 300) * 300 FROM events)')} SELECT user_id FROM o WHERE epoch_us(last_ts) >= (SELECT epoch_us(max(ts)) FROM events) - 300000000")
def active_users_5m(spark, sf):
    """Users active in the five minutes before the last event there is."""
    last = I.read(spark, sf, "events").agg(S.epoch_seconds(F.max("ts").cast("timestamp")).alias("s")).first().s
    o, now = _overlay(spark, sf, F.lit(last))
    return stream.active_users(stream.unexpired(o, now), now).select("user_id")


@query(f"""SELECT CASE WHEN epoch(ts) > epoch(TIMESTAMP '{_NOW}') + 300 THEN 'future_dropped' WHEN floor(epoch(ts) / 300) * 300 < floor(epoch(TIMESTAMP '{_NOW}') / 300) * 300 - 3300 THEN 'late_dropped'
 WHEN epoch(TIMESTAMP '{_NOW}') - epoch(ts) > 600 THEN 'late_accepted' ELSE 'applied' END AS action, count(*) AS n FROM events GROUP BY 1""")
def late_policy(spark, sf):
    now = S.epoch_seconds(F.lit(_NOW).cast("timestamp"))
    e = I.read(spark, sf, "events").select(stream.lateness(S.epoch_seconds(F.col("ts").cast("timestamp")), now).alias("action"))
    return e.groupBy("action").agg(F.count("*").alias("n"))


_SESSIONS = """SELECT user_id, session_id, CAST(epoch_us(b) - epoch_us(a) AS DOUBLE) / 1e6 AS session_len FROM (SELECT 'U' || user_id AS user_id, 's' || (event_id // 50) AS session_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY b DESC) = 1"""


@query(f"SELECT user_id, session_id, round(session_len, 3) AS session_len FROM ({_SESSIONS})")
def session_latest(spark, sf):
    e = I.read(spark, sf, "events").select(F.concat(F.lit("U"), F.col("user_id")).alias("user_id"), F.concat(F.lit("s"), F.floor(F.col("event_id") / 50)).alias("session_id"), F.col("ts").cast("timestamp").alias("event_ts"))
    return stream.latest_sessions(e).select("user_id", "session_id", F.round("session_len", 3).alias("session_len"))


@query(f"SELECT user_id, session_id, round(session_len, 3) AS session_len FROM ({_SESSIONS})")
def session_state(spark, sf):
    """The same by keyed state on a stream."""
    root = _scratch(spark)
    state = stream.session_state(_streamed_events(spark, sf).withWatermark("event_ts", stream.WATERMARK))

    def land(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/out/b={batch_id}")

    run = state.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    last = keep_first(spark.read.parquet(f"{root}/out"), ["user_id"], [F.desc("batch")])
    return last.select("user_id", "session_id", F.round("session_len", 3).alias("session_len"))


@query("SELECT event_id, price FROM landed QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at) = 1")
def compact_hour(spark, sf):
    return lake.compact(I.landed_events(spark, sf), "event_id", "ingested_at", 1).select("event_id", "price")


@query("""SELECT kafka_partition, kafka_offset FROM (SELECT event_id % 3 AS kafka_partition, event_id AS kafka_offset FROM events WHERE event_id % 500 = 3)""")
def replay_conflicts(spark, sf):
    first = I.landed_events(spark, sf)
    again = first.withColumn("price", F.when(F.col("kafka_offset") % 500 == 3, F.col("price") + 1).otherwise(F.col("price")))
    return lake.offset_conflicts(first, again.where("kafka_offset < 10000000")).select(F.col("kafka_partition").cast("long").alias("kafka_partition"), "kafka_offset")


# Uplift and decisions

_CUM = """WITH n AS (SELECT count(*) AS n FROM trial), o AS (SELECT *, CAST(CASE WHEN w = 1 THEN y ELSE -y END AS DOUBLE) AS best FROM trial)"""


def _curve(name: str, score: str) -> str:
    return f"""{name}a AS (SELECT row_number() OVER win AS i, sum(w) OVER win AS nt, sum(1 - w) OVER win AS nc, sum(y * w) OVER win AS yt, sum(y * (1 - w)) OVER win AS yc FROM o WINDOW win AS (ORDER BY {score} DESC, tie ROWS UNBOUNDED PRECEDING)),
{name} AS (SELECT i, i / CAST(n AS DOUBLE) AS x, (yt - yc * (CASE WHEN nc > 0 THEN nt / CAST(nc AS DOUBLE) ELSE 0 END)) / n AS qini,
 ((CASE WHEN nt > 0 THEN yt / CAST(nt AS DOUBLE) ELSE 0 END) - (CASE WHEN nc > 0 THEN yc / CAST(nc AS DOUBLE) ELSE 0 END)) * (nt + nc) / n AS gain FROM {name}a, n)"""


def _area(name: str, c: str) -> str:
    return f"(SELECT (sum({c}) - (arg_min({c}, i) + arg_max({c}, i)) / 2) / count(*) - arg_max({c}, i) / 2 FROM {name})"


@query(f"{_CUM}, {_curve('c', 'score')} SELECT i, round(x, 9) AS x, round(qini, 9) AS qini, round(gain, 9) AS gain FROM c")
def qini_curve(spark, sf):
    return uplift.curves(I.trial(spark, sf)).select("i", *(F.round(c, 9).alias(c) for c in ("x", "qini", "gain")))


@query(f"{_CUM}, {_curve('c', 'score')}, {_curve('b', 'best')} SELECT round({_area('c', 'qini')} / {_area('b', 'qini')}, 6) AS qini, round({_area('c', 'gain')} / {_area('b', 'gain')}, 6) AS auuc")
def auuc(spark, sf):
    return uplift.scores(I.trial(spark, sf)).select(F.round("qini", 6).alias("qini"), F.round("auuc", 6).alias("auuc"))


_TOP = "SELECT {0} AS share, count(*) AS n, round(avg(y) FILTER (WHERE w = 1) - avg(y) FILTER (WHERE w = 0), 9) AS uplift FROM (SELECT *, row_number() OVER (ORDER BY score DESC, tie) AS i FROM trial) WHERE i <= greatest(1, round_even({0} * (SELECT count(*) FROM trial), 0))"


@query(" UNION ALL ".join(_TOP.format(k) for k in ("0.1", "0.2", "0.3")))
def uplift_at_k(spark, sf):
    return uplift.uplift_at(I.trial(spark, sf), [0.1, 0.2, 0.3]).withColumn("uplift", F.round("uplift", 9))


@query("""SELECT n_treat, n_control, round(p1 - p0, 9) AS ate, round(sqrt(p1 * (1 - p1) / n_treat + p0 * (1 - p0) / n_control), 9) AS se, round(p1 - p0 - 1.959963984540054 * sqrt(p1 * (1 - p1) / n_treat + p0 * (1 - p0) / n_control), 9) AS ci_low,
 round(p1 - p0 + 1.959963984540054 * sqrt(p1 * (1 - p1) / n_treat + p0 * (1 - p0) / n_control), 9) AS ci_high FROM (SELECT count(*) FILTER (WHERE w = 1) AS n_treat, count(*) FILTER (WHERE w = 0) AS n_control, avg(y) FILTER (WHERE w = 1) AS p1, avg(y) FILTER (WHERE w = 0) AS p0 FROM trial)""")
def ate_ci(spark, sf):
    a = uplift.average_effect(I.trial(spark, sf))
    return a.withColumns({c: F.round(c, 9) for c in ("ate", "se", "ci_low", "ci_high")})


@query("""WITH p AS (SELECT *, greatest(0.071, least(0.929, score)) AS e, 0.05 AS m0, 0.05 + 0.3 * score AS m1 FROM trial) SELECT key, round(m1 - m0 + w * (y - m1) / e - (1 - w) * (y - m0) / (1 - e), 9) AS dr FROM p""")
def dr_pseudo_outcome(spark, sf):
    dr = uplift.pseudo_outcome(F.col("score"), F.lit(0.05), 0.05 + 0.3 * F.col("score"), F.col("y"), F.col("w"))
    return I.trial(spark, sf).select("key", F.round(dr, 9).alias("dr"))


_DRAW = "CAST(('0x' || substr(sha256('42{0}|' || tie), 1, 8)) AS BIGINT) / 4294967296.0"
_BROKEN = "-score"


def _sane(name: str, score: str) -> tuple[str, str]:
    """The four curves of a score, and the five flags from them."""
    ways = {"own": score, "rnd": _DRAW.format("r"), "noi": f"{score} + ({_DRAW.format('a')} + {_DRAW.format('b')} + {_DRAW.format('c')} - 1.5) * (2 * (SELECT stddev_pop({score}) FROM trial) * 5)", "ora": "best"}
    q = {k: f"({_area(name + k, 'qini')} / {_area(name + 'ora', 'qini')})" for k in ways}
    head = ", ".join(_curve(name + k, v) for k, v in ways.items())
    return head, f"SELECT '{name}' AS score, abs({q['rnd']}) < 0.05 AS random_near_zero, {q['ora']} > {q['rnd']} AS oracle_beats_random, abs({q['ora']} - 1) < 1e-9 AS oracle_is_one, {q['noi']} < {q['own']} + 1e-9 AS noise_lowers, {q['own']} > {q['rnd']} AS better_than_random"


_SANE, _TURNED = _sane("right", "score"), _sane("broken", _BROKEN)


@query(f"{_CUM}, {_SANE[0]}, {_TURNED[0]} {_SANE[1]} UNION ALL {_TURNED[1]}")
def metric_sanity(spark, sf):
    """The metric on the trial's score, and on one turned upside down, which must fail it."""
    t = I.trial(spark, sf).withColumn("broken", -F.col("score"))
    return uplift.sanity_of(t, {"right": "score", "broken": "broken"})


@query("""WITH f AS (SELECT key, y, w, (row_number() OVER (PARTITION BY w, y ORDER BY sha256('42|' || key)) - 1) % 5 AS fold FROM trial) SELECT CAST(fold AS INTEGER) AS fold, w, y, count(*) AS n FROM f GROUP BY ALL""")
def stratified_folds(spark, sf):
    return uplift.folds(I.trial(spark, sf), "key", 5, 42).groupBy("fold", "w", "y").agg(F.count("*").alias("n"))


@query()
def dr_learner(spark, sf):
    """Cross-fitted learner on the trial; decisions by its effect."""
    t = I.trial(spark, sf).withColumn("noise", F.conv(F.substring(F.md5(F.concat(F.lit("n"), F.col("key"))), 1, 4), 16, 10).cast("double"))
    model = uplift.dr_learner(t, ["score", "noise"], "key")
    scored = model.transform(uplift.assemble(t, ["score", "noise"]))
    decision, voucher = uplift.decide(F.col("cate"))
    return scored.select("key", "cate", decision.alias("decision"), voucher.alias("voucher"))


@query("""SELECT user_id, CASE WHEN f1 IS NULL THEN 'NO_DECISION' WHEN f1 - 0.5 >= 0.0070347543 THEN 'SEND_VOUCHER' ELSE 'NO_VOUCHER' END AS decision, CASE WHEN f1 - 0.5 >= 0.0070347543 THEN 'voucher_30' ELSE 'no_voucher' END AS voucher FROM snap""")
def batch_decisions(spark, sf):
    decision, voucher = uplift.decide(F.col("f1") - 0.5)
    return I.snapshot(spark, sf).select("user_id", decision.alias("decision"), voucher.alias("voucher"))


@query("""WITH v AS (SELECT arg_max('v' || strftime(d, '%Y%m%d'), d) AS active FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE day(CAST(ts AS DATE)) % 3 = 0))
SELECT user_id, active AS feature_version, f0, f1, CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 3 = 0 THEN 1 END AS rt_order_1h FROM snap, v""")
def serving_read(spark, sf):
    s = I.snapshot(spark, sf).select("user_id", "f0", "f1")
    pointer = _pointer(spark, sf)
    # Two versions are published; readers see the active one only.
    published = s.crossJoin(F.broadcast(_syncs(spark, sf).orderBy(F.desc("activated_at"), "feature_version").limit(2).select("feature_version")))
    over = s.where(F.substring("user_id", 2, 20).cast("long") % 3 == 0).select("user_id", F.lit(1).alias("rt_order_1h"))
    return publish.serve(pointer, published, over, "user_id").select("user_id", "feature_version", "f0", "f1", "rt_order_1h")


@query("""SELECT user_id FROM snap WHERE CAST(('0x' || substr(sha256(user_id), 1, 8)) AS BIGINT) < 0.25 * 4294967296""")
def decision_log(spark, sf):
    return uplift.log_sample(I.snapshot(spark, sf), 0.25, "user_id").select("user_id")
