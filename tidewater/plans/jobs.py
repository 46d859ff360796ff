"""Queries of jobs that store what they do (publication, checks, audit, models, CSV and partitions), each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import checks, marts, publish, reconstruct, uplift
from tidewater.operators.staging import keep_first
from tidewater.plans import inputs as I
from tidewater.plans import operations as O
from tidewater.plans.inputs import sql
from tidewater.sources import lake

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(oracle: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql(oracle)
        return f

    return register


# Publication

class _Died(Exception):
    pass


@query("""SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, CAST(4 AS BIGINT) AS n_first, CAST(4 AS BIGINT) AS n_second, CAST(0 AS BIGINT) AS n_third, CAST(count(*) AS BIGINT) AS n_logged, CAST(1 AS BIGINT) AS most_attempts FROM snap""")
def resumed_publication(spark, sf):
    """Eight shards, two at once; the first run dies after four, the second writes the others, a third finds nothing to do."""
    root = I.scratch(spark, "resume")
    rows = I.snapshot(spark, sf).select("user_id", "f0", "f1")
    done: list[int] = []

    def die(shards):
        done.extend(shards)
        if len(done) == 4:
            raise _Died

    try:
        publish.resume(rows, f"{root}/features", f"{root}/log", "v1", "user_id", 8, 2, die)
    except _Died:
        pass
    second, third = (publish.resume(rows, f"{root}/features", f"{root}/log", "v1", "user_id", 8, 2) for _ in range(2))
    log = publish.shard_log(spark, f"{root}/log").where("status = 'success'")
    logged = log.agg(F.sum("rows_written").alias("n_logged"), F.max("attempt").cast("long").alias("most_attempts"))
    there = spark.read.parquet(f"{root}/features").agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"))
    numbers = {"n_first": len(done), "n_second": len(second), "n_third": len(third)}
    return there.crossJoin(logged).withColumns({k: F.lit(v).cast("long") for k, v in numbers.items()})


@query("""SELECT kind, key, status, attempts FROM (SELECT 'run' AS kind, strftime(d, '%Y-%m-%d') AS key, CASE WHEN day(d) % 4 <> 0 THEN 'done' ELSE 'started' END AS status, CAST(CASE WHEN day(d) % 4 <> 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
UNION ALL SELECT 'sync', 'v' || strftime(d, '%Y%m%d'), CASE WHEN day(d) % 3 = 0 THEN 'activated' ELSE 'validated' END, CAST(CASE WHEN day(d) % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events))""")
def audit_runs(spark, sf):
    """Runs that start and end and syncs that are validated and activated, as rows of one log; where each stands."""
    log = f"{I.scratch(spark, 'audit')}/log"
    syncs = O._syncs(spark, sf)
    at = lambda n: F.timestamp_seconds(F.lit(n))
    day = F.date_format("created_at", "yyyy-MM-dd").alias("day")
    publish.record(log, "run", syncs.select(day), "started", at(1))
    publish.record(log, "run", syncs.where("status = 'validated'").select(day), "done", at(2))
    publish.record(log, "sync", syncs.select("feature_version"), "validated", at(1))
    publish.record(log, "sync", syncs.where("activated_at IS NOT NULL").select("feature_version"), "activated", at(2))
    return publish.audit_state(spark.read.parquet(log), ["kind", "key"]).select("kind", "key", "status", "attempts")


# Checks

_RULES = {"known_type": ("event_type <> 'search'", "error", 0.0), "price_below_90": ("price < 90", "warn", 0.25), "has_user": ("user_id IS NOT NULL", "error", 0.0), "two_or_more": ("quantity >= 2", "error", 0.0)}


def _checked(spark, sf):
    root = I.scratch(spark, "checks")
    rules = [checks.Rule(name, F.expr(holds), severity, limit) for name, (holds, severity, limit) in _RULES.items()]
    for _ in range(2):  # the failures of a run that comes again replace its own
        checks.run(I.events(spark, sf), "events", rules, ["event_id", "user_id"], I.DAY, f"{root}/failures", f"{root}/results")
    return checks.stored(spark, f"{root}/failures"), checks.results(spark, f"{root}/results")


@query(" UNION ALL ".join(f"SELECT '{name}' AS check_name, event_id, user_id FROM ev WHERE NOT coalesce({holds}, false)" for name, (holds, _, _) in _RULES.items()))
def dq_stored_failures(spark, sf):
    """Failing rows of all rules, stored by check in one scan and read back."""
    return _checked(spark, sf)[0].select("check_name", "event_id", "user_id")


@query(" UNION ALL ".join(f"""SELECT '{name}' AS check_name, '{severity}' AS severity, {f"n_failed / CAST(n_rows AS DOUBLE) <= {limit}" if limit else "n_failed = 0"} AS passed, round({"n_failed / CAST(n_rows AS DOUBLE)" if limit else "CAST(n_failed AS DOUBLE)"}, 9) AS observed,
 CAST({limit} AS DOUBLE) AS threshold, n_rows, n_failed, CAST(2 AS BIGINT) AS n_runs FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce({holds}, false)) AS n_failed FROM ev)""" for name, (holds, severity, limit) in _RULES.items()))
def dq_stored_results(spark, sf):
    """Result rows appended by two runs: each check's last one, with the counts of its details."""
    r = _checked(spark, sf)[1]
    last = keep_first(r.withColumn("n_runs", F.count("*").over(Window.partitionBy("check_name"))), ["check_name"], [F.desc("checked_at")])
    count = lambda k: F.get_json_object("details", f"$.{k}").cast("long").alias(k)
    return last.select("check_name", "severity", "passed", F.round("observed", 9).alias("observed"), "threshold", count("n_rows"), count("n_failed"), "n_runs")


# Models

def _fitted(spark, sf):
    """A learner of the trial, saved and loaded again, and the one it was."""
    path = f"{I.scratch(spark, 'learner')}/model"
    t = lake.written(I.trial(spark, sf).select("key", "y", "w", F.col("score").alias("f1"), "tie"), "trial")
    learner = uplift.dr_fit(t, ["f1"], "key", n_folds=2, trees=8, depth=3)
    uplift.save(learner, path)
    return t, learner, uplift.load(spark, path)


@query("""WITH b AS (SELECT CAST(least(2, floor(score * 3)) AS BIGINT) AS third, y, w FROM trial), u AS (SELECT third, count(*) AS n, avg(y) FILTER (WHERE w = 1) - avg(y) FILTER (WHERE w = 0) AS e FROM b GROUP BY third)
SELECT third, n, e > 0 AS positive, coalesce(e > lag(e) OVER (ORDER BY third), true) AS above_lower FROM u""")
def learner_effects(spark, sf):
    """By thirds of the feature: whether the saved learner's mean effect is positive and above the third below, as the outcomes' own is."""
    t, _, loaded = _fitted(spark, sf)
    third = F.least(F.lit(2), F.floor(F.col("f1") * 3)).cast("long")
    means = uplift.effects(loaded, t).groupBy(third.alias("third")).agg(F.count("*").alias("n"), F.avg("cate").alias("e"))
    before = F.lag("e").over(Window.orderBy("third"))  # three rows
    return means.select("third", "n", (F.col("e") > 0).alias("positive"), F.coalesce(F.col("e") > before, F.lit(True)).alias("above_lower"))


@query("""WITH f AS (SELECT key, w, y, CAST((row_number() OVER (PARTITION BY w, y ORDER BY sha256('42|' || key)) - 1) % 2 AS INTEGER) AS fold FROM trial)
SELECT fold, count(*) AS n, count(*) AS n_predicted, CAST(0 AS BIGINT) AS n_seen FROM f GROUP BY fold""")
def learner_folds(spark, sf):
    """Each fold's rows, those that its models predicted, and those of its keys among the rows that they were fitted on."""
    t = lake.written(I.trial(spark, sf).select("key", "y", "w", F.col("score").alias("f1")), "trial")
    ready = uplift.assemble(lake.written(uplift.folds(t, "key", 2, 42), "folds"), ["f1"])
    nuisance = {name: model for k in range(2) for name, model in uplift.fit_fold(ready, k, 42, 3, 3).items()}
    predicted = uplift.out_of_fold(ready, nuisance)
    in_range = F.col("e").between(0, 1) & F.col("mu0").between(0, 1) & F.col("mu1").between(0, 1)
    own = predicted.groupBy("fold").agg(F.count("*").alias("n"), F.count_if(in_range).alias("n_predicted"))
    fitted = uplift.others(ready, 0).select("key", F.lit(0).alias("fold")).union(uplift.others(ready, 1).select("key", F.lit(1)))
    seen = fitted.join(predicted.select("key", "fold"), ["key", "fold"], "left_semi").groupBy("fold").agg(F.count("*").alias("n_seen"))
    return own.join(seen, "fold", "left").select("fold", "n", "n_predicted", F.coalesce("n_seen", F.lit(0).cast("long")).alias("n_seen"))


@query("""WITH m AS (SELECT user_id, coalesce(CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 3 = 0 THEN f2 END, f1) AS f1 FROM snap)
SELECT user_id, CASE WHEN f1 IS NULL THEN 'NO_DECISION' END AS undecided, true AS follows, true AS same FROM m""")
def learner_decisions(spark, sf):
    """Batch decisions by the saved learner over merged rows: realtime value first, then batch; none without either.

    ``follows`` says that the decision is the threshold's for the effect, ``same`` that the loaded model
    predicts what the fitted one does.
    """
    _, fitted, loaded = _fitted(spark, sf)
    s = I.snapshot(spark, sf)
    over = s.where((F.substring("user_id", 2, 20).cast("long") % 3 == 0) & F.col("f2").isNotNull()).select("user_id", F.col("f2").alias("f1"))
    merged = marts.merge_overlay(s.select("user_id", "f1"), over, {"f1": None}, "user_id")
    decided = uplift.decide_rows(loaded, merged)
    again = uplift.effects(fitted, merged).select("user_id", F.col("cate").alias("fitted"))
    rows = decided.join(again, "user_id")
    expected = F.when(F.col("f1").isNull(), "NO_DECISION").when(F.col("cate") >= uplift.DEFAULT_THRESHOLD, "SEND_VOUCHER").otherwise("NO_VOUCHER")
    undecided = F.when(F.col("decision") == "NO_DECISION", F.col("decision"))
    same = F.col("f1").isNull() | (F.col("cate") == F.col("fitted"))
    return rows.select("user_id", undecided.alias("undecided"), (F.col("decision") == expected).alias("follows"), same.alias("same"))


# Reconstruction where f30 counts events of its own

_OWN = O._TARGETS.replace("CASE WHEN d1 < d2 THEN 'first_after_last' WHEN n30 < len(forced) THEN 'forced_days' END", "CASE WHEN d1 < d2 THEN 'first_after_last' END")


@query(f"""{_OWN}, own AS (SELECT target_id, greatest(nf, 1) AS k, CAST(len(list_distinct([d1, d2])) - nf AS BIGINT) AS outside, n5 + n18 + n30 + nf AS inside FROM dec WHERE reason IS NULL)
SELECT target_id, CAST(outside + k AS BIGINT) AS days_min, CAST(outside + greatest(k, ceil(inside / 5.0)) AS BIGINT) AS sessions_min, {O._NTH} % 13 <> 0 AND {O._NTH} % 11 <> 0 AS feasible FROM own""")
def own_counter_feasible(spark, sf):
    """Plans of the second branch; every 13th has lost its last slot and every 11th has a free event, and the check must say so."""
    ready, _ = reconstruct.solvable(reconstruct.own_counter(O._decoded(spark, sf)))
    plans = reconstruct.plan(ready, O.SEED, branch=reconstruct.OWN)
    nth = F.substring("target_id", 2, 20).cast("long")
    lost = F.slice("slots", F.lit(1), F.size("slots") - 1)
    free = F.concat("slots", F.array(F.struct(F.lit(reconstruct.FREE).alias("reason"), F.col("slots")[0]["day"].alias("day"), F.lit(1).cast("long").alias("n"))))
    plans = plans.withColumn("slots", F.when(nth % 13 == 0, lost).when(nth % 11 == 0, free).otherwise(F.col("slots")))
    return plans.select("target_id", "days_min", "sessions_min").join(reconstruct.feasible_own(plans), "target_id")


@query(f"{_OWN} SELECT target_id, n5, n18, n30, CAST(len(list_distinct([d1, d2])) AS BIGINT) AS n_recent, CAST(0 AS BIGINT) AS n_free FROM dec WHERE reason IS NULL")
def own_counter_events(spark, sf):
    """Events of the second branch's plans, counted by what made them."""
    ready, _ = reconstruct.solvable(reconstruct.own_counter(O._decoded(spark, sf)))
    plans = reconstruct.plan(ready, O.SEED, branch=reconstruct.OWN).withColumn("reference_ts", F.lit(O.REFERENCE).cast("timestamp"))
    count = lambda reason: F.count_if(F.col("gen_reason") == reason)
    names = {"n5": "f5", "n18": "f18", "n30": "f30", "n_recent": reconstruct.RECENCY, "n_free": reconstruct.FREE}
    return reconstruct.materialise(plans, O.SEED).groupBy("target_id").agg(*(count(r).alias(k) for k, r in names.items()))


# Files

@query("SELECT user_id, split, label, is_treat, f0, f82, DATE '2024-01-30'::VARCHAR AS dt FROM snap")
def csv_splits(spark, sf):
    """Both splits as CSV with header, read with their schema; a third, which isn't there, is skipped."""
    root = I.scratch(spark, "csv")
    s = I.snapshot(spark, sf).select("data_id", "label", "is_treat", *lake.FEATURES, "split")
    for name in ("train", "test"):
        s.where(F.col("split") == name).drop("split").write.csv(f"{root}/{name}", header=True)
    rows = lake.load_splits(spark, {k: f"{root}/{k}" for k in ("train", "test", "gone")}, I.DAY)
    return rows.select("user_id", "split", "label", "is_treat", "f0", "f82", F.col("dt").cast("string").alias("dt"))


@query("SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS n_rows, count(DISTINCT user_id) AS users, CAST(1 AS BIGINT) AS files, true AS has_bytes FROM snap GROUP BY dt")
def partition_profile(spark, sf):
    """The snapshot written by day, one day of it twice; rows, users and files behind each partition."""
    root = I.scratch(spark, "days")
    s = I.snapshot(spark, sf).select("user_id", "f0", "dt")
    lake.write_partitions(s, root, ["dt"])
    lake.write_partitions(s.where(F.col("dt") == F.to_date(F.lit(I.DAY))), root, ["dt"])
    p = lake.partition_profile(spark.read.parquet(root), "dt", "user_id")
    return p.select(F.col("dt").cast("string").alias("dt"), F.col("rows").alias("n_rows"), "users", "files", (F.col("bytes") > 0).alias("has_bytes"))
