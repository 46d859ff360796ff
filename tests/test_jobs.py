"""Jobs that store what they do: restarts, replays, expiry, and plans against brute force."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewater.operators import checks, publish, reconstruct, uplift
from tidewater.streaming import decisions, health
from tidewater.streaming import events as stream


def test_a_run_that_dies_in_a_job_costs_that_job(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select(F.col("id").cast("string").alias("user_id"), F.rand(1).alias("f0"))
    log, calls = publish._log_shards, []

    def dies(d, path):
        calls.append(1)
        if len(calls) == 4:  # the second job's shards are written, not committed
            raise RuntimeError("killed")
        log(d, path)

    go = lambda: publish.resume(rows, f"{tmp_path}/out", f"{tmp_path}/log", "v1", "user_id", 6, 2)
    monkeypatch.setattr(publish, "_log_shards", dies)
    with pytest.raises(RuntimeError):
        go()
    monkeypatch.undo()
    done = lambda: publish.shard_log(spark, f"{tmp_path}/log").where("status = 'success'")
    assert done().count() == 2
    assert len(go()) == 4 and go() == []
    tries = {r.shard_id: r.n for r in done().groupBy("shard_id").agg(F.max("attempt").alias("n")).collect()}
    assert sorted(tries.values()) == [1, 1, 1, 1, 2, 2]
    there = spark.read.parquet(f"{tmp_path}/out")
    assert there.count() == 300 and there.select("user_id").distinct().count() == 300
    assert publish.shard_log(spark, f"{tmp_path}/none").count() == 0


def test_checks_read_once_and_store_what_fails(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, 7)], "id int, v int")
    rules = [checks.Rule("positive", F.col("v") > 0), checks.Rule("mostly_small", F.col("v") < 6, "warn", 0.5), checks.Rule("any", F.lit(True))]
    for _ in range(2):
        checks.run(rows, "t", rules, ["id"], "2024-01-30", f"{tmp_path}/bad", f"{tmp_path}/results")
    bad = {(r.check_name, r.id) for r in checks.stored(spark, f"{tmp_path}/bad").collect()}
    assert bad == {("positive", 2), ("positive", 3), ("mostly_small", 2), ("mostly_small", 4)} and checks.stored(spark, f"{tmp_path}/bad").count() == 4
    got = checks.results(spark, f"{tmp_path}/results").collect()
    assert len(got) == 6 and {(r.check_name, r.passed, r.observed) for r in got} == {("positive", False, 2.0), ("mostly_small", True, 0.5), ("any", True, 0.0)}
    assert json.loads(next(r.details for r in got if r.check_name == "positive")) == {"n_rows": 4, "n_failed": 2, "stored": "day=2024-01-30/target=t/check_name=positive"}
    empty = checks.run(rows.limit(0), "none", rules, ["id"], "2024-01-30", f"{tmp_path}/bad", f"{tmp_path}/results")
    assert {r.passed for r in empty.collect()} == {True}


def test_a_learner_comes_back_as_it_was(spark, tmp_path):
    u = lambda s: F.conv(F.substring(F.md5(F.concat(F.lit(s), F.col("key"))), 1, 6), 16, 10).cast("double") / 2**24
    t = spark.range(3000).select(F.col("id").alias("key")).withColumns({"w": (u("w") < 0.5).cast("int"), "x": u("x")})
    t = t.withColumn("y", (u("y") < 0.1 + 0.5 * F.col("x") * F.col("w")).cast("int")).persist()
    learner = uplift.dr_fit(t, ["x"], "key", n_folds=2, trees=4, depth=2)
    uplift.save(learner, str(tmp_path))
    loaded = uplift.load(spark, str(tmp_path))
    assert loaded.features == ["x"] and sorted(loaded.nuisance) == sorted(learner.nuisance)
    some = spark.createDataFrame([(0.05,), (0.95,), (None,)], "x double")
    a, b = ([r.cate for r in uplift.effects(m, some).collect()] for m in (learner, loaded))
    assert a == b and a[0] < a[1]
    assert [r.decision for r in uplift.decide_rows(loaded, some, threshold=(a[0] + a[1]) / 2).collect()] == ["NO_VOUCHER", "SEND_VOUCHER", "NO_DECISION"]


def _fewest(n, forced_days, outside):
    """The least (active days, sessions) over all ways to put ``n`` more events on days 0 to 3, by trial."""
    best = None
    for days in itertools.product(range(n + 1), repeat=4):
        if sum(days) != n:
            continue
        full = [d + (k in forced_days) for k, d in enumerate(days)]
        cost = (sum(x > 0 for x in full) + outside, sum(math.ceil(x / 5) for x in full) + outside)
        best = cost if best is None or cost < best else best
    return best


def test_own_counter_bound_against_brute_force(spark):
    r = random.Random(3)
    rows, wanted = [], {}
    for k in range(60):
        n5, n30, d1 = r.randrange(1, 6), r.randrange(1, 9), r.choice([0, 1, 3, 40])
        d2 = r.choice([d for d in (0, 1, 3, 40, 41) if d <= d1])
        rows.append((f"t{k}", math.log(n5), math.log10(n30), float(d1), float(d2)))
        forced = {d for d in (d1, d2) if d < 30}
        wanted[f"t{k}"] = _fewest(n5 + n30, forced, len({d1, d2} - forced))
    decoded = reconstruct.own_counter(reconstruct.decode(spark.createDataFrame(rows, "target_id string, f5 double, f30 double, f1 double, f2 double")))
    plans = reconstruct.plan(reconstruct.solvable(decoded)[0], 1, branch=reconstruct.OWN)
    got = {x.target_id: (x.days_min, x.sessions_min) for x in plans.collect()}
    assert got == wanted
    assert {x.feasible for x in reconstruct.feasible_own(plans).collect()} == {True}
    over = spark.createDataFrame([("a", 0.0, math.log10(31), 1.0, 1.0), ("b", 0.0, 0.0, 9.0, 2.0)], "target_id string, f5 double, f30 double, f1 double, f2 double")
    assert {x.target_id: x.reason for x in reconstruct.own_counter(reconstruct.decode(over)).collect()} == {"a": "above_cap", "b": None}


def test_late_policy_on_a_users_state():
    state, counts = {"clock": 0.0, "buckets": {}}, dict.fromkeys(decisions.ACTIONS, 0)
    now = 1_700_000_000.0 // 300 * 300 + 100
    step = lambda *rows: decisions.apply(state, list(rows), counts)
    step((now, "a", now - 10, "order", 5.0), (now, "b", now + 301, "search", 0.0), (now, "c", now - 3400, "search", 0.0), (now, "d", now - 3700, "search", 0.0), (now + 1, "a", now - 10, "order", 5.0))
    assert counts == {"applied": 2, "deduplicated": 1, "late_accepted": 1, "late_dropped": 1, "future_dropped": 1}
    last, values = decisions.hour(state)
    assert last == now - 10 and dict(zip(decisions.VALUES, values, strict=True)) == {"events": 2, "page_view": 0, "add_to_cart": 0, "order": 1, "search_cnt": 1, "gmv": 5.0}
    step((now + 300, "e", now + 300, "page_view", 0.0))  # the oldest bucket leaves the hour
    assert decisions.hour(state)[1][0] == 2 and len(state["buckets"]) == 2
    step((now + 310, "c", now - 3400, "search", 0.0))
    assert counts["late_dropped"] == 2


EVENT = "event_id string, user_id string, event_type string, event_ts timestamp, ingested_at timestamp, price double, quantity int"


def test_state_of_silent_users_goes_by_timer(spark, tmp_path):
    root = str(tmp_path)
    at = lambda minutes: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    parts = [[("a", "U1", 0)], [("b", "U2", 400)], [("c", "U2", 401)], [("a", "U1", 0)], [("d", "U3", 402)]]
    totals = []
    for rows in parts:
        spark.createDataFrame([(i, u, "order", at(m), at(m), 1.0, 1) for i, u, m in rows], EVENT).coalesce(1).write.mode("append").parquet(f"{root}/in")
        events = stream.file_source(spark, f"{root}/in", EVENT).withWatermark("event_ts", "10 minutes")
        decisions.start_deciding(events, root, f"{root}/checkpoint", lambda b: b.select("user_id"), once=True).awaitTermination()
        seen = {r.action: r.n for r in decisions.actions(spark.read.parquet(f"{root}/overlay")).collect()}
        totals.append((seen["applied"], seen["deduplicated"]))
    assert totals[:3] == [(1, 0), (2, 0), (3, 0)]
    # U1's first event came again after its state had gone by timer: nothing remembers it, or the watermark drops it.
    assert totals[3][1] == 0


def test_decisions_take_overlay_then_version_then_default(spark):
    over = spark.createDataFrame([("U1", 1000.0, 900.0, 3.0), ("U2", 1000.0, 500.0, 9.0), ("U3", 1000.0, 1000.0, None)], "user_id string, as_of double, last_event_s double, rt_events_1h double")
    published = spark.createDataFrame([("U1", "v1", 0.2), ("U1", "v2", 0.4), ("U2", "v2", 0.4)], "user_id string, feature_version string, f1 double")
    pointer = spark.createDataFrame([("v2",)], "active_version string")
    got = decisions.decide_active(over, pointer, published, {"f1": -1.0, "rt_events_1h": 0.0}, decisions.constant(spark, F.col("f1") + F.col("rt_events_1h")), 0.0)
    assert {r.user_id: (r.feature_version, r.score, r.decision) for r in got.collect()} == {"U1": ("v2", 3.4, "SEND_VOUCHER"), "U3": (None, -1.0, "NO_VOUCHER")}


def test_health_checks(spark, tmp_path):
    rows = spark.createDataFrame([("U1", dt.datetime(2024, 1, 1)), ("U2", dt.datetime(2024, 1, 1, 0, 20))], "user_id string, last_event_ts timestamp")
    rows.coalesce(1).write.parquet(f"{tmp_path}/t")
    there, now = spark.read.parquet(f"{tmp_path}/t"), F.unix_seconds(F.lit("2024-01-01 00:20:00").cast("timestamp"))
    log = spark.createDataFrame([("q", 0, 5, 1.0, 299.0, 400.0)], health.LAG_ROW)
    made = health.health([health.new_files(there, F.lit("2000-01-01").cast("timestamp")), health.new_files(there, F.lit("2100-01-01").cast("timestamp")), health.lag_below(log), health.overlay_age(there, now), health.overlay_age(there, now, keys=0)])
    assert [(r.check_name, r.passed) for r in made.collect()] == [("new_files", True), ("new_files", False), ("p95_lag", True), ("overlay_age", False), ("overlay_age", False)]


def test_fits_read_cells_that_stand_for_all_rows(spark):
    t = spark.range(6000).select((F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 2).cast("int").alias("w"), (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 1999 / 7.0).alias("x"), (F.col("id") % 11).cast("double").alias("z"))
    t = t.withColumn("z", F.when(F.col("z") != 4, F.col("z")))
    small = uplift.cells(t, ["x", "z"])
    assert small.agg(F.sum("n")).first()[0] == 6000 and small.count() < 6000
    assert small.select("x").distinct().count() == uplift.BINS and {r.z for r in small.select("z").distinct().collect()} == {0, 1, 2, 3, 5, 6, 7, 8, 9, 10}
    # A model of cells cuts only half way between bins, so that rows and their cells are predicted alike.
    model = uplift.fit_fold(uplift.assemble(small, ["x", "z"]), 0, 42, 3, 3)[0, "e"]
    both = [[r.p for r in model.transform(uplift.assemble(rows, ["x", "z"])).select("id", F.round(vector_to_array("probability")[1], 12).alias("p")).orderBy("id").collect()] for rows in (t.withColumn("id", F.hash("fold", "w", "y", "x", "z")), uplift.snapped(t.withColumn("id", F.hash("fold", "w", "y", "x", "z")), ["x", "z"]))]
    assert sorted(both[0]) == sorted(both[1])


def test_a_node_of_weighted_cells_needs_as_many_rows(spark):
    cell = spark.createDataFrame([(0, 60.0), (1, 60.0)], "x int, n double")
    assert uplift._least(cell, 3, 50)["maxDepth"] == 3 and uplift._least(cell, 3, 61) == {"maxDepth": 0, "weightCol": "n"}
    assert uplift._least(cell.drop("n"), 3, 50) == {"minInstancesPerNode": 50, "maxDepth": 3}


def test_users_of_a_group_share_an_access_to_state_and_expire_one_by_one():
    from types import SimpleNamespace

    class Handle:
        def __init__(self):
            self.state, self.timers, self.updates = None, set(), 0

        def getValueState(self, *_):
            return self

        def get(self):
            return self.state

        def update(self, state):
            self.state, self.updates = state, self.updates + 1

        def clear(self):
            self.state = None

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    from pyspark.sql import Row

    handle, hours = Handle(), decisions.LastHour()
    hours.init(handle)
    row = lambda user, at: Row(user_id=user, arrival_s=at, event_id=f"{user}{at}", event_s=at, event_type="order", amount=2.0)
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    out = list(hours.handleInputRows((1,), iter([row("a", 300.0), row(None, 6000.0), row("a", 310.0)]), at(0)))
    assert [(r.user_id, r.rt_events_1h, r.rt_gmv_1h, r.applied) for r in out] == [("a", 2, 4.0, 2), (None, 1, 2.0, 1)]
    assert handle.updates == 1 and handle.timers == {3_900_000}
    handle.timers.clear()
    assert list(hours.handleExpiredTimer((1,), at(3_900_000), None)) == [] and handle.timers == {9_600_000}
    again = list(hours.handleInputRows((1,), iter([row(None, 6001.0)]), at(3_900_000)))
    assert [(r.user_id, r.rt_events_1h) for r in again] == [(None, 2)]
    handle.timers.clear()
    hours.handleExpiredTimer((1,), at(9_600_000), None)
    assert handle.state is None and not handle.timers
