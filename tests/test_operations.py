from __future__ import annotations

import itertools
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.operators import lineage, publish, quality, reconstruct, uplift
from tidewater.streaming import events as stream


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_checks_become_rows_and_a_verdict(spark):
    d = spark.createDataFrame([(1, 2.0), (None, -1.0)], "k int, v double")
    r = quality.run_checks(d, [quality.not_null("d", "k"), quality.at_least_zero("d", "v", "warn"), quality.min_rows("d", 2)])
    assert {x.check_name: x.passed for x in r.collect()} == {"not_null:k": False, "at_least_zero:v": False, "min_rows": True}
    assert tuple(quality.verdict(r).first()) == (3, 2, False)
    assert tuple(quality.verdict(r.where("severity = 'warn'")).first()) == (1, 1, True)
    assert quality.checksum(d, ["k", "v"]).first() == quality.checksum(d.orderBy(F.desc("v")), ["k", "v"]).first()


def test_one_armed_data_is_refused(spark):
    d = spark.createDataFrame([(1, 1)] * 20, "label int, is_treat int")
    with pytest.raises(ValueError, match="not trainable"):
        quality.check_trainable(d, 10)


def test_publish_activate_roll_back(spark, tmp_path):
    data = spark.createDataFrame([(f"u{k}", float(k)) for k in range(20)], "user_id string, x double")
    root, pointer = str(tmp_path / "t"), str(tmp_path / "p")
    for v in ("v1", "v2"):
        publish.publish(data, root, v, "user_id", 4)
        publish.publish(data, root, v, "user_id", 4)
    assert rows(spark.read.parquet(root).groupBy("feature_version").count()) == [("v1", 20), ("v2", 20)]
    assert publish.activate(spark, pointer, "v1", "2024-01-01", None) is None
    assert publish.activate(spark, str(tmp_path / "p2"), "v2", "2024-01-02", spark.read.parquet(pointer)) == "v1"
    live = publish.serve(spark.read.parquet(pointer), spark.read.parquet(root), data.limit(0).select("user_id"), "user_id")
    assert live.count() == 20
    publish.delete_versions(spark, root, ["v1"])
    assert spark.read.parquet(root).select("feature_version").distinct().count() == 1


def test_lineage(spark):
    runs = spark.createDataFrame(
        [("a", None, "real", "a"), ("b", "a", "synthetic", "a"), ("c", "b", "real", "x"), ("p", "q", "real", "p"), ("q", "p", "real", "p"), ("s", "s", "real", "s")],
        "run_id string, parent_run_id string, source_type string, root_run_id string",
    )
    ended = lineage.ends(runs).persist()
    assert rows(lineage.cycles(ended)) == [("p",), ("q",), ("s",)]
    assert rows(lineage.wrong_roots(runs, ended)) == [("c", "x", "a")]
    assert "c" not in {r[0] for r in rows(lineage.real_roots(ended))}
    assert rows(lineage.ineligible(runs)) == [("c", "real_from_synthetic"), ("s", "self_parent")]


def _brute_bound(n5, n18, n30, d1, d2, window):
    """Least (free, sessions) over all ways to spread demand over days, by trying them."""
    forced = {d for d in (d1, d2) if d < window}
    best = None
    for days in itertools.combinations(range(window), n30):
        if not forced <= set(days):
            continue
        for free in range(n30 + 1):
            total = n5 + n18 + free
            for split in itertools.product(range(total + 1), repeat=len(days)):
                if sum(split) != total:
                    continue
                per = [s + (d in forced) for s, d in zip(split, days, strict=True)]
                if min(per) < 1:
                    continue
                sessions = sum(math.ceil(p / 5) for p in per) + len({d1, d2} - forced)
                best = min(best or (99, 99), (free, sessions))
    return best


def test_plans_reach_the_bound(spark, monkeypatch):
    monkeypatch.setattr(reconstruct, "WINDOW_DAYS", 4)
    cases = [(1, 1, 3, 0, 0), (3, 4, 2, 0, 0), (1, 1, 4, 9, 9), (2, 6, 2, 2, 1), (5, 5, 3, 3, 3), (4, 1, 3, 7, 1)]
    data = [(f"t{k}", math.log(a), math.log10(b), math.log10(c), float(d1), float(d2)) for k, (a, b, c, d1, d2) in enumerate(cases)]
    targets = spark.createDataFrame(data, "target_id string, f5 double, f18 double, f30 double, f1 double, f2 double")
    ready, bad = reconstruct.solvable(reconstruct.decode(targets))
    assert bad.isEmpty()
    plans = reconstruct.plan(ready, 1).persist()
    got = {r.target_id: (r.free_min, r.sessions_min) for r in plans.collect()}
    assert got == {f"t{k}": _brute_bound(*c, 4) for k, c in enumerate(cases)}
    assert all(r.feasible for r in reconstruct.feasible(plans).collect())
    again = reconstruct.plan(ready, 2)
    assert all(r.feasible for r in reconstruct.feasible(again).collect())


def test_contradictions_are_set_aside(spark):
    t = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 3.0), ("b", 0.0, 0.0, 9.0, 2.0), ("c", None, 0.0, 1.0, 1.0)], "target_id string, f5 double, f30 double, f1 double, f2 double")
    assert rows(reconstruct.decode(t).select("target_id", "reason")) == [("a", "first_after_last"), ("b", "forced_days"), ("c", "missing_value")]


@pytest.fixture(scope="module")
def trial(spark):
    u = lambda s: F.conv(F.substring(F.md5(F.concat(F.lit(s), F.col("id"))), 1, 6), 16, 10).cast("double") / 2**24
    d = spark.range(8000).withColumns({"w": (u("w") < 0.5).cast("int"), "score": u("s")})
    return d.withColumns({"y": (u("y") < 0.05 + 0.4 * F.col("score") * F.col("w")).cast("int"), "tie": F.md5(F.col("id").cast("string"))}).select("id", "y", "w", "score", "tie").persist()


def test_uplift_metrics(spark, trial):
    best = trial.withColumn("score", uplift.oracle(F.col("y"), F.col("w")))
    assert uplift.scores(best).first().qini == pytest.approx(1, abs=1e-9)
    good = uplift.scores(trial).first().qini
    assert good > 0 > uplift.scores(trial.withColumn("score", -F.col("score"))).first().qini
    assert tuple(uplift.sanity(trial).first()) == (True, True, True, True, True)
    everyone, ate = uplift.uplift_at(trial, 1.0).first(), uplift.average_effect(trial).first()
    assert everyone.uplift == pytest.approx(ate.ate) and ate.ci_low < ate.ate < ate.ci_high


def test_running_sums_equal_a_plain_sort(trial):
    r = uplift.running(trial, buckets=7).orderBy("i").select("i", "nt", "yt").collect()
    plain = sorted(trial.collect(), key=lambda x: (-x.score, x.tie))
    nt = list(itertools.accumulate(x.w for x in plain))
    yt = list(itertools.accumulate(x.w * x.y for x in plain))
    assert [tuple(x) for x in r] == list(zip(range(1, len(nt) + 1), nt, yt, strict=True))


def test_decisions(spark):
    d = spark.createDataFrame([(0.1,), (0.0,), (None,), (float("nan"),)], "s double")
    assert [r[0] for r in d.select(uplift.decide(F.col("s"))[0]).collect()] == ["SEND_VOUCHER", "NO_VOUCHER", "NO_DECISION", "NO_DECISION"]


def test_messages_are_routed(spark):
    ok = '{"event_id":"1","user_id":"U1","event_type":"order","event_ts":100.5}'
    bad = ['{broken', '[1]', None, '{"event_id":"1","event_type":"order","event_ts":1}', ok.replace("order", "jump"), ok.replace("100.5", "-1"), ok.replace("U1", "X1")]
    raw = spark.createDataFrame([(v, 0, k, datetime(2024, 1, 1)) for k, v in enumerate([ok, *bad])], "value string, partition int, offset long, timestamp timestamp")
    got = [r.reason for r in stream.decode(raw).orderBy("offset").collect()]
    assert got == [None, "invalid_json", "invalid_json", "invalid_json", "missing_field:user_id", "unknown_event_type:jump", "bad_event_ts", "bad_user_id"]
    assert stream.accepted(stream.decode(raw)).first().schema_version == 1


def test_late_and_future_events(spark):
    ages = {3700: "late_dropped", -301: "future_dropped", 700: "late_accepted", 10: "applied", -299: "applied"}
    now = 1_800_000_000.0
    d = spark.createDataFrame([(now - a,) for a in ages], "t double")
    assert [r[0] for r in d.select(stream.lateness(F.col("t"), F.lit(now))).collect()] == list(ages.values())


def test_landing_a_batch_again_changes_nothing(spark, tmp_path):
    raw = spark.createDataFrame([('{"event_id":"1","user_id":"U1","event_type":"order","event_ts":100}', 0, 1, None), ("{", 0, 2, None)], "value string, partition int, offset long, timestamp timestamp")
    for _ in range(2):
        stream.land(raw, 0, str(tmp_path / "lake"), str(tmp_path / "dlq"))
    assert spark.read.parquet(str(tmp_path / "lake/*")).count() == spark.read.parquet(str(tmp_path / "dlq/*")).count() == 1


def test_the_learner_query_cuts_no_folds_or_trees(monkeypatch):
    import inspect

    from tidewater.plans import operations

    class Called(Exception):
        pass

    def spy(*args, **named):
        bound = signature.bind(*args, **named)
        bound.apply_defaults()
        raise Called(*(bound.arguments[k] for k in ("n_folds", "trees", "depth")))

    class Table:
        def withColumn(self, *_):
            return self

    signature = inspect.signature(uplift.dr_learner)
    monkeypatch.setattr(operations.uplift, "dr_learner", spy)
    monkeypatch.setattr(operations.I, "trial", lambda *_: Table())
    monkeypatch.setattr(operations, "F", type("F", (), {"__getattr__": lambda *_: lambda *a: Table()})())
    monkeypatch.setattr(Table, "cast", lambda *_: None, raising=False)
    with pytest.raises(Called) as called:
        operations.dr_learner(None, None)
    assert called.value.args == (5, 20, 4)


def test_occurrences_count_on_over_slots_without_ordering_events(spark):
    from tidewater.operators import reconstruct

    slots = [("f5", 3, 2), ("f18", 3, 1), ("f5", 7, 3), ("recency", 3, 1), ("f5", 1, 1)]
    plans = spark.createDataFrame([("r1", slots)], "target_id string, slots array<struct<reason:string,day:int,n:bigint>>").withColumn("reference_ts", F.lit("2024-01-30 23:59:59").cast("timestamp"))
    made = reconstruct.materialise(plans, 7)
    got = sorted((r.gen_reason, r.day_offset, r.sub_index, r.occurrence) for r in made.collect())
    assert [g[3] for g in got if g[0] == "f5"] == [0, 1, 2, 3, 4, 5] and len({r.event_id for r in made.collect()}) == 8
    # Only slots are sorted, before they become events.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "sub_index" not in next(line for line in plan.splitlines() if "Window" in line)


def test_gates_read_plans_that_were_made_once(spark, monkeypatch):
    from tidewater.operators import reconstruct
    from tidewater.plans import operations

    read = []
    monkeypatch.setattr(operations.lake, "written", lambda rows, name, real=operations.lake.written: read.append(name) or real(rows, name))
    state = operations.handoff_state(spark, "/root/testdata/sf0.001")
    assert read == ["plans"] and "sha2" not in reconstruct.metrics(operations._kept_plans(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert state.count() > 0
