"""Operators on small rows, with the properties that matter about them."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import behaviour, encoding, marts, pit, staging
from tidewater.sources import lake


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def ts(text):
    return datetime.fromisoformat(text)


def test_user_ids_keep_splits_apart(spark):
    ids = spark.createDataFrame([("train_0",), ("test_0",), ("test_12345678",)], "d string")
    assert [r[0] for r in ids.select(S.derived_user_id(F.col("d"))).collect()] == ["U0000000", "T0000000", "T12345678"]
    many = spark.range(2000)
    splits = [many.select(S.derived_user_id(F.concat(F.lit(p), F.col("id"))).alias("u")) for p in ("train_", "test_")]
    assert staging.id_collisions(splits, "u").first() == (4000, 4000, False)


def test_uuid5_is_the_standard_one(spark):
    got = spark.range(1).select(S.uuid5(F.lit("t:A:f5:0"))).first()[0]
    assert got == str(uuid.uuid5(uuid.UUID(S.EVENT_NAMESPACE), "t:A:f5:0"))


def test_scalars(spark):
    d = spark.createDataFrame([("2.9", "x", '{"a":1,"b":2}', 1_800_000_123.5)], "n string, bad string, j string, t double")
    got = d.select(
        S.tolerant_cast(F.col("n"), "int", 7), S.tolerant_cast(F.col("bad"), "float", 1.5), S.json_key_count(F.col("j")), S.json_key_count(F.col("bad")),
        S.bucket_start(F.col("t")), S.window_cutoff(F.col("t")), S.close(F.lit(1.0), F.lit(1.00005), 1e-4), S.version_of(F.lit("2024/01/05")),
    ).first()
    assert tuple(got) == (2, 1.5, 2, 0, 1_800_000_000, 1_799_996_700, True, "v20240105")


def test_csv_to_partitions_and_back(spark, tmp_path):
    head = "data_id,label,is_treat," + ",".join(lake.FEATURES)
    for split in ("train", "test"):
        body = "\n".join(f"{split}_{k},{k % 2},1," + ",".join(["0.5"] * 83) for k in range(5))
        (tmp_path / f"{split}.csv").write_text(f"{head}\n{body}\n")
    (tmp_path / "stub.csv").write_text(head + "\n")
    paths = {"train": str(tmp_path / "train.csv"), "test": str(tmp_path / "test.csv"), "gone": str(tmp_path / "gone.csv"), "stub": str(tmp_path / "stub.csv")}
    loaded = lake.load_splits(spark, paths, "2024-01-30")
    assert loaded.count() == 10 and lake.read_csv_split(spark, paths["train"], "train", "2024-01-30", 3).count() == 3
    out = str(tmp_path / "lake")
    lake.write_partitions(loaded, out, ["dt", "split"])
    lake.write_partitions(loaded.where("split = 'test' AND label = 1"), out, ["dt", "split"])
    assert rows(spark.read.parquet(out).groupBy("split").count()) == [("test", 2), ("train", 5)]
    assert lake.read_or_empty(spark, str(tmp_path / "none"), "a long").count() == 0
    profile = lake.partition_profile(spark.read.parquet(out), "split", "user_id")
    assert rows(profile.select("split", "rows", "users")) == [("test", 2, 2), ("train", 5, 5)]


def test_first_copy_of_an_event_stays(spark):
    raw = spark.createDataFrame(
        [("e1", "U1", "order", 100.0, "s", 2.0, 3, 110.0, 0, 1), ("e1", "U1", "order", 100.0, "s", 9.0, 3, 105.0, 0, 2), ("e2", None, "order", 1.0, "s", 1.0, 1, 1.0, 0, 3), ("e3", "U1", "search", 5.0, None, None, None, 6.0, 0, 4)],
        "event_id string, user_id string, event_type string, event_ts double, session_id string, price double, quantity int, ingested_at double, kafka_partition int, kafka_offset long",
    )
    assert rows(staging.app_events(raw).select("event_id", "price", "gmv")) == [("e1", 9.0, 27.0), ("e3", 0.0, 0.0)]


def test_point_in_time_sees_only_what_was_known(spark):
    bound = spark.createDataFrame([("a", ts("2024-01-10 12:00:00")), ("b", ts("2024-01-10 12:00:00"))], "target_id string, reference_ts timestamp")
    at = lambda t, kind, seen=None: ("a", kind, ts(t), ts(seen or t))
    events = spark.createDataFrame(
        [at("2024-01-09 23:59:59", "EVT_F5"), at("2024-01-10 12:00:00", "EVT_F5"), at("2024-01-01 00:00:00", "EVT_F18"), at("2024-01-03 00:00:00", "EVT_ORDER_PAID"), at("2024-01-09 01:00:00", "EVT_ORDER_PAID"), at("2024-01-02 00:00:00", "EVT_F5", "2024-01-11 00:00:00"), at("2022-01-01 00:00:00", "EVT_F5")],
        "target_id string, event_type string, event_ts timestamp, observation_ts timestamp",
    )
    got = pit.pit_features(bound, events).select("target_id", "f1", "f2", "n5", "n18", "f5", "f18")
    # The event at the reference time and the one observed later don't count, nor what is older than a year.
    assert rows(got) == [("a", 7.0, 1.0, 1, 1, 0.0, 0.0), ("b", None, None, 0, 0, None, None)]


def test_realtime_window_is_aligned_to_buckets(spark):
    snap = spark.createDataFrame([("u", ts("2024-01-01 12:07:00"), "2024-01-01"), ("v", ts("2024-01-01 12:07:00"), "2024-01-01")], "user_id string, feature_ts timestamp, dt string")
    e = lambda t, k, g, s: ("u", k, g, ts(f"2024-01-01 {t}"), s)
    events = spark.createDataFrame(
        [e("11:09:59", "order", 5.0, "old"), e("11:10:00", "order", 7.0, "s1"), e("12:05:00", "page_view", 0.0, "s2"), e("12:06:00", "order", 3.0, "s2"), e("12:07:00", "order", 9.0, "s3")],
        "user_id string, event_type string, gmv double, event_ts timestamp, session_id string",
    )
    got = {r.user_id: r for r in pit.realtime(snap, events).collect()}
    u = got["u"]
    assert (u.rt_events_1h, u.rt_order_1h, u.rt_gmv_1h, u.rt_cart_gmv_5m, u.rt_page_view_5m, u.rt_session_len_sec) == (3, 2, 10.0, 3.0, 1, 60.0)
    assert (got["v"].rt_events_1h, got["v"].rt_last_event_ts) == (0, 0)


def test_sessions_and_windows(spark):
    e = spark.createDataFrame(
        [("u", "1", "order", 10.0, ts("2024-01-30 10:00:00")), ("u", "2", "order", 20.0, ts("2024-01-30 10:30:00")), ("u", "3", "voucher_claim", 0.0, ts("2024-01-30 11:00:01")), ("u", "4", "order", 5.0, ts("2024-01-10 00:00:00"))],
        "user_id string, event_id string, event_type string, gmv double, event_ts timestamp",
    )
    s = behaviour.sessions(e)
    assert s.select("session_id").distinct().count() == 3
    w = behaviour.windows(s, F.lit("2024-01-31").cast("timestamp")).first()
    assert (w.order_cnt_7d, w.order_cnt_30d, w.gmv_30d, w.avg_order_value_30d, w.session_cnt_30d, w.recency_last_order_days, w.user_tenure_days) == (2, 3, 35.0, 35 / 3, 3, 1, 21)


def test_encoding_and_its_inverse(spark):
    values = spark.createDataFrame([("a", 1.0, 0.5), ("b", 0.0, 0.5), ("c", 1.0, 0.5)], "target_id string, x double, y double")
    d = encoding.value_dictionary(values, ["x", "y"])
    assert rows(d) == [(0, 0.0, 0.5), (1, 1.0, 0.5)]
    assert encoding.bijection(d, ["x", "y"]).first().bijective and encoding.round_trip(d, ["x", "y"]).isEmpty()
    strange = spark.createDataFrame([(9.0, 9.0)], "x double, y double")
    assert encoding.unknown_tuples(strange, d, ["x", "y"]).count() == 1
    wide = spark.createDataFrame([("a", 0.0, 1.0), ("b", 1.0, 1.0), ("c", None, 0.0)], "target_id string, h0 double, h1 double")
    assert rows(encoding.decode_one_hot(wide, ["h0", "h1"])) == [("a", 1, True), ("b", None, False), ("c", None, False)]
    assert rows(encoding.one_hot_sum(wide, ["h0", "h1"])) == [("a", 1), ("b", 2), ("c", 0)]


def test_marts(spark):
    base = spark.createDataFrame([("u", 1.0, None), ("v", None, 2.0)], "user_id string, f0 double, f1 double")
    over = spark.createDataFrame([("u", 9.0)], "user_id string, f0 double")
    assert rows(marts.merge_overlay(base, over, {"f0": 0.0, "f1": 0.5}, "user_id")) == [("u", 9.0, 0.5, 1), ("v", 0.0, 2.0, 1)]
    with pytest.raises(ValueError, match="twice"):
        marts.rename_features(base, {"f0": "x", "f1": "x"})
    with pytest.raises(ValueError, match="several"):
        marts.single_version(base.withColumn("holdout_version", F.col("user_id")))
    vector = spark.createDataFrame([(float("nan"), 4.0)], "f1 double, f2 double").select(marts.model_vector([("f1", "stored"), ("f2", "stored"), ("f3", "fixed")], {"f1": 0.25, "f3": 3.0}))
    assert vector.first()[0] == [0.25, 4.0, 3.0]


def test_the_snapshot_is_widened_by_as_many_tasks_as_a_shuffle_has(spark):
    from tidewater.plans import inputs

    raw = inputs.snapshot_raw(spark, "/root/testdata/sf0.001")
    # Two branches, the rows and their older copies.
    assert raw.rdd.getNumPartitions() == 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert raw.count() == raw.select("user_id", "feature_ts").distinct().count()
