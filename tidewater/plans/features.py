"""Queries of staging, point-in-time, behaviour, encoding and mart jobs, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import behaviour, encoding, marts, pit, staging
from tidewater.plans import inputs as I
from tidewater.plans.inputs import sql
from tidewater.sources import lake

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(oracle: str | None = None, recursive: bool = False):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE_SQL[f.__name__] = sql(oracle, recursive)
        return f

    return register


def us(c: str, name: str | None = None):
    return F.unix_micros(c).alias(name or c)


@query("""SELECT event_id, user_id, event_type, price, quantity, gmv, epoch_us(event_ts) AS event_us, CAST(event_date AS VARCHAR) AS event_date FROM ev""")
def stg_events_dedup(spark, sf):
    e = I.events(spark, sf)
    return e.select("event_id", "user_id", "event_type", "price", "quantity", "gmv", us("event_ts", "event_us"), F.col("event_date").cast("string").alias("event_date"))


@query("""SELECT user_id, data_id, split, CAST(dt AS VARCHAR) AS dt, epoch_us(feature_ts) AS feature_us, label, is_treat, f0, f41, f82 FROM snap""")
def stg_snapshot_latest(spark, sf):
    s = I.snapshot(spark, sf)
    return s.select("user_id", "data_id", "split", F.col("dt").cast("string").alias("dt"), us("feature_ts", "feature_us"), "label", "is_treat", "f0", "f41", "f82")


@query("""SELECT event_id, customer_id, target_id, event_type, epoch_us(event_ts) AS event_us, epoch_us(observation_ts) AS observation_us, source_type, generation_run_id FROM wit""")
def stg_witness_whitelist(spark, sf):
    w = I.witnesses(spark, sf)
    return w.select("event_id", "customer_id", "target_id", "event_type", us("event_ts", "event_us"), us("observation_ts", "observation_us"), "source_type", "generation_run_id")


@query("""SELECT data_id, user_id FROM snap""")
def user_id_derivation(spark, sf):
    return I.snapshot_raw(spark, sf).select("data_id", S.derived_user_id(F.col("data_id")).alias("user_id")).distinct()


@query("""SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_ids, count(*) <> count(DISTINCT user_id) AS collides FROM snap""")
def split_union_collision(spark, sf):
    s = I.snapshot(spark, sf)
    return staging.id_collisions([s.where(F.col("split") == k) for k in ("train", "test")], "user_id")


@query("""SELECT 'events' AS source, count(*) AS n_rows FROM events UNION ALL SELECT 'not_there', 0""")
def empty_source_scan(spark, sf):
    there = lake.read_or_empty(spark, f"{sf}/events.parquet", "event_id long, user_id long")
    gone = lake.read_or_empty(spark, f"{sf}/not_there.parquet", "event_id long, user_id long")
    count = lambda d, n: d.agg(F.lit(n).alias("source"), F.count("*").alias("n_rows"))
    return count(there, "events").union(count(gone, "not_there"))


_SEEN = """WITH seen AS (SELECT b.target_id, b.reference_ts, w.event_type, w.event_ts FROM bnd b LEFT JOIN wit w
  ON w.target_id = b.target_id AND w.event_ts < b.reference_ts AND w.observation_ts <= b.reference_ts)"""
_PAID = "FILTER (WHERE event_type = 'EVT_ORDER_PAID')"
_RECENCY = f"""SELECT target_id, reference_ts, min(event_ts) {_PAID} AS first_ts, max(event_ts) {_PAID} AS last_ts, CAST(date_diff('day', min(event_ts) {_PAID}, reference_ts) AS DOUBLE) AS f1,
  CAST(date_diff('day', max(event_ts) {_PAID}, reference_ts) AS DOUBLE) AS f2 FROM seen GROUP BY target_id, reference_ts"""
_COUNTS = """SELECT target_id, count(*) FILTER (WHERE event_type = 'EVT_F5' AND event_ts >= reference_ts - INTERVAL 365 DAY) AS n5,
  count(*) FILTER (WHERE event_type = 'EVT_F18' AND event_ts >= reference_ts - INTERVAL 365 DAY) AS n18 FROM seen GROUP BY target_id, reference_ts"""


@query(f"""{_SEEN}, r AS ({_RECENCY}) SELECT target_id, epoch_us(first_ts) AS first_us, epoch_us(last_ts) AS last_us, f1, f2, coalesce(f1, 0.0) AS days_since_first_signal, coalesce(f2, 0.0) AS days_since_last_signal FROM r""")
def pit_recency(spark, sf):
    r = pit.recency(pit.visible(I.boundary(spark, sf), I.witnesses(spark, sf)))
    return r.select("target_id", us("first_ts", "first_us"), us("last_ts", "last_us"), "f1", "f2", "days_since_first_signal", "days_since_last_signal")


@query(f"""{_SEEN}, c AS ({_COUNTS}) SELECT target_id, n5, n18, round(CASE WHEN n5 >= 1 THEN ln(n5) END, 6) AS f5, CASE WHEN n18 >= 1 THEN round(log10(n18), 6) END AS f18,
  round(coalesce(CASE WHEN n5 >= 1 THEN ln(n5) END, 0.0), 6) AS browse_intensity_365d FROM c""")
def pit_counters(spark, sf):
    c = pit.counters(pit.visible(I.boundary(spark, sf), I.witnesses(spark, sf)))
    return c.select("target_id", "n5", "n18", F.round("f5", 6).alias("f5"), "f18", F.round("browse_intensity_365d", 6).alias("browse_intensity_365d"))


@query(f"""{_SEEN}, r AS ({_RECENCY}), c AS ({_COUNTS})
SELECT b.target_id, coalesce(f1, 0.0) AS f1, coalesce(f2, 0.0) AS f2, n5, n18, round(coalesce(CASE WHEN n5 >= 1 THEN ln(n5) END, 0.0), 6) AS f5, coalesce(CASE WHEN n18 >= 1 THEN round(log10(n18), 6) END, 0.0) AS f18
FROM bnd b LEFT JOIN r ON r.target_id = b.target_id LEFT JOIN c ON c.target_id = b.target_id""")
def pit_feature_table(spark, sf):
    """The flagship: clean witnesses, point-in-time join, recency and counters, assembly with defaults."""
    b = I.boundary(spark, sf)
    rows = marts.assemble(b.select("target_id"), [pit.pit_features(b, I.witnesses(spark, sf))], ["target_id"])
    rows = marts.fill_defaults(rows, {"f1": 0.0, "f2": 0.0, "f5": 0.0, "f18": 0.0})
    return rows.select("target_id", "f1", "f2", "n5", "n18", F.round("f5", 6).alias("f5"), "f18")


_HOUR = """WITH s AS (SELECT *, floor(epoch(feature_ts) / 300) * 300 AS b FROM esnap),
j AS (SELECT s.user_id, s.dt, s.feature_ts, s.b, e.event_type, e.gmv, e.event_ts, e.session_id FROM s LEFT JOIN sess e
  ON e.user_id = s.user_id AND e.event_ts < s.feature_ts AND epoch(e.event_ts) >= s.b - 3300),
l AS (SELECT user_id, feature_ts, arg_max(session_id, event_ts) AS sid FROM j WHERE event_ts IS NOT NULL GROUP BY user_id, feature_ts)"""
_NOW = "epoch(event_ts) >= j.b"


@query(f"""{_HOUR} SELECT j.user_id, epoch_us(j.feature_ts) AS feature_us, CAST(count(event_type) AS INTEGER) AS rt_events_1h,
 CAST(count(*) FILTER (WHERE event_type = 'page_view' AND {_NOW}) AS INTEGER) AS rt_page_view_5m, CAST(count(*) FILTER (WHERE event_type = 'add_to_cart' AND {_NOW}) AS INTEGER) AS rt_add_to_cart_5m,
 round(coalesce(sum(gmv) FILTER (WHERE event_type = 'order' AND {_NOW}), 0.0), 4) AS rt_cart_gmv_5m, CAST(count(*) FILTER (WHERE event_type = 'search' AND {_NOW}) AS INTEGER) AS rt_search_cnt_5m,
 CAST(count(*) FILTER (WHERE event_type = 'page_view') AS INTEGER) AS rt_page_view_1h, CAST(count(*) FILTER (WHERE event_type = 'add_to_cart') AS INTEGER) AS rt_add_to_cart_1h,
 CAST(count(*) FILTER (WHERE event_type = 'order') AS INTEGER) AS rt_order_1h, CAST(count(*) FILTER (WHERE event_type = 'search') AS INTEGER) AS rt_search_cnt_1h,
 round(coalesce(sum(gmv) FILTER (WHERE event_type = 'order'), 0.0), 4) AS rt_gmv_1h,
 CAST(coalesce(date_diff('second', min(event_ts) FILTER (WHERE session_id = sid), max(event_ts) FILTER (WHERE session_id = sid)), 0) AS DOUBLE) AS rt_session_len_sec,
 CAST(coalesce(floor(epoch(max(event_ts))), 0) AS BIGINT) AS rt_last_event_ts
FROM j LEFT JOIN l ON l.user_id = j.user_id AND l.feature_ts = j.feature_ts GROUP BY j.user_id, j.feature_ts, j.b, sid""")
def pit_realtime_12(spark, sf):
    r = pit.realtime(I.event_snapshot(spark, sf), I.session_events(spark, sf))
    money = {c: F.round(c, 4) for c in ("rt_cart_gmv_5m", "rt_gmv_1h")}
    return r.withColumns(money).withColumn("feature_us", F.unix_micros("feature_ts")).drop("feature_ts", "dt")


@query(f"""{_HOUR} SELECT user_id, epoch_us(feature_ts) AS feature_us, sid AS latest_session_id FROM l""")
def latest_session(spark, sf):
    j = pit.in_hour(I.event_snapshot(spark, sf), I.session_events(spark, sf))
    return pit.latest_session(j).select("user_id", us("feature_ts", "feature_us"), "latest_session_id")


_AS_OF = f"TIMESTAMP '{I.AS_OF}'"
_RECENT = f"FROM sess WHERE event_ts >= {_AS_OF} - INTERVAL 30 DAY AND event_ts < {_AS_OF} GROUP BY user_id"


@query(f"""WITH a AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'order' AND event_ts >= {_AS_OF} - INTERVAL 7 DAY) AS order_cnt_7d,
 count(*) FILTER (WHERE event_type = 'order' AND event_ts >= {_AS_OF} - INTERVAL 14 DAY) AS order_cnt_14d, count(*) FILTER (WHERE event_type = 'order') AS order_cnt_30d,
 coalesce(sum(gmv) FILTER (WHERE event_type = 'order' AND event_ts >= {_AS_OF} - INTERVAL 7 DAY), 0.0) AS gmv_7d, coalesce(sum(gmv) FILTER (WHERE event_type = 'order'), 0.0) AS gmv_30d,
 count(*) FILTER (WHERE event_type = 'voucher_claim' AND event_ts >= {_AS_OF} - INTERVAL 14 DAY) AS voucher_used_14d, count(*) FILTER (WHERE event_type = 'voucher_claim') AS v30,
 count(DISTINCT session_id) AS session_cnt_30d, count(DISTINCT event_date) AS active_days_30d, max(event_ts) FILTER (WHERE event_type = 'order') AS last_order, min(event_ts) AS first_seen {_RECENT})
SELECT user_id, CAST(order_cnt_7d AS INTEGER) AS order_cnt_7d, CAST(order_cnt_14d AS INTEGER) AS order_cnt_14d, CAST(order_cnt_30d AS INTEGER) AS order_cnt_30d, CAST(voucher_used_14d AS INTEGER) AS voucher_used_14d,
 CAST(session_cnt_30d AS INTEGER) AS session_cnt_30d, CAST(active_days_30d AS INTEGER) AS active_days_30d, round(gmv_7d, 4) AS gmv_7d, round(gmv_30d, 4) AS gmv_30d,
 round(CASE WHEN order_cnt_30d > 0 THEN gmv_30d / order_cnt_30d ELSE 0.0 END, 4) AS avg_order_value_30d, round(CASE WHEN order_cnt_30d > 0 THEN v30 * 1.0 / order_cnt_30d ELSE 0.0 END, 6) AS voucher_claim_rate_30d,
 CAST(coalesce(date_diff('day', last_order, {_AS_OF}), 999) AS INTEGER) AS recency_last_order_days, CAST(date_diff('day', first_seen, {_AS_OF}) AS INTEGER) AS user_tenure_days FROM a""")
def behaviour_7_14_30(spark, sf):
    b = behaviour.windows(I.session_events(spark, sf), I.as_of())
    digits = {"gmv_7d": 4, "gmv_30d": 4, "avg_order_value_30d": 4, "voucher_claim_rate_30d": 6}
    return b.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(f"""SELECT user_id, count(*) AS event_cnt, count(*) FILTER (WHERE event_type = 'order') AS order_cnt, count(*) FILTER (WHERE event_type IN ('voucher_view', 'voucher_claim')) AS voucher_cnt,
 count(DISTINCT session_id) AS session_cnt, round(coalesce(sum(gmv) FILTER (WHERE event_type = 'order'), 0.0), 4) AS gmv, CAST(date_diff('day', min(event_ts), {_AS_OF}) AS INTEGER) AS tenure_days,
 epoch_us(min(event_ts)) AS first_us, epoch_us(max(event_ts)) AS last_us {_RECENT}""")
def behaviour_legacy(spark, sf):
    b = behaviour.legacy(I.session_events(spark, sf), I.as_of())
    return b.withColumn("gmv", F.round("gmv", 4)).withColumns({"first_us": F.unix_micros("first_seen"), "last_us": F.unix_micros("last_seen")}).drop("first_seen", "last_seen")


# Encoding: customers' segment and nation, as numbers, make the value tuples; nation's region the one-hot group.
_TUPLES = ["v1", "v2"]
_HOT = [f"r{k}" for k in range(5)]
_CUST = """SELECT 'c' || c_custkey AS target_id, CAST(length(c_mktsegment) AS DOUBLE) AS v1, CAST(c_nationkey % 4 AS DOUBLE) / 4 AS v2, CAST(c_nationkey % 5 AS INTEGER) AS region FROM customer"""
_DICT = f"""c AS ({_CUST}), d AS (SELECT row_number() OVER (ORDER BY v1, v2) - 1 AS level_id, v1, v2 FROM (SELECT DISTINCT v1, v2 FROM c))"""


def _customers(spark, sf):
    c = I.read(spark, sf, "customer")
    return c.select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("target_id"), F.length("c_mktsegment").cast("double").alias("v1"),
        ((F.col("c_nationkey") % 4).cast("double") / 4).alias("v2"), (F.col("c_nationkey") % 5).cast("int").alias("region"),
    )


def _dictionary(spark, sf):
    return encoding.value_dictionary(_customers(spark, sf), _TUPLES)


def _layout(spark):
    rows = [(v, "region", k, c) for v in (I.ENCODING, "enc_v3") for k, c in enumerate(_HOT)]
    return spark.createDataFrame(rows, "encoding_version string, attr_name string, level_index int, column_name string")


def _encoded(spark, sf):
    """Long (target_id, column_name, value) of both kinds of attribute, from levels alone."""
    c, d = _customers(spark, sf), _dictionary(spark, sf)
    coded = encoding.encode_levels(c, d, _TUPLES).select("target_id", F.lit("segment").alias("attr_name"), "level_id")
    hot = c.select("target_id", F.lit("region").alias("attr_name"), F.col("region").alias("level_id"))
    maps = encoding.encoding_map(d, I.ENCODING, "segment", _TUPLES).union(encoding.encoding_map(d, "enc_v3", "segment", _TUPLES))
    return encoding.lookup(coded, maps, I.ENCODING).unionByName(encoding.one_hot(hot, _layout(spark), I.ENCODING))


@query(f"WITH {_DICT} SELECT * FROM d")
def value_dictionary(spark, sf):
    return _dictionary(spark, sf)


@query(f"WITH {_DICT} SELECT target_id, level_id FROM c JOIN d USING (v1, v2)")
def encode_lookup(spark, sf):
    return encoding.encode_levels(_customers(spark, sf), _dictionary(spark, sf), _TUPLES).select("target_id", "level_id")


@query(f"WITH {_DICT} SELECT target_id, v1, v2, " + ", ".join(f"CAST(region = {k} AS DOUBLE) AS r{k}" for k in range(5)) + " FROM c")
def onehot_pivot(spark, sf):
    return encoding.pivot_features(_encoded(spark, sf), _TUPLES + _HOT)


@query(f"WITH {_DICT} SELECT count(*) AS n, count(*) AS n_one_hot FROM c")
def onehot_invariant(spark, sf):
    wide = encoding.pivot_features(_encoded(spark, sf), _TUPLES + _HOT)
    return encoding.one_hot_sum(wide, _HOT).agg(F.count("*").alias("n"), F.count_if(F.col("hot_count") == 1).alias("n_one_hot"))


@query(f"WITH {_DICT} SELECT target_id, CAST(region AS INTEGER) AS level_index, level_id FROM c JOIN d USING (v1, v2)")
def decode_attributes(spark, sf):
    wide = encoding.pivot_features(_encoded(spark, sf), _TUPLES + _HOT)
    hot = encoding.decode_one_hot(wide, _HOT).where("ok").select("target_id", "level_index")
    return hot.join(encoding.decode_lookup(wide, _dictionary(spark, sf), _TUPLES).where("ok").select("target_id", "level_id"), "target_id")


@query(f"WITH {_DICT} SELECT count(*) AS n_levels, count(*) AS n_tuples, count(*) AS n_pairs, true AS bijective, 0 AS n_lost FROM d")
def encoding_roundtrip(spark, sf):
    d = _dictionary(spark, sf)
    lost = encoding.round_trip(d, _TUPLES).agg(F.count("*").cast("int").alias("n_lost"))
    return encoding.bijection(d, _TUPLES).crossJoin(lost)


_SERVE = ["f0", "f3", "f7", "f9", "f13", "f14", "f16", "f26", "f27", "f66"]
_DEFAULTS = {f: round(0.01 * int(f[1:]), 2) for f in lake.FEATURES}


@query("""SELECT s.user_id, """ + ", ".join(f"coalesce({f}, {_DEFAULTS[f]}) AS {f}" for f in _SERVE) + f""", coalesce(b.order_cnt, 0) AS order_cnt, coalesce(b.gmv, 0.0) AS gmv
FROM snap s LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE event_type = 'order') AS order_cnt, round(coalesce(sum(gmv) FILTER (WHERE event_type = 'order'), 0.0), 4) AS gmv {_RECENT}) b ON b.user_id = s.user_id""")
def serving_features(spark, sf):
    b = behaviour.legacy(I.session_events(spark, sf), I.as_of()).select("user_id", "order_cnt", F.round("gmv", 4).alias("gmv"))
    rows = marts.assemble(I.snapshot(spark, sf).select("user_id", *_SERVE), [b], ["user_id"])
    return marts.fill_defaults(rows, _DEFAULTS | {"order_cnt": 0, "gmv": 0.0})


@query("""SELECT user_id, CAST(dt AS VARCHAR) AS dt, label, is_treat, """ + ", ".join(f"coalesce({f}, {_DEFAULTS[f]}) AS {f}" for f in _SERVE) + " FROM snap WHERE split = 'train'")
def training_features(spark, sf):
    s = I.snapshot(spark, sf).where("split = 'train'").select("user_id", F.col("dt").cast("string").alias("dt"), "label", "is_treat", *_SERVE)
    return marts.fill_defaults(s, _DEFAULTS)


@query("""SELECT s.user_id, label, is_treat, f0, f9, coalesce(e.n, 0) AS rt_events FROM snap s LEFT JOIN (SELECT user_id, count(*) AS n FROM ev GROUP BY user_id) e ON e.user_id = s.user_id WHERE split = 'train'""")
def training_dataset(spark, sf):
    s = I.snapshot(spark, sf).where("split = 'train'")
    overlay = I.events(spark, sf).groupBy("user_id").agg(F.count("*").alias("rt_events"))
    rows = marts.training_set(s.select("user_id", "f0", "f9"), s.select("user_id", "label", "is_treat"), overlay, ["user_id"])
    return marts.fill_defaults(rows, {"rt_events": 0})


@query(f"""SELECT user_id, label, is_treat, f0, f82, 'holdout_v1' AS holdout_version FROM snap WHERE split = 'test' AND dt = DATE '{I.DAY}'""")
def eval_holdout(spark, sf):
    h = marts.single_version(marts.holdout(I.snapshot(spark, sf), I.DAY, "holdout_v1"))
    return h.select("user_id", "label", "is_treat", "f0", "f82", "holdout_version")


@query(f"""SELECT user_id, f2, f1, label FROM snap WHERE split = 'train' AND dt BETWEEN DATE '{I.DAY}' - 28 AND DATE '{I.DAY}'""")
def training_window_read(spark, sf):
    return marts.training_window(I.snapshot(spark, sf), "train", I.DAY, 4, ["user_id", "f2", "f1", "label"])


@query("""SELECT user_id, coalesce(CASE WHEN k % 3 = 0 THEN k / CAST(10.0 AS DOUBLE) END, f0, 0.5) AS f0, coalesce(f1, 0.25) AS f1, coalesce(CASE WHEN k % 3 = 0 THEN 7.0 END, -1.0) AS rt_x,
  CAST(f0 IS NULL AND k % 3 <> 0 AS INTEGER) + CAST(f1 IS NULL AS INTEGER) + CAST(k % 3 <> 0 AS INTEGER) AS defaulted FROM (SELECT *, CAST(substr(user_id, 2) AS BIGINT) AS k FROM snap)""")
def batch_realtime_merge(spark, sf):
    s = I.snapshot(spark, sf).select("user_id", "f0", "f1")
    k = F.substring("user_id", 2, 20).cast("long")
    over = s.where(k % 3 == 0).select("user_id", (k / 10).alias("f0"), F.lit(7.0).alias("rt_x"))
    return marts.merge_overlay(s, over, {"f0": 0.5, "f1": 0.25, "rt_x": -1.0}, "user_id")


@query("""SELECT user_id, CASE WHEN k % 4 = 0 THEN CAST(k AS DOUBLE) WHEN k % 4 = 1 THEN 3.5 WHEN k % 4 = 2 THEN 1.0 END AS f0, CASE WHEN k % 4 = 1 THEN 2 END AS rt_a,
  CASE WHEN k % 4 = 0 THEN 1 WHEN k % 4 = 1 THEN 0 WHEN k % 4 = 2 THEN 1 ELSE 2 END AS missing, CASE WHEN k % 4 = 0 THEN 1 WHEN k % 4 = 1 THEN 2 WHEN k % 4 = 2 THEN 1 ELSE 0 END AS supplied, CASE WHEN k % 4 = 1 THEN 1 ELSE 0 END AS realtime_applied
 FROM (SELECT user_id, CAST(substr(user_id, 2) AS BIGINT) AS k FROM snap)""")
def merge_precedence(spark, sf):
    k = F.substring("user_id", 2, 20).cast("long")
    # Context over realtime over batch; empty text is missing, and unreadable text stays missing.
    text = lambda v: F.create_map(F.lit("f0"), v)
    s = I.snapshot(spark, sf).select(
        "user_id",
        text(F.when(k % 4 == 0, k.cast("string")).otherwise("")).alias("context"),
        F.create_map(F.lit("f0"), F.when(k % 4 == 1, "3.5"), F.lit("rt_a"), F.when(k % 4 == 1, "2.9")).alias("realtime"),
        text(F.when(k % 4 == 3, "n/a").otherwise("1.0")).alias("batch"),
    )
    return marts.decision_input(s, {"f0": "float", "rt_a": "int"}, ["f0", "rt_a"], "user_id")


def _f(c: str) -> str:
    return f"coalesce({c}, {_DEFAULTS[c]})"


_NONZERO = " + ".join(f"CAST({_f(c)} <> 0.0 AS INTEGER)" for c in marts.NONZERO_COLUMNS)
_DERIVED = f"""{_f('f1')} / ({_f('f2')} + 1.0) AS fe_ratio_f1_f2, {_f('f14')} / ({_f('f16')} + 1.0) AS fe_ratio_f14_f16, {_f('f9')} / ({_f('f27')} + 1.0) AS fe_ratio_f9_f27,
 {_f('f9')} * {_f('f26')} AS fe_inter_f9_f26, {_f('f14')} * {_f('f27')} AS fe_inter_f14_f27, CAST({_NONZERO} AS DOUBLE) AS fe_nonzero_top10, {_f('f66')} + {_f('f68')} + {_f('f75')} AS fe_flag_sum"""


@query(f"SELECT user_id, {_DERIVED} FROM snap")
def derived_features(spark, sf):
    return I.snapshot(spark, sf).select("user_id", *(v.alias(k) for k, v in marts.derived(_DEFAULTS).items()))


_SLOTS = [("f2", "stored"), ("fe_ratio_f1_f2", "derived"), ("f50", "fixed"), ("f9", "stored"), ("fe_flag_sum", "derived")]


@query(f"""SELECT user_id, {_f('f2')} AS x0, {_f('f1')} / ({_f('f2')} + 1.0) AS x1, CAST(0.5 AS DOUBLE) AS x2, {_f('f9')} AS x3, {_f('f66')} + {_f('f68')} + {_f('f75')} AS x4 FROM snap""")
def model_vector(spark, sf):
    v = I.snapshot(spark, sf).select("user_id", marts.model_vector(_SLOTS, _DEFAULTS).alias("v"))
    return v.select("user_id", *(F.col("v")[k].alias(f"x{k}") for k in range(len(_SLOTS))))


@query("""SELECT user_id, coalesce(f0, 0.0) AS base_affinity, coalesce(f3, 0.03) AS visit_rate FROM snap""")
def feature_aliases(spark, sf):
    s = marts.fill_defaults(I.snapshot(spark, sf).select("user_id", "f0", "f3"), _DEFAULTS)
    return marts.rename_features(s, {"f0": "base_affinity", "f3": "visit_rate"})


@query("""SELECT o_custkey AS target_id, CAST(date_diff('day', min(l_shipdate), TIMESTAMP '2000-01-01') AS INTEGER) AS days_since_first, CAST(date_diff('day', max(l_shipdate), TIMESTAMP '2000-01-01') AS INTEGER) AS days_since_last,
 count(*) FILTER (WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2000-01-01' - INTERVAL 365 DAY) AS n_returned, count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '2000-01-01' - INTERVAL 365 DAY) AS n_lines
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY o_custkey""")
def pit_order_lines(spark, sf):
    """The point-in-time join at volume: order lines as events of customers, all before one reference time."""
    at = F.lit("2000-01-01").cast("timestamp")
    lines = I.read(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_shipdate").cast("timestamp").alias("event_ts")).where(F.col("event_ts") < at)
    orders = I.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    recent = F.col("event_ts") >= at - F.make_dt_interval(F.lit(365))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("target_id"))
    return rows.agg(
        F.datediff(at, F.min("event_ts")).alias("days_since_first"), F.datediff(at, F.max("event_ts")).alias("days_since_last"),
        F.count_if((F.col("l_returnflag") == "R") & recent).alias("n_returned"), F.count_if(recent).alias("n_lines"),
    )
