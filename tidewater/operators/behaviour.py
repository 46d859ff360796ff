"""Behaviour of the last days before an explicit time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.scalars import guarded_ratio

HISTORY_DAYS = 30
NO_ORDER_DAYS = 999
SESSION_GAP_SECONDS = 1800


def sessions(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Events with a session id: a new session after ``gap`` seconds without any event of the user."""
    order = Window.partitionBy("user_id").orderBy("event_ts", "event_id")
    idle = F.unix_micros("event_ts") - F.lag(F.unix_micros("event_ts")).over(order)
    rows = events.withColumn("_new", F.coalesce((idle > gap * 1_000_000).cast("int"), F.lit(1)))
    number = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("session_id", F.concat_ws("-", "user_id", number)).drop("_new")


def _recent(events: DataFrame, as_of: Column, days: int) -> DataFrame:
    return events.where((F.col("event_ts") >= as_of - F.make_dt_interval(F.lit(days))) & (F.col("event_ts") < as_of))


def windows(events: DataFrame, as_of: Column, history_days: int = HISTORY_DAYS) -> DataFrame:
    """Orders, gmv, vouchers, sessions and recency over 7, 14 and 30 days in one pass."""
    within = lambda d: F.col("event_ts") >= as_of - F.make_dt_interval(F.lit(d))
    order, claim = F.col("event_type") == "order", F.col("event_type") == "voucher_claim"
    gmv = lambda c: F.coalesce(F.sum(F.when(c, F.col("gmv"))), F.lit(0.0))
    a = _recent(events, as_of, history_days).groupBy("user_id").agg(
        F.count_if(order & within(7)).alias("order_cnt_7d"),
        F.count_if(order & within(14)).alias("order_cnt_14d"),
        F.count_if(order).alias("order_cnt_30d"),
        gmv(order & within(7)).alias("gmv_7d"),
        gmv(order).alias("gmv_30d"),
        F.count_if(claim & within(14)).alias("voucher_used_14d"),
        F.count_if(claim).alias("voucher_used_30d"),
        F.countDistinct("session_id").alias("session_cnt_30d"),
        F.countDistinct(F.to_date("event_ts")).alias("active_days_30d"),
        F.max(F.when(order, F.col("event_ts"))).alias("last_order_ts"),
        F.min("event_ts").alias("first_seen_ts"),
    )
    counts = ["order_cnt_7d", "order_cnt_14d", "order_cnt_30d", "voucher_used_14d", "session_cnt_30d", "active_days_30d"]
    return a.select(
        "user_id",
        *(F.col(c).cast("int").alias(c) for c in counts),
        "gmv_7d",
        "gmv_30d",
        guarded_ratio(F.col("gmv_30d"), F.col("order_cnt_30d")).alias("avg_order_value_30d"),
        guarded_ratio(F.col("voucher_used_30d"), F.col("order_cnt_30d")).alias("voucher_claim_rate_30d"),
        F.coalesce(F.datediff(as_of, "last_order_ts"), F.lit(NO_ORDER_DAYS)).alias("recency_last_order_days"),
        F.datediff(as_of, "first_seen_ts").alias("user_tenure_days"),
    )


def legacy(events: DataFrame, as_of: Column, history_days: int = HISTORY_DAYS) -> DataFrame:
    """The older 30-day table: event, order, voucher and session counts, gmv, tenure, first and last seen."""
    kind = lambda *k: F.count_if(F.col("event_type").isin(*k))
    return _recent(events, as_of, history_days).groupBy("user_id").agg(
        F.count("*").alias("event_cnt"),
        kind("order").alias("order_cnt"),
        kind("voucher_view", "voucher_claim").alias("voucher_cnt"),
        F.countDistinct("session_id").alias("session_cnt"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "order", F.col("gmv"))), F.lit(0.0)).alias("gmv"),
        F.datediff(as_of, F.min("event_ts")).alias("tenure_days"),
        F.min("event_ts").alias("first_seen"),
        F.max("event_ts").alias("last_seen"),
    )
