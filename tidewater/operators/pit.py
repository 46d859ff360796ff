"""Point-in-time features: only what had happened, and was known, before the reference time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scalars import bucket_start, epoch_seconds, seconds_between, window_cutoff

COUNTER_WINDOW_DAYS = 365
#: Fixed value: the event type that recency looks at.
RECENCY_EVENT = "EVT_ORDER_PAID"


def visible(boundary: DataFrame, events: DataFrame) -> DataFrame:
    """Each boundary row with its events before, and observed by, its reference time; rows without events stay.

    The target is the join's hash key and times are residual conditions, so events are shuffled once.
    """
    e = events.select(F.col("target_id").alias("_t"), "event_type", "event_ts", "observation_ts")
    known = (F.col("target_id") == F.col("_t")) & (F.col("event_ts") < F.col("reference_ts")) & (F.col("observation_ts") <= F.col("reference_ts"))
    return boundary.join(e, known, "left").drop("_t")


def _first_last() -> dict[str, Column]:
    order = F.when(F.col("event_type") == RECENCY_EVENT, F.col("event_ts"))
    return {"first_ts": F.min(order), "last_ts": F.max(order)}


def _recency_columns(zero_fill: bool) -> dict[str, Column]:
    days = {"f1": F.datediff("reference_ts", "first_ts").cast("double"), "f2": F.datediff("reference_ts", "last_ts").cast("double")}
    names = {"f1": "days_since_first_signal", "f2": "days_since_last_signal"}
    filled = {names[k]: F.coalesce(v, F.lit(0.0)) for k, v in days.items()}
    return filled if zero_fill else days | filled


def _window_counts(window_days: int) -> dict[str, Column]:
    inside = F.col("event_ts") >= F.col("reference_ts") - F.make_dt_interval(F.lit(window_days))
    return {n: F.count_if((F.col("event_type") == kind) & inside) for n, kind in (("n5", "EVT_F5"), ("n18", "EVT_F18"))}


def _counter_columns() -> dict[str, Column]:
    f5, f18 = F.when(F.col("n5") >= 1, F.ln("n5")), _log10(F.col("n18"))
    return {"f5": f5, "f18": f18, "browse_intensity_365d": F.coalesce(f5, F.lit(0.0)), "promo_touch_intensity_365d": F.coalesce(f18, F.lit(0.0))}


def _per_target(seen: DataFrame, sums: dict[str, Column], features: dict[str, Column]) -> DataFrame:
    out = seen.groupBy("target_id", "reference_ts").agg(*(v.alias(k) for k, v in sums.items()))
    return out.select("*", *(v.alias(k) for k, v in features.items()))


def recency(seen: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Calendar days from the first and the last visible order to the reference time."""
    return _per_target(seen, _first_last(), _recency_columns(zero_fill))


def _log10(n: Column) -> Column:
    return F.when(n >= 1, F.round(F.log10(n), 6))


def counters(seen: DataFrame, window_days: int = COUNTER_WINDOW_DAYS) -> DataFrame:
    """Event counts of the window by type, and their logarithms; null where nothing was counted."""
    return _per_target(seen, _window_counts(window_days), _counter_columns())


def pit_features(boundary: DataFrame, events: DataFrame) -> DataFrame:
    """Recency and counters in one pass over the joined events."""
    sums = _first_last() | _window_counts(COUNTER_WINDOW_DAYS)
    return _per_target(visible(boundary, events), sums, _recency_columns(False) | _counter_columns())


def in_hour(snapshot: DataFrame, events: DataFrame) -> DataFrame:
    """Snapshot rows with their events from twelve buckets back to the feature time; rows without events stay."""
    s = snapshot.select("user_id", "dt", "feature_ts", bucket_start(epoch_seconds(F.col("feature_ts"))).alias("bucket_epoch"))
    s = s.withColumn("oldest", F.timestamp_seconds(window_cutoff(epoch_seconds(F.col("feature_ts")))))
    e = events.select(F.col("user_id").alias("_u"), "event_type", "gmv", "event_ts", "session_id")
    near = (F.col("user_id") == F.col("_u")) & (F.col("event_ts") < F.col("feature_ts")) & (F.col("event_ts") >= F.col("oldest"))
    return s.join(e, near, "left").drop("_u", "oldest")


def latest_session(joined: DataFrame) -> DataFrame:
    keys = ["user_id", "dt", "feature_ts"]
    return joined.where(F.col("event_ts").isNotNull()).groupBy(*keys).agg(F.max_by("session_id", F.struct("event_ts", "session_id")).alias("latest_session_id"))


def realtime(snapshot: DataFrame, events: DataFrame) -> DataFrame:
    """Twelve five-minute and one-hour features by feature time.

    Sessions are aggregated first, so the latest one's length needs no second look at the events.
    """
    keys = ["user_id", "dt", "feature_ts", "bucket_epoch"]
    joined = in_hour(snapshot, events)
    now = F.col("event_ts") >= F.timestamp_seconds("bucket_epoch")
    kind = lambda k: F.col("event_type") == k
    parts = joined.groupBy(*keys, "session_id").agg(
        F.count("event_type").alias("n"),
        *(F.count_if(kind(k) & now).alias(f"{k}_5m") for k in ("page_view", "add_to_cart", "search")),
        *(F.count_if(kind(k)).alias(f"{k}_1h") for k in ("page_view", "add_to_cart", "order", "search")),
        F.sum(F.when(kind("order") & now, F.col("gmv"))).alias("gmv_5m"),
        F.sum(F.when(kind("order"), F.col("gmv"))).alias("gmv_1h"),
        F.min("event_ts").alias("first"),
        F.max("event_ts").alias("last"),
    )
    last = F.max(F.struct("last", "session_id", "first"))
    out = parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in parts.columns if c.endswith(("_5m", "_1h")) or c == "n"), last.alias("s"))
    i = lambda c: F.col(c).cast("int")
    return out.select(
        "user_id",
        "dt",
        "feature_ts",
        i("n").alias("rt_events_1h"),
        i("page_view_5m").alias("rt_page_view_5m"),
        i("add_to_cart_5m").alias("rt_add_to_cart_5m"),
        F.coalesce("gmv_5m", F.lit(0.0)).alias("rt_cart_gmv_5m"),
        i("search_5m").alias("rt_search_cnt_5m"),
        i("page_view_1h").alias("rt_page_view_1h"),
        i("add_to_cart_1h").alias("rt_add_to_cart_1h"),
        i("order_1h").alias("rt_order_1h"),
        i("search_1h").alias("rt_search_cnt_1h"),
        F.coalesce("gmv_1h", F.lit(0.0)).alias("rt_gmv_1h"),
        F.coalesce(seconds_between(F.col("s.first"), F.col("s.last")), F.lit(0)).cast("double").alias("rt_session_len_sec"),
        F.coalesce(F.unix_seconds("s.last"), F.lit(0)).cast("long").alias("rt_last_event_ts"),
    )
