"""Decisions in the stream: late events kept out by state, active users merged with the active version, scored and decided.

A user's state holds the last hour's five-minute buckets, the event ids counted in them and the latest
arrival, which is the user's clock. An id needs no remembering longer than its bucket: after that its
event is late. Users' state is kept by groups of them and goes by a timer once the watermark is an hour
past the user's last bucket.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidewater.functions.scalars import BUCKET_SECONDS, WINDOW_SECONDS, epoch_seconds
from tidewater.operators.marts import merge_overlay
from tidewater.operators.publish import serve
from tidewater.operators.uplift import DEFAULT_THRESHOLD, decide
from tidewater.streaming.events import ALLOWED_LATENESS_SECONDS, COUNTERS, FUTURE_SKEW_SECONDS

ACTIONS = ("applied", "deduplicated", "late_accepted", "late_dropped", "future_dropped")
VALUES = ("events", *COUNTERS.values(), "gmv")
OVERLAY = ", ".join(
    ["user_id string", "as_of double", "last_event_s double", *(f"rt_{v}_1h double" for v in VALUES), *(f"{a} long" for a in ACTIONS)]
)
#: Groups of users with a state each.
USER_GROUPS = 1024
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bucket_of(seconds: float) -> int:
    return int(seconds // BUCKET_SECONDS) * BUCKET_SECONDS


def apply(state: dict, rows: list[tuple], counts: dict[str, int]) -> None:
    """Take (arrival, event id, event time, type, amount) rows in order of arrival into a user's ``state``; ``counts`` tells what became of them."""
    for arrival, event_id, at, kind, amount in sorted(rows, key=lambda r: (r[0], r[1])):
        now = state["clock"] = max(arrival, state["clock"])
        oldest = bucket_of(now) - (WINDOW_SECONDS - BUCKET_SECONDS)
        for old in [b for b in state["buckets"] if int(b) < oldest]:
            del state["buckets"][old]
        if at > now + FUTURE_SKEW_SECONDS:
            counts["future_dropped"] += 1
            continue
        if bucket_of(at) < oldest:
            counts["late_dropped"] += 1
            continue
        counts["late_accepted"] += now - at > ALLOWED_LATENESS_SECONDS
        bucket = state["buckets"].setdefault(str(bucket_of(at)), {"ids": [], "values": dict.fromkeys(VALUES, 0.0), "last": at})
        if event_id in bucket["ids"]:
            counts["deduplicated"] += 1
            continue
        counts["applied"] += 1
        bucket["ids"].append(event_id)
        bucket["last"] = max(bucket["last"], at)
        values = bucket["values"]
        values["events"] += 1
        if kind in COUNTERS:
            values[COUNTERS[kind]] += 1
        if kind == "order":
            values["gmv"] += amount


def hour(state: dict) -> tuple[float | None, list[float]]:
    """The last event's time and the values of the hour that ends in the clock's bucket."""
    now = bucket_of(state["clock"])
    live = [b for k, b in state["buckets"].items() if now - (WINDOW_SECONDS - BUCKET_SECONDS) <= int(k) <= now]
    return max((b["last"] for b in live), default=None), [sum(b["values"][v] for b in live) for v in VALUES]


def expiry_ms(state: dict) -> int:
    """When a user's state may go: an hour past the last bucket."""
    newest = max(map(int, state["buckets"]), default=bucket_of(state["clock"]))
    return int((newest + WINDOW_SECONDS) * 1000)


class LastHour(StatefulProcessor):
    """One row a user and batch: the last hour as of the latest arrival, and what became of the batch's events.

    State is held by group of users, as each access to it from Python costs more than a user's batch of
    events. A group's timer stands at the first of its users' expiries.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.value = handle.getValueState("hours", "state string")

    def _keep(self, users: dict, timer: int | None, watermark: int) -> None:
        expiry = max(min(map(expiry_ms, users.values())), watermark + 1)
        if timer != expiry:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(expiry)
        self.value.update((json.dumps({"timer": expiry, "users": list(users.items())}),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.value.get()
        held = json.loads(kept[0]) if kept else {"timer": None, "users": []}
        users, came, out = dict(held["users"]), {}, []
        for r in rows:
            came.setdefault(r.user_id, []).append((r.arrival_s, r.event_id, r.event_s, r.event_type, r.amount))
        for user, own in came.items():
            state, counts = users.setdefault(user, {"clock": 0.0, "buckets": {}}), dict.fromkeys(ACTIONS, 0)
            apply(state, own, counts)
            last, values = hour(state)
            out.append(Row(user_id=user, as_of=state["clock"], last_event_s=last, **{f"rt_{v}_1h": x for v, x in zip(VALUES, values, strict=True)}, **counts))
        self._keep(users, held["timer"], timerValues.getCurrentWatermarkInMs())
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, kept = timerValues.getCurrentWatermarkInMs(), self.value.get()
        users = {user: state for user, state in (json.loads(kept[0])["users"] if kept else ()) if expiry_ms(state) > now}
        if users:
            self._keep(users, None, now)
        else:
            self.value.clear()
        return iter([])

    def close(self) -> None:
        pass


def last_hour(events: DataFrame, groups: int = USER_GROUPS) -> DataFrame:
    """The overlay of each user that a batch brings events of, with counts of applied, repeated, late and future ones.

    ``events`` is a stream with event_id, user_id, event_type, event_ts, ingested_at, price, quantity and a
    watermark on event_ts. An event counts by its arrival: more than five minutes ahead of the user's clock it
    is dropped, as it is from before the hour's first bucket; over ten minutes old it is accepted as late.
    ``groups`` of users have a state each; it stays as it is for as long as a checkpoint is used.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    amount = F.coalesce(F.col("price") * F.col("quantity"), F.lit(0.0)).alias("amount")
    rows = events.select("event_ts", "event_id", "user_id", "event_type", epoch_seconds(F.col("event_ts")).alias("event_s"), epoch_seconds(F.col("ingested_at")).alias("arrival_s"), amount).withColumn("user_group", F.pmod(F.hash("user_id"), F.lit(groups)))
    return rows.groupBy("user_group").transformWithState(LastHour(), OVERLAY, "Update", "EventTime")


def decide_active(overlay: DataFrame, pointer: DataFrame, published: DataFrame, features: dict[str, float], score: Callable[[DataFrame], DataFrame], threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(user_id, as_of, feature_version, score, decision, voucher) of users whose last event lies at most five minutes back.

    Features are the overlay's, then those of the active version, then ``features``' defaults; a user who
    isn't published gets the defaults. ``score`` adds the column score, a saved model's or an expression.
    """
    active = overlay.where(F.col("last_event_s") >= F.col("as_of") - BUCKET_SECONDS)
    live = serve(pointer, published, active.select("user_id", F.lit(True).alias("_active")), "user_id").where("_active").drop("_active")
    batch = active.select("user_id", "as_of").join(live, "user_id", "left")
    merged = merge_overlay(batch, active, features, "user_id")
    scored = score(merged).select("user_id", F.col("score").cast("double").alias("score"))
    decision, voucher = decide(F.col("score"), threshold)
    return batch.select("user_id", "as_of", "feature_version").join(scored, "user_id").select("*", decision.alias("decision"), voucher.alias("voucher"))


def start_deciding(events: DataFrame, out: str, checkpoint: str, decided: Callable[[DataFrame], DataFrame], once: bool = False):
    """The running query: each batch's overlays to ``out``/overlay and its decisions to ``out``/decisions, a folder a batch, which a replay overwrites."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{out}/overlay/batch={batch_id}")
            decided(batch).write.mode("overwrite").parquet(f"{out}/decisions/batch={batch_id}")
        finally:
            batch.unpersist()

    trigger = {"availableNow": True} if once else {"processingTime": "30 seconds"}
    return last_hour(events).writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def actions(overlays: DataFrame) -> DataFrame:
    """(action, n): what became of all events, from the overlays of all batches."""
    return overlays.agg(*(F.sum(a).alias(a) for a in ACTIONS)).unpivot([], list(ACTIONS), "action", "n")


def constant(spark: SparkSession, value: Column, name: str = "score") -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.withColumn(name, value)
