"""The event stream over several batches, with restarts between them."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewater.sources import lake
from tidewater.streaming import events as stream

RAW = "value string, partition int, offset long, timestamp timestamp"


def message(offset, price=1.0, at=1_700_000_000.0, user="U1"):
    body = {"event_id": f"e{offset}", "user_id": user, "event_type": "order", "event_ts": str(at + offset), "price": price, "quantity": 1}
    return json.dumps(body), 0, offset, dt.datetime(2023, 11, 14, 22, 15)


def test_a_replay_lands_once_and_a_conflict_lands_nothing(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([message(k) for k in range(5)] + [("{broken", 0, 5, None)], RAW)
    for _ in range(2):
        stream.land(first, 0, f"{root}/lake", f"{root}/dlq")
    stream.land(spark.createDataFrame([message(k) for k in range(6, 9)], RAW), 1, f"{root}/lake", f"{root}/dlq")
    landed = lambda: stream.landed(spark, f"{root}/lake")
    assert landed().count() == 8 and stream.dead_letters(spark, f"{root}/dlq").count() == 1
    again = spark.createDataFrame([message(k, price=2.0 if k == 7 else 1.0) for k in range(6, 9)], RAW)
    with pytest.raises(stream.OffsetConflict):
        stream.land(again, 2, f"{root}/lake", f"{root}/dlq")
    assert landed().count() == 8


def test_landing_goes_on_after_a_restart(spark, tmp_path):
    root = str(tmp_path)
    for part in range(3):
        spark.createDataFrame([message(10 * part + k) for k in range(4)], RAW).coalesce(1).write.mode("append").parquet(f"{root}/in")
        messages = stream.file_source(spark, f"{root}/in", RAW)
        stream.start_landing(messages, f"{root}/lake", f"{root}/dlq", f"{root}/state", once=True).awaitTermination()
    rows = stream.landed(spark, f"{root}/lake")
    assert rows.count() == 12 and rows.select("first_offset").distinct().count() == 3


def test_landing_needs_no_checkpoint(spark, tmp_path):
    """The same rows under other batch ids, with an empty checkpoint, in larger batches and beside new ones, land once."""
    root = str(tmp_path)
    land = lambda rows, batch: stream.land(spark.createDataFrame(rows, RAW), batch, f"{root}/lake", f"{root}/dlq")
    whole = lambda: sorted(r.kafka_offset for r in stream.landed(spark, f"{root}/lake").collect())
    assert land([message(k) for k in range(5)] + [("{broken", 0, 5, None)], 0) == {"landed": 5, "dead": 1}
    assert land([message(k) for k in range(5)] + [("{broken", 0, 5, None)], 7) == {"landed": 0, "dead": 0}
    assert land([message(k) for k in (3, 4, 6, 6)] + [("{broken", 0, 5, None), ("{more", 0, 7, None)], 0) == {"landed": 1, "dead": 1}
    assert whole() == [0, 1, 2, 3, 4, 6] and stream.dead_letters(spark, f"{root}/dlq").count() == 2
    for number in range(2):
        spark.createDataFrame([message(10 * number + k) for k in range(8, 14)], RAW).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for name, files in (("first", 1), ("second", 5)):
        messages = stream.file_source(spark, f"{root}/in", RAW, files)
        stream.start_landing(messages, f"{root}/lake", f"{root}/dlq", f"{root}/{name}", once=True).awaitTermination()
        assert whole() == [0, 1, 2, 3, 4, 6, *range(8, 14), *range(18, 24)]
    names = stream.landed(spark, f"{root}/lake").select("kafka_partition", "first_offset", "last_offset").distinct().collect()
    assert all(r.first_offset <= r.last_offset for r in names) and (0, 8, 13) in {tuple(r) for r in names}
    with pytest.raises(stream.OffsetConflict):
        land([message(30), message(30, price=2.0)], 9)


def test_a_crash_between_the_sinks_leaves_nothing_twice(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batch = spark.createDataFrame([message(k) for k in range(4)] + [("{broken", 0, 4, None)], RAW)
    monkeypatch.setattr(stream, "DEAD_NAMES", ["no_such_column", "first_offset", "last_offset"])
    with pytest.raises(Exception, match="no_such_column"):
        stream.land(batch, 0, f"{root}/lake", f"{root}/dlq")
    monkeypatch.undo()
    stream.land(batch, 5, f"{root}/lake", f"{root}/dlq")
    assert stream.landed(spark, f"{root}/lake").count() == 4 and stream.dead_letters(spark, f"{root}/dlq").count() == 1


def test_a_batch_touches_its_own_buckets_only(spark, tmp_path):
    root, schema = f"{tmp_path}/state", "user_id string, events long, last_event_ts timestamp"
    at = lambda minutes: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    files = lambda: {str(p.relative_to(root)) for p in (tmp_path / "state").rglob("*.parquet")}
    put = lambda number, rows: stream.upsert(spark.createDataFrame(rows, schema), number, root, ["user_id"], "events", buckets=8, changes=3)
    put(0, [(f"U{k}", 1, at(0)) for k in range(200)])
    assert len({f.split("/")[0] for f in files()}) == 8
    there = files()
    put(1, [("U7", 2, at(1))])
    assert len(files() - there) == 1 and there <= files()
    expected = {f"U{k}": 1 for k in range(200)} | {"U7": 2}
    state = lambda **b: {r.user_id: r.events for r in stream.last_state(spark, root, **b).collect()}
    assert state() == expected
    for number in range(2, 9):
        for _ in range(2):  # comes again after a crash
            put(number, [("U7", number + 1, at(number)), (f"V{number}", 1, at(number))])
        expected |= {"U7": number + 1, f"V{number}": 1}
        assert state() == expected
    bases = [f for f in files() if "state_kind=base" in f]
    assert bases and len(files()) < 30
    assert state(before=8)["U7"] == 8 and "V8" not in state(before=8)
    # A base that was begun but not marked as whole isn't read.
    half = spark.createDataFrame([("U7", 99, at(99))], schema)
    half.write.parquet(f"{root}/{bases[0].split('/')[0]}/state_batch=50/state_kind=base")
    assert state() == expected


def test_the_overlay_is_found_on_disk_and_expires(spark, tmp_path):
    root, schema = f"{tmp_path}/overlay", "user_id string, bucket long, events long, last_event_ts timestamp"
    at = lambda minutes: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    batches = [[("U1", 0, 2, at(0)), ("U2", 0, 1, at(1))], [("U1", 0, 3, at(4)), ("U1", 5, 1, at(6))], [("U3", 70, 1, at(70))]]
    for number, rows in enumerate(batches):
        for _ in range(2):  # a batch that comes again changes nothing
            stream.upsert(spark.createDataFrame(rows, schema), number, root, ["user_id", "bucket"], "events", ttl=3600 if number == 2 else None)
        got = {(r.user_id, r.bucket): r.events for r in stream.last_state(spark, root).collect()}
        if number == 1:
            assert got == {("U1", 0): 3, ("U2", 0): 1, ("U1", 5): 1}
    assert got == {("U3", 70): 1}


def test_sessions_of_silent_users_are_let_go(spark, tmp_path):
    root, schema = str(tmp_path), "user_id string, session_id string, event_ts timestamp"
    at = lambda minutes: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    parts = [[("U1", "s1", at(0)), ("U1", "s1", at(1))], [("U2", "t1", at(500))], [("U2", "t1", at(501))], [("U1", "s0", at(450))]]
    seen = []
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(schema).parquet(f"{root}/in").withWatermark("event_ts", stream.WATERMARK)
        run = stream.session_state(events).writeStream.outputMode("update").foreachBatch(lambda b, i: seen.extend(tuple(r) for r in b.select("user_id", "session_id", "session_len").collect()))
        run.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    assert ("U1", "s1", 60.0) in seen and ("U2", "t1", 60.0) in seen
    # U1's first session is gone, so the later one starts afresh rather than being held against it.
    assert ("U1", "s0", 0.0) in seen


def test_lag_is_observed_and_counts_are_held_against_what_landed(spark, tmp_path):
    from pyspark.sql import Observation

    seen = Observation()
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, s), "a") for s in range(10)], "event_ts timestamp, k string")
    stream.observed_lag(rows, F.lit("2024-01-01 00:00:10").cast("timestamp"), seen).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 10 and seen.get["max_s"] == 10.0 and 1 <= seen.get["p50_s"] <= 10
    assert lake.land_counted(rows, f"{tmp_path}/own", ["k"]) == 10
    twice = rows.union(rows)
    assert lake.land_counted(twice, f"{tmp_path}/own", ["k"]) == 20
