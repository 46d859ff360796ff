"""Work that has to spread over tasks, and isn't to be done more than once a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.plans import operations as O
from tidewater.plans import streams
from tidewater.streaming import events as stream
from tidewater.streaming import health

SF = "/root/testdata/sf0.001"


def test_a_counted_message_is_parsed_once(spark):
    """Null labels aren't filtered below the parse, where each mention of the event would parse it again."""
    rows = spark.createDataFrame([('{"event_id": "a", "user_id": "U1", "event_type": "order", "event_ts": "1"}',), ("{broken",), ("[]",)], "value string")
    tallied = quality.tally({"dead_letters": (stream.decode(rows), F.col("reason"))})
    assert tallied._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [tuple(r) for r in tallied.collect()] == [("dead_letters", "invalid_json", 2)]


def test_messages_are_built_in_many_tasks(spark):
    """The table is one file of one row group."""
    assert sum(1 for n in O._messages(spark, SF).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n) > 1


def test_a_delivery_is_written_by_many_tasks(spark, tmp_path):
    """And a stream takes it as one batch all the same."""
    rows = spark.range(0, 400, numPartitions=4)
    for k in streams._delivered(rows, f"{tmp_path}/in", F.col("id") % 2, range(2)):
        assert len(spark.read.parquet(f"{tmp_path}/in").inputFiles()) == 4 * (k + 1)
        seen = stream.file_source(spark, f"{tmp_path}/in", "id long", None)
        assert stream.run_to_table(seen, f"{tmp_path}/out", f"{tmp_path}/checkpoint").count() == 200 * (k + 1)
    batches = [p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(batches) == 2


def test_files_of_one_delivery_count_once(spark, tmp_path):
    """Files that no batch write has named count each."""
    since = F.lit("2000-01-01").cast("timestamp")
    observed = lambda path: health.new_files(spark.read.parquet(path), since).first().observed
    for k in streams._delivered(spark.range(0, 400, numPartitions=4), f"{tmp_path}/in", F.col("id") % 3, range(3)):
        assert observed(f"{tmp_path}/in") == k + 1
    for n, f in enumerate(sorted((tmp_path / "in").glob("part-*.parquet"))):
        f.rename(f.with_name(f"part-{n}.parquet"))
    assert observed(f"{tmp_path}/in") == 12
