"""Running sums, ranks and doubling over more rows than one task should have."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import lineage, order, uplift


def test_equal_scores_spread_over_partitions(spark):
    rows = spark.range(20_000).select(F.lit(0.5).alias("score"), (F.col("id") % 2).cast("int").alias("w"), (F.col("id") % 3 == 0).cast("int").alias("y"), F.sha2(F.col("id").cast("string"), 256).alias("tie"))
    sizes = [r["count"] for r in order.ranged(rows, [F.desc("score"), F.col("tie")], 8).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    got = uplift.running(rows, buckets=8).select("tie", "i", "nt").collect()
    assert sorted(r.i for r in got) == list(range(1, 20_001)) and [r.tie for r in sorted(got, key=lambda r: r.i)] == sorted(r.tie for r in got)


def test_ranks_within_strata(spark):
    rows = spark.createDataFrame([(None if i % 7 == 0 else i % 3, (i * 7919) % 1009) for i in range(1000)], "g int, v int")
    got = order.ranked(rows, ["g"], [F.col("v")], parts=5).collect()
    for g in (None, 0, 1, 2):
        own = sorted((r["rank"], r.v) for r in got if r.g == g)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)
    assert order.ranked(rows.limit(0), ["g"], [F.col("v")]).count() == 0


def test_folds_differ_by_one_row_at_most(spark):
    rows = spark.range(1003).select("id", (F.col("id") % 2).alias("w"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    counts = {}
    for r in uplift.folds(rows, "id", 4, 1).groupBy("w", "y", "fold").count().collect():
        counts.setdefault((r.w, r.y), []).append(r["count"])
    assert all(len(c) == 4 and max(c) - min(c) <= 1 for c in counts.values())


def test_ends_of_long_ways(spark):
    """64 generations of runs, a tail into a cycle, and a parent that isn't there: rounds are few and a row a run is all there is."""
    tree = [(f"{g}-{k}", f"{g - 1}-{k // 2}" if g else None, "real", "0-0") for g in range(64) for k in range(40)]
    odd = [("t1", "t2", "real", "t1"), ("t2", "c1", "synthetic", "t1"), ("c1", "c2", "real", "c1"), ("c2", "c3", "real", "c1"), ("c3", "c1", "real", "c1"), ("lone", "gone", "real", "lone")]
    runs = spark.createDataFrame(tree + odd, "run_id string, parent_run_id string, source_type string, root_run_id string").repartition(4)
    got = {r.start_run: (r.top, r.depth, r.is_cycle, r.all_real) for r in lineage.ends(runs).collect()}
    assert len(got) == len(tree) + len(odd)
    assert all(got[f"{g}-0"] == ("0-0", g, False, True) for g in range(64))
    assert got["5-39"] == ("0-1", 5, False, True) and got["lone"] == ("lone", 0, False, True)
    assert got["c2"] == (None, 3, True, True) and got["t1"] == (None, 5, True, False)


def test_walks_stop_where_a_run_comes_again(spark):
    runs = spark.createDataFrame([("t", "a", "real", "t"), ("a", "b", "real", "t"), ("b", "a", "real", "t"), ("s", "s", "real", "s")], "run_id string, parent_run_id string, source_type string, root_run_id string")
    got = sorted((r.start_run, r.depth, "/".join(r.path), r.is_cycle) for r in lineage.walk(spark, runs).collect())
    assert got == [
        ("a", 0, "a", False), ("a", 1, "a/b", False), ("a", 2, "a/b/a", True), ("b", 0, "b", False), ("b", 1, "b/a", False), ("b", 2, "b/a/b", True),
        ("s", 0, "s", False), ("s", 1, "s/s", True), ("t", 0, "t", False), ("t", 1, "t/a", False), ("t", 2, "t/a/b", False), ("t", 3, "t/a/b/a", True),
    ]


def test_running_sums_need_one_shuffle_of_the_rows(spark):
    """Only the sums of whole partitions go through a window; groups may begin and end within a partition, and values may be null."""
    rows = spark.createDataFrame([(None if i % 7 == 0 else i % 3, (i * 7919) % 1009, None if i % 11 == 0 else i % 5) for i in range(1000)], "g int, v int, x int")
    assert order.running(rows, [F.col("v")], {"s": F.col("x")})._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    got = order.running(rows, [F.desc("v")], {"i": F.lit(1), "s": F.col("x")}, ("g",), 5, keep=("v", "x")).collect()
    assert len(got) == 1000
    for g in (None, 0, 1, 2):
        own, total = sorted((r for r in got if r.g == g), key=lambda r: -r.v), 0
        for i, r in enumerate(own, 1):
            total += r.x or 0
            assert (r.i, r.s) == (i, total)


def test_scores_are_judged_together(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("tie"), (F.col("id") % 2).cast("int").alias("w"), (F.col("id") % 7 / 7).alias("score"), (F.col("id") % 7 + F.col("id") % 2 > 5).cast("int").alias("y")).withColumn("broken", -F.col("score"))
    got = {r.score: tuple(r)[1:] for r in uplift.sanity_of(rows, {"right": "score", "wrong": "broken"}).collect()}
    assert got == {"right": tuple(uplift.sanity(rows).first()), "wrong": tuple(uplift.sanity(rows, score="broken").first())}
    assert got["right"][-1] and not got["wrong"][-1]
