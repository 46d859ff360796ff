"""Row rules of a table in one scan: failing rows stored by check, results appended with their details."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.lake import read_or_empty

RESULT = (
    "logical_date date, check_name string, target string, severity string, passed boolean, observed double, threshold double, details string, checked_at timestamp"
)


class Rule(NamedTuple):
    """A condition that every row must meet, unless at most a share ``limit`` of them break it; null counts as broken."""

    name: str
    holds: Column
    severity: str = "error"
    limit: float = 0.0


def run(rows: DataFrame, target: str, rules: list[Rule], keys: list[str], day: str, failures: str, results: str) -> DataFrame:
    """Check ``rows`` against all rules, store what fails and append a result row a rule; the rows appended.

    The table is read once: each row carries the names of the rules it breaks, rows that break any go to
    ``failures`` (a folder a day, target and check, which a run that comes again overwrites) and the counts
    are observed on the way. ``details`` says how many rows there were and failed and where they are.
    """
    spark = rows.sparkSession
    broken = [~F.coalesce(r.holds, F.lit(False)) for r in rules]
    seen = Observation()
    marked = rows.withColumn("_broken", F.array_compact(F.array(*(F.when(b, r.name) for r, b in zip(rules, broken, strict=True)))))
    counts = [F.count_if(F.array_contains("_broken", r.name)).alias(f"r{k}") for k, r in enumerate(rules)]
    marked = marked.observe(seen, F.count(F.lit(1)).alias("n"), *counts)
    bad = marked.where(F.size("_broken") > 0).select(*keys, F.explode("_broken").alias("check_name"), F.lit(target).alias("target"), F.lit(day).alias("day"))
    bad.write.partitionBy("day", "target", "check_name").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(failures)
    got = seen.get
    n = got["n"]
    out = []
    for k, r in enumerate(rules):
        failed = got[f"r{k}"]
        share = failed / n if n else 0.0
        where = f"day={day}/target={target}/check_name={r.name}" if failed else None
        details = json.dumps({"n_rows": n, "n_failed": failed, "stored": where}, sort_keys=True)
        out.append((r.name, r.severity, share <= r.limit, share if r.limit else float(failed), r.limit, details))
    made = spark.createDataFrame(out, "check_name string, severity string, passed boolean, observed double, threshold double, details string")
    made = made.withColumns({"logical_date": F.to_date(F.lit(day)), "target": F.lit(target), "checked_at": F.current_timestamp()}).select("logical_date", "check_name", "target", "severity", "passed", "observed", "threshold", "details", "checked_at")
    made.coalesce(1).write.mode("append").parquet(results)
    return made


def stored(spark: SparkSession, failures: str) -> DataFrame:
    """Failing rows of all days, targets and checks."""
    return spark.read.parquet(failures)


def results(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RESULT)
