"""Data quality: checks as result rows, profiles, and the verdict over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.scalars import close, guarded_ratio

SECONDS_PER_HOUR = 3600.0


def _result(name: str, target: str, severity: str, observed: Column, threshold: float, passed: Column) -> list[Column]:
    """Aggregates of one check, to be computed beside those of other checks."""
    return [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(target).alias("target"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            observed.cast("double").alias("observed"),
            F.lit(float(threshold)).alias("threshold"),
            F.lit(severity).alias("severity"),
        )
    ]


def not_null(target: str, column: str, severity: str = "error") -> list[Column]:
    bad = F.count_if(F.col(column).isNull())
    return _result(f"not_null:{column}", target, severity, bad, 0, bad == 0)


def at_least_zero(target: str, column: str, severity: str = "error") -> list[Column]:
    bad = F.count_if(F.col(column) < 0)
    return _result(f"at_least_zero:{column}", target, severity, bad, 0, bad == 0)


def accepted_values(target: str, column: str, values: list, severity: str = "error") -> list[Column]:
    bad = F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return _result(f"accepted_values:{column}", target, severity, bad, 0, bad == 0)


def null_rate_below(target: str, column: str, limit: float = 0.02, severity: str = "warn") -> list[Column]:
    rate = F.avg(F.col(column).isNull().cast("double"))
    return _result(f"null_rate:{column}", target, severity, rate, limit, rate <= limit)


def min_rows(target: str, least: int = 1000, severity: str = "error") -> list[Column]:
    n = F.count("*")
    return _result("min_rows", target, severity, n, least, n >= least)


def fresh(target: str, column: str, as_of: Column, hours: float = 26, severity: str = "error") -> list[Column]:
    age = (F.unix_micros(as_of) - F.unix_micros(F.max(column))) / (1e6 * SECONDS_PER_HOUR)
    return _result(f"freshness:{column}", target, severity, age, hours, age <= hours)


def run_checks(rows: DataFrame, checks: list[list[Column]]) -> DataFrame:
    """All checks of a table in one pass over it, one result row each."""
    return rows.agg(F.array(*reduce(lambda a, b: a + b, checks)).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def unique(rows: DataFrame, target: str, column: str, severity: str = "error") -> DataFrame:
    repeated = rows.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    bad = F.count("*")
    return run_checks(repeated, [_result(f"unique:{column}", target, severity, bad, 0, bad == 0)])


def failing(rows: DataFrame, condition: Column, check: str) -> DataFrame:
    """The rows themselves that break a rule, to be stored."""
    return rows.where(~F.coalesce(condition, F.lit(False))).withColumn("check_name", F.lit(check))


def rollup(results: DataFrame, since: Column) -> DataFrame:
    return results.where(F.col("checked_at") >= since).groupBy("target").agg(
        F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.max("checked_at").alias("last_checked")
    )


def verdict(results: DataFrame) -> DataFrame:
    """(n_checks, n_failed, ok): only failed checks of severity error count against."""
    bad = ~F.col("passed") & (F.col("severity") == "error")
    return results.agg(F.count("*").alias("n_checks"), F.count_if(~F.col("passed")).alias("n_failed"), F.coalesce(F.bool_and(~bad), F.lit(True)).alias("ok"))


def null_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, null_rate): all columns in one pass, then unpivoted."""
    one = rows.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns))
    return one.unpivot([], columns, "feature", "null_rate")


def worst_null_rates(rows: DataFrame, columns: list[str], k: int) -> DataFrame:
    return null_rates(rows, columns).orderBy(F.desc("null_rate"), "feature").limit(k)


def means(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*(F.avg(c).alias(c) for c in columns)).unpivot([], columns, "feature", "mean")


def column_stats(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, median, low, high), medians exact."""
    one = rows.agg(*(F.struct(F.percentile(c, F.lit(0.5)).alias("median"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns))
    return one.unpivot([], columns, "feature", "s").select("feature", "s.median", "s.low", "s.high")


def training_stats(rows: DataFrame) -> DataFrame:
    y, w = F.col("label"), F.col("is_treat")
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.sum(w).alias("n_treated"),
        F.sum(y).alias("n_positive"),
        F.avg(w).alias("treatment_ratio"),
        F.avg(y).alias("conversion"),
        F.avg(F.when(w == 1, y)).alias("conversion_treated"),
        F.avg(F.when(w == 0, y)).alias("conversion_control"),
    )


def check_trainable(rows: DataFrame, least: int = 1000) -> DataFrame:
    """The statistics, once rows suffice and both arms are there."""
    stats = training_stats(rows)
    got = stats.first()
    if got.n_rows < least or not 0 < (got.n_treated or 0) < got.n_rows:
        raise ValueError(f"not trainable: {got.n_rows} rows, {got.n_treated} treated")
    return stats


def checksum(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A table's fingerprint that doesn't depend on row order: exact integer sums of row hashes."""
    h = F.xxhash64(*columns)
    exact = F.sum(h.cast("decimal(38,0)"))
    return rows.agg(F.count("*").alias("n_rows"), F.substring(F.sha2(F.concat_ws("|", F.count("*").cast("string"), exact.cast("string")), 256), 1, 16).alias("checksum"))


def same_checksum(before: DataFrame, after: DataFrame) -> DataFrame:
    """(n_rows, stable) of the checksums of one table at two times."""
    then = before.select(F.col("n_rows").alias("n_before"), F.col("checksum").alias("before"))
    return after.crossJoin(then).select("n_rows", ((F.col("checksum") == F.col("before")) & (F.col("n_rows") == F.col("n_before"))).alias("stable"))


def tally(counters: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(counter, label, n): rows of each counter by its label; nulls aren't counted.

    They go by their count of none: a filter on the label would be pushed down to the rows and compute it
    again there, with all that it is made of once for each mention.
    """
    parts = [rows.select(F.lit(name).alias("counter"), label.alias("label")).groupBy("counter", "label").agg(F.count("label").alias("n")).where("n > 0") for name, (rows, label) in counters.items()]
    return reduce(DataFrame.unionByName, parts)


def violations(rules: dict[str, DataFrame]) -> DataFrame:
    """(rule, n): rows that break each rule, none being right."""
    return reduce(DataFrame.unionByName, [bad.agg(F.lit(rule).alias("rule"), F.count("*").alias("n")) for rule, bad in rules.items()])


def contaminated(train: DataFrame, synthetic: DataFrame, key: str) -> DataFrame:
    """Training users who have synthetic events; none are allowed."""
    return train.select(key).distinct().join(synthetic.select(key).distinct(), key, "left_semi")


def source_readiness(sources: dict[str, DataFrame | None]) -> DataFrame:
    """(source, n_rows, state): missing, empty or ready."""
    def one(name: str, rows: DataFrame) -> DataFrame:
        n = F.count("*")
        return rows.agg(F.lit(name).alias("source"), n.alias("n_rows"), F.when(n > 0, "ready").otherwise("empty").alias("state"))

    there = [one(k, v) for k, v in sources.items() if v is not None]
    spark = there[0].sparkSession
    gone = spark.createDataFrame([(k, 0, "missing") for k, v in sources.items() if v is None], "source string, n_rows long, state string")
    return reduce(DataFrame.unionByName, [*there, gone])


def reconcile(expected: DataFrame, actual: DataFrame, key: str, columns: list[str], tolerance: float) -> DataFrame:
    """(feature, n_compared, n_mismatched, n_missing) of two versions of the same rows."""
    e = expected.unpivot([key], columns, "feature", "expected")
    a = actual.unpivot([key], columns, "feature", "actual").withColumn("there", F.lit(True))
    both = e.join(a, [key, "feature"], "left")
    there = F.coalesce("there", F.lit(False))
    return both.groupBy("feature").agg(
        F.count_if(there).alias("n_compared"), F.count_if(there & ~close(F.col("expected"), F.col("actual"), tolerance)).alias("n_mismatched"), F.count_if(~there).alias("n_missing")
    )


def volume(published: DataFrame, mart: DataFrame, limit: float) -> DataFrame:
    """(published_rows, mart_rows, gap, ok): row counts within a relative limit."""
    p, m = (d.agg(F.count("*").alias(n)) for d, n in ((published, "published_rows"), (mart, "mart_rows")))
    gap = guarded_ratio(F.abs(F.col("published_rows") - F.col("mart_rows")).cast("double"), F.col("mart_rows"))
    return p.crossJoin(m).withColumn("gap", gap).withColumn("ok", F.col("gap") <= limit)


def lag_percentiles(rows: DataFrame, seconds: Column) -> DataFrame:
    q = F.percentile(seconds, F.array(F.lit(0.5), F.lit(0.95)))
    return rows.agg(F.count("*").alias("n"), q.alias("q"), F.max(seconds).alias("max_s")).select("n", F.col("q")[0].alias("p50_s"), F.col("q")[1].alias("p95_s"), "max_s")


def run_summary(runs: DataFrame) -> DataFrame:
    seconds = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1e6
    return runs.groupBy("status").agg(F.count("*").alias("n_runs"), F.avg(seconds).alias("mean_s"))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    nth = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(nth)).where("_nth = 1").drop("_nth")
