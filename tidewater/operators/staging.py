"""Cleaning: casts, key checks and one row a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.scalars import from_epoch
from tidewater.sources.lake import FEATURES


def keep_first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key, the first by ``order``. Spark limits groups before it shuffles them."""
    nth = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(nth)).where("_nth = 1").drop("_nth")


def app_events(landed: DataFrame) -> DataFrame:
    """Typed events, each id once, as it first landed; rows without id, user or time go."""
    rows = landed.dropna(subset=["event_id", "user_id", "event_ts"])
    rows = keep_first(rows, ["event_id"], ["ingested_at", "kafka_partition", "kafka_offset"])
    price = F.coalesce(F.col("price").cast("double"), F.lit(0.0))
    quantity = F.coalesce(F.col("quantity").cast("int"), F.lit(0))
    at = from_epoch(F.col("event_ts"))
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "session_id",
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity).alias("gmv"),
        at.alias("event_ts"),
        F.to_date(at).alias("event_date"),
        from_epoch(F.col("ingested_at")).alias("ingested_at"),
    )


WITNESS_COLUMNS = ["event_id", "customer_id", "target_id", "event_type", "event_ts", "observation_ts", "source_type", "generation_run_id"]


def witness_events(raw: DataFrame) -> DataFrame:
    """Witness events by allow-list, so that no generator column reaches a feature; first observed copy of each id."""
    rows = raw.select(*WITNESS_COLUMNS).dropna(subset=["event_id", "target_id", "event_ts"])
    rows = rows.withColumns({c: from_epoch(F.col(c)) for c in ("event_ts", "observation_ts")})
    return keep_first(rows, ["event_id"], ["observation_ts"])


def user_snapshot(raw: DataFrame) -> DataFrame:
    """The latest row of each user and day, features as doubles."""
    rows = keep_first(raw, ["user_id", "dt"], [F.desc("feature_ts")])
    head = ["user_id", "data_id", "split", "dt", "feature_ts", "label", "is_treat"]
    return rows.select(*head, *(F.col(f).cast("double").alias(f) for f in FEATURES if f in rows.columns))


def id_collisions(splits: list[DataFrame], key: str) -> DataFrame:
    """(n_rows, n_ids, collides) over the union of splits."""
    both = splits[0].select(key)
    for s in splits[1:]:
        both = both.unionAll(s.select(key))
    counted = both.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_ids"))
    return counted.withColumn("collides", F.col("n_rows") != F.col("n_ids"))
