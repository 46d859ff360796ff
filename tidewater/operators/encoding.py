"""Dictionaries of observed value tuples, lookups, one-hot layouts and their inverses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.scalars import total


def value_dictionary(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(level_id, columns...): observed tuples numbered from 0 in their order. A dictionary is small by nature."""
    tuples = rows.select(*columns).distinct()
    return tuples.select((F.row_number().over(Window.orderBy(*columns)) - 1).alias("level_id"), *columns)


def encode_levels(rows: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with their tuple's level_id; null where the dictionary doesn't know it."""
    return rows.join(dictionary, columns, "left")


def unknown_tuples(rows: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*columns).distinct().join(dictionary, columns, "left_anti")


def encoding_map(dictionary: DataFrame, version: str, attribute: str, columns: list[str]) -> DataFrame:
    """(encoding_version, attr_name, level_id, column_name, value): a dictionary in long form."""
    long = dictionary.unpivot(["level_id"], columns, "column_name", "value")
    return long.select(F.lit(version).alias("encoding_version"), F.lit(attribute).alias("attr_name"), "level_id", "column_name", F.col("value").cast("double"))


def lookup(attributes: DataFrame, encoding: DataFrame, version: str) -> DataFrame:
    """(target_id, column_name, value) by attribute and level of one encoding version."""
    known = encoding.where(F.col("encoding_version") == version).drop("encoding_version")
    return attributes.join(known, ["attr_name", "level_id"]).select("target_id", "column_name", "value")


def one_hot(attributes: DataFrame, layout: DataFrame, version: str) -> DataFrame:
    """(target_id, column_name, value): every column of the attribute's group, 1 for the level's own."""
    columns = layout.where(F.col("encoding_version") == version).select("attr_name", "level_index", "column_name")
    hot = (F.col("level_index") == F.col("level_id")).cast("double")
    return attributes.join(columns, "attr_name").select("target_id", "column_name", hot.alias("value"))


def pivot_features(long: DataFrame, columns: list[str]) -> DataFrame:
    """One column a name; names are given, so Spark needn't look for them first."""
    return long.groupBy("target_id").pivot("column_name", columns).agg(F.max("value"))


def one_hot_sum(wide: DataFrame, columns: list[str]) -> DataFrame:
    hot = total([F.coalesce((F.col(c) == 1.0).cast("int"), F.lit(0)) for c in columns])
    return wide.select("target_id", hot.alias("hot_count"))


def decode_one_hot(wide: DataFrame, columns: list[str]) -> DataFrame:
    """(target_id, level_index, ok): place of the single hot column; null and not ok where not just one is."""
    values = F.array(*(F.coalesce(c, F.lit(0.0)) for c in columns))
    hot = F.size(F.filter(values, lambda v: v == 1.0))
    return wide.select("target_id", F.when(hot == 1, F.array_position(values, 1.0) - 1).cast("int").alias("level_index"), (hot == 1).alias("ok"))


def decode_lookup(wide: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    return wide.join(dictionary, columns, "left").select("target_id", "level_id", F.col("level_id").isNotNull().alias("ok"))


def bijection(dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """(n_levels, n_tuples, n_pairs, bijective): both directions are functions over the whole domain."""
    value = F.struct(*columns)
    counted = dictionary.agg(
        F.countDistinct("level_id").alias("n_levels"), F.countDistinct(value).alias("n_tuples"), F.countDistinct("level_id", value).alias("n_pairs")
    )
    return counted.withColumn("bijective", (F.col("n_levels") == F.col("n_tuples")) & (F.col("n_levels") == F.col("n_pairs")))


def round_trip(dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Levels that don't come back when encoded and decoded; none if the dictionary is sound."""
    decoded = dictionary.select(*columns).join(dictionary.withColumnRenamed("level_id", "back"), columns, "left")
    return dictionary.join(decoded, columns).where("NOT (level_id <=> back)").select("level_id", "back")
