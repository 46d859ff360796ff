"""Serving and training tables: assembly, defaults, precedence, derived features and model vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scalars import number_or, tolerant_cast, total


def assemble(base: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row an entity: every part joined to the left on the keys."""
    for part in parts:
        base = base.join(part, keys, "left")
    return base


def fill_defaults(rows: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Nulls (not NaN, which is a value) by the specification's defaults, the only source of defaults."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(rows.schema[c].dataType)) for c, v in defaults.items() if c in rows.columns})


def rename_features(rows: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Business names for raw columns; a name given twice is an error."""
    names = list(aliases.values())
    if len(set(names)) < len(names):
        raise ValueError(f"alias given twice: {sorted({n for n in names if names.count(n) > 1})}")
    return rows.withColumnsRenamed(aliases)


def training_set(features: DataFrame, labels: DataFrame, overlay: DataFrame | None, keys: list[str]) -> DataFrame:
    """Labelled rows with features (all must be there) and, where given, the realtime overlay (may be missing)."""
    rows = labels.join(features, keys)
    return rows if overlay is None else rows.join(overlay, keys, "left")


def holdout(rows: DataFrame, day: str, version: str) -> DataFrame:
    """The frozen holdout: test split of one day under one version name."""
    return rows.where((F.col("split") == "test") & (F.col("dt") == F.to_date(F.lit(day)))).withColumn("holdout_version", F.lit(version))


def single_version(rows: DataFrame, column: str = "holdout_version") -> DataFrame:
    """``rows``, once it is sure that they have exactly one version."""
    found = rows.select(column).distinct().limit(2).count()
    if found != 1:
        raise ValueError(f"{column}: exactly one version is allowed, found {'none' if not found else 'several'}")
    return rows


def training_window(rows: DataFrame, split: str, last_day: str, weeks: int, columns: list[str], limit: int | None = None) -> DataFrame:
    """Rows of a split from ``weeks`` weeks before a day up to that day, columns in the order asked for."""
    last = F.to_date(F.lit(last_day))
    out = rows.where((F.col("split") == split) & F.col("dt").between(F.date_sub(last, 7 * weeks), last)).select(*columns)
    return out if limit is None else out.limit(limit)


def one_day(rows: DataFrame, day: str | None) -> DataFrame:
    """Rows of a partition day; None stands for all days."""
    return rows if day is None else rows.where(F.col("dt") == F.to_date(F.lit(day)))


def merge_overlay(batch: DataFrame, overlay: DataFrame, features: dict[str, float], key: str) -> DataFrame:
    """Batch features under the overlay's: realtime first, then batch, then default; ``defaulted`` counts the last."""
    over = overlay.select(key, *(F.col(c).alias(f"_rt_{c}") for c in features if c in overlay.columns))
    rows = batch.join(over, key, "left")
    pick = {}
    for c in features:
        sources = [F.col(n) for n in (f"_rt_{c}", c) if n in rows.columns]
        pick[c] = F.coalesce(*sources) if sources else F.lit(None).cast("double")
    missing = total([v.isNull().cast("int") for v in pick.values()])
    return rows.select(key, *(F.coalesce(v, F.lit(features[c])).alias(c) for c, v in pick.items()), missing.alias("defaulted"))


def decision_input(rows: DataFrame, features: dict[str, str], order: list[str], key: str) -> DataFrame:
    """Model input from text maps ``context``, ``realtime`` and ``batch``, in that precedence.

    An empty text counts as missing, and missing stays null (the model fills medians), as does what
    can't be read as its kind. Also ``missing``, ``supplied`` and ``realtime_applied`` over ``order``.
    """
    def value(name: str) -> Column:
        raw = F.coalesce(*(F.nullif(F.try_element_at(m, F.lit(name)), F.lit("")) for m in ("context", "realtime", "batch")))
        return F.when(raw.isNotNull(), tolerant_cast(raw, features[name], None if features[name] != "str" else ""))

    values = {name: value(name) for name in order}
    present = {n: v.isNotNull().cast("int") for n, v in values.items()}
    realtime = [p for n, p in present.items() if n.startswith("rt_")]
    return rows.select(
        key,
        *(v.alias(n) for n, v in values.items()),
        (F.lit(len(order)) - total(list(present.values()))).alias("missing"),
        total(list(present.values())).alias("supplied"),
        (total(realtime) if realtime else F.lit(0)).alias("realtime_applied"),
    )


#: What the derived features are made of.
NONZERO_COLUMNS = ("f9", "f16", "f27", "f26", "f14", "f3", "f13", "f10", "f17", "f7")
FLAG_COLUMNS = ("f66", "f68", "f75")


def derived(defaults: dict[str, float]) -> dict[str, Column]:
    """The seven derived features over columns filled by ``defaults`` (medians)."""
    f = lambda c: number_or(F.col(c), defaults.get(c, 0.0))
    ratio = lambda a, b: f(a) / (f(b) + 1.0)
    return {
        "fe_ratio_f1_f2": ratio("f1", "f2"),
        "fe_ratio_f14_f16": ratio("f14", "f16"),
        "fe_ratio_f9_f27": ratio("f9", "f27"),
        "fe_inter_f9_f26": f("f9") * f("f26"),
        "fe_inter_f14_f27": f("f14") * f("f27"),
        "fe_nonzero_top10": total([(f(c) != 0.0).cast("int") for c in NONZERO_COLUMNS]).cast("double"),
        "fe_flag_sum": total([f(c) for c in FLAG_COLUMNS]),
    }


def model_vector(slots: list[tuple[str, str]], defaults: dict[str, float]) -> Column:
    """The model's ordered input: per slot (name, kind) a derived, a stored (filled by default) or a fixed value."""
    made = derived(defaults)
    pick = {"derived": lambda n: made[n], "stored": lambda n: number_or(F.col(n), defaults.get(n, 0.0)), "fixed": lambda n: F.lit(float(defaults.get(n, 0.0)))}
    return F.array(*(pick[kind](name) for name, kind in slots))
