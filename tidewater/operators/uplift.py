"""Uplift learning and its metrics.

Metrics need running sums over one global order, which ``operators.order`` gives without a task that
sorts the whole population, whatever the scores look like. All rankings of a table go through in one pass.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool
from statistics import NormalDist
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scalars import clip
from tidewater.operators import order
from tidewater.sources.lake import written

#: Fixed value: bounds of the propensity.
PROPENSITY = (0.071, 0.929)
DEFAULT_THRESHOLD = 0.0070347543


def oracle(y: Column, w: Column) -> Column:
    """The ranking that knows the outcomes; it normalises the metrics."""
    return F.when(w == 1, y).otherwise(-y).cast("double")


def running(rows: DataFrame, score: str = "score", tie: str = "tie", by: tuple[str, ...] = (), buckets: int | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Rows (y, w, score, tie) with i, nt, nc, yt, yc: counts and outcomes up to each row by falling score, then tie, in each group of ``by``."""
    parts = {"i": F.lit(1), "nt": F.col("w"), "nc": 1 - F.col("w"), "yt": F.col("y") * F.col("w"), "yc": F.col("y") * (1 - F.col("w"))}
    return order.running(rows, [F.desc(score), F.col(tie)], parts, by, buckets, keep)


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def curves(rows: DataFrame, score: str = "score", by: tuple[str, ...] = (), n: int | None = None, groups: int = 1) -> DataFrame:
    """The qini and the cumulative gain curve of each of the ``groups`` of ``by``, of ``n`` rows: x, qini and gain after each row."""
    n = rows.count() if n is None else n
    r = running(rows, score, by=by, buckets=order.parts_of(rows.sparkSession, n * groups), keep=())
    return r.select(
        *by,
        "i",
        (F.col("i") / n).alias("x"),
        ((F.col("yt") - F.col("yc") * _ratio("nt", "nc")) / n).alias("qini"),
        ((_ratio("yt", "nt") - _ratio("yc", "nc")) * (F.col("nt") + F.col("nc")) / n).alias("gain"),
    )


def areas(points: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(qini, gain): area under each curve less the triangle below its end.

    The curve's trapezoids all are 1/n wide: their area is the sum of heights less half of the first
    and last, so rows needn't be ordered again.
    """
    def area(c: str) -> Column:
        first, last = F.min_by(c, "i"), F.max_by(c, "i")
        return (F.sum(c) - (first + last) / 2) / F.count("*") - last / 2

    return points.groupBy(*by).agg(area("qini").alias("qini"), area("gain").alias("gain"))


def rankings(rows: DataFrame, by_score: dict[str, Column], knowing: str | None = None) -> DataFrame:
    """(ranking, qini, auuc) of several scorings of the same rows (y, w, tie), in one pass.

    Areas are relative to those of the ranking that knows the outcomes, which one of the scorings may be
    (``knowing``) and is returned then too; null where that has none.
    """
    best = knowing or "\u0000best"
    scorings = {**by_score, best: oracle(F.col("y"), F.col("w"))}
    ways = F.array(*(F.struct(F.lit(k).alias("ranking"), v.cast("double").alias("_score")) for k, v in scorings.items()))
    long = rows.select("y", "w", "tie", F.explode(ways).alias("r")).select("y", "w", "tie", "r.*")
    got = areas(curves(long, "_score", ("ranking",), rows.count(), len(scorings)), ("ranking",))
    whole = got.groupBy().agg(*(F.max(F.when(F.col("ranking") == best, F.col(c))).alias(f"best_{c}") for c in ("qini", "gain")))
    norm = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    # One row a ranking: a side of a few rows.
    return (got if knowing else got.where(F.col("ranking") != best)).crossJoin(whole).select("ranking", norm("qini", "best_qini").alias("qini"), norm("gain", "best_gain").alias("auuc"))


def scores(rows: DataFrame, score: str = "score") -> DataFrame:
    """(qini, auuc) of one scoring, relative to the ranking that knows the outcomes."""
    return rankings(rows, {score: F.col(score)}).select("qini", "auuc")


def uplift_at(rows: DataFrame, shares: float | list[float], score: str = "score", tie: str = "tie") -> DataFrame:
    """(share, n, uplift) for each of ``shares``: difference of the arms' mean outcomes among the best; null if an arm is empty."""
    shares = [shares] if isinstance(shares, float) else shares
    n = rows.count()
    r = running(rows, score, tie, buckets=order.parts_of(rows.sparkSession, n), keep=("y", "w"))
    arm = lambda top, w: F.avg(F.when(top & (F.col("w") == w), F.col("y")))
    tops = [(share, F.col("i") <= max(1, round(share * n))) for share in shares]
    one = r.agg(F.array(*(F.struct(F.lit(s).alias("share"), F.count_if(t).alias("n"), (arm(t, 1) - arm(t, 0)).alias("uplift")) for s, t in tops)).alias("a"))
    return one.select(F.inline("a"))


def average_effect(rows: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Difference in means with its standard error and normal confidence interval."""
    z = NormalDist().inv_cdf(1 - alpha / 2)
    arm = lambda w: F.when(F.col("w") == w, F.col("y").cast("double"))
    a = rows.agg(F.avg(arm(1)).alias("p1"), F.avg(arm(0)).alias("p0"), F.count(arm(1)).alias("n_treat"), F.count(arm(0)).alias("n_control"))
    ate, se = F.col("p1") - F.col("p0"), F.sqrt(F.col("p1") * (1 - F.col("p1")) / F.col("n_treat") + F.col("p0") * (1 - F.col("p0")) / F.col("n_control"))
    return a.select("n_treat", "n_control", ate.alias("ate"), se.alias("se"), (ate - z * se).alias("ci_low"), (ate + z * se).alias("ci_high"))


def pseudo_outcome(e: Column, mu0: Column, mu1: Column, y: Column, w: Column, bounds: tuple[float, float] = PROPENSITY) -> Column:
    """Doubly robust pseudo-outcome; the propensity is clipped, as it divides."""
    e = clip(e, *bounds)
    return (mu1 - mu0) + w * (y - mu1) / e - (1 - w) * (y - mu0) / (1 - e)


def folds(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Rows with ``fold``: within each stratum of treatment and outcome, by hashed key in turn, so that a stratum's folds differ by one row at most."""
    hashed = rows.withColumn("_h", F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256))
    return order.ranked(hashed, ["w", "y"], [F.col("_h")], "_nth").withColumn("fold", ((F.col("_nth") - 1) % n).cast("int")).drop("_h", "_nth")


def assemble(rows: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(rows)


class Learner(NamedTuple):
    """A fitted doubly robust learner: the models of each fold, which haven't seen it, and the final one."""

    nuisance: dict[tuple[int, str], GBTClassificationModel]
    final: GBTRegressionModel
    features: list[str]


NUISANCE = ("e", "mu0", "mu1")
#: Most values of a feature that a tree tells apart (MLlib's maxBins).
BINS = 32
#: Share of the rows by which a bin's place in the order may be off.
BIN_ERROR = 0.001
#: Column of a cell's number of rows.
WEIGHT = "n"


def snapped(rows: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """``rows`` with each feature at the nearest of its ``bins`` quantiles over all rows, so that trees cut half way between two of them.

    Null and NaN stand at the greatest: trees send them to the right everywhere, as they do when they predict.
    """
    clean = rows.select(*(F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f) for f in features))
    found = clean.approxQuantile(features, [(i + 0.5) / bins for i in range(bins)], BIN_ERROR)
    out = {}
    for f, at in zip(features, found, strict=True):
        at = sorted(set(at)) or [0.0]
        middles = [(a + b) / 2 for a, b in zip(at, at[1:], strict=False)]
        x = F.col(f).cast("double")
        nth = F.lit(0)
        for m in middles:
            nth = nth + (x > m).cast("int")
        out[f] = F.when(x.isNull() | F.isnan(x), F.lit(at[-1])).otherwise(F.element_at(F.array(*map(F.lit, at)), nth + 1))
    return rows.withColumns(out)


def cells(rows: DataFrame, features: list[str], by: tuple[str, ...] = ("fold", "w", "y")) -> DataFrame:
    """The distinct ``snapped`` rows with their number: all that a tree learns from, as it tells no more values apart."""
    return snapped(rows, features).groupBy(*by, *features).agg(F.count("*").cast("double").alias(WEIGHT))


def _least(part: DataFrame, depth: int, rows_per_node: int) -> dict:
    """MLlib's settings for at least so many rows in a node; where rows have weights, a node's weight is what counts."""
    if WEIGHT not in part.columns:
        return {"minInstancesPerNode": rows_per_node, "maxDepth": depth}
    whole = part.agg(F.sum(WEIGHT)).first()[0] or 0.0
    if whole < 2 * rows_per_node:
        return {"maxDepth": 0, "weightCol": WEIGHT}
    # Half a row less, so that rounding never forbids a node of just enough rows.
    return {"minWeightFractionPerNode": (rows_per_node - 0.5) / whole, "maxDepth": depth, "weightCol": WEIGHT}


def others(rows: DataFrame, fold: int) -> DataFrame:
    """The rows that a fold's models are fitted on: those of all other folds."""
    return rows.where(F.col("fold") != fold)


def fit_fold(rows: DataFrame, fold: int, seed: int, trees: int, depth: int) -> dict[tuple[int, str], GBTClassificationModel]:
    """Propensity and outcome models of a fold, fitted on all the others; ``rows`` may be cells, whose numbers weigh them."""
    train = others(rows, fold)
    parts = {"e": (train, "w"), "mu0": (train.where("w = 0"), "y"), "mu1": (train.where("w = 1"), "y")}
    fit = lambda part, label: GBTClassifier(labelCol=label, featuresCol="features", maxIter=trees, stepSize=0.05, seed=seed, maxBins=BINS, **_least(part, depth, 50)).fit(part)
    return {(fold, name): fit(*of) for name, of in parts.items()}


def out_of_fold(rows: DataFrame, nuisance: dict[tuple[int, str], GBTClassificationModel]) -> DataFrame:
    """Rows with e, mu0 and mu1, each predicted by the models of the row's own fold."""
    out = []
    for k in sorted({fold for fold, _ in nuisance}):
        held = rows.where(F.col("fold") == k)
        for name in NUISANCE:
            held = nuisance[k, name].transform(held).withColumn(name, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")
        out.append(held)
    return reduce(DataFrame.union, out)


def dr_fit(rows: DataFrame, features: list[str], key: str, n_folds: int = 5, seed: int = 42, trees: int = 20, depth: int = 4) -> Learner:
    """Cross-fitted learner on rows (key, y, w, features).

    Folds are written once and counted into cells, which stand for every row: the fits, which go over
    their table hundreds of times, read no more than there are cells, at most 32 values a feature.
    """
    ready = written(folds(rows, key, n_folds, seed).select("y", "w", "fold", *features), "folds")
    ready = assemble(written(cells(ready, features), "cells"), features)
    # Folds are fitted side by side; their tables are small, so that most of a fit is waiting.
    with ThreadPool(n_folds) as pool:
        fits = pool.map(inheritable_thread_target(lambda k: fit_fold(ready, k, seed, trees, 5)), range(n_folds))
    nuisance = {name: model for fit in fits for name, model in fit.items()}
    target = out_of_fold(ready, nuisance).withColumn("dr", pseudo_outcome(F.col("e"), F.col("mu0"), F.col("mu1"), F.col("y"), F.col("w")))
    target = assemble(written(target.select(*features, WEIGHT, "dr"), "outcomes"), features)
    final = GBTRegressor(labelCol="dr", featuresCol="features", predictionCol="cate", maxIter=trees, stepSize=0.02, seed=seed, maxBins=BINS, **_least(target, depth, 30)).fit(target)
    return Learner(nuisance, final, list(features))


def dr_learner(rows: DataFrame, features: list[str], key: str, n_folds: int = 5, seed: int = 42, trees: int = 20, depth: int = 4):
    """The fitted regression of the pseudo-outcome on the features; its transform() predicts the effect of treatment."""
    return dr_fit(rows, features, key, n_folds, seed, trees, depth).final


def save(learner: Learner, path: str) -> None:
    """All models under ``path``, a folder each, and the order of the features."""
    for (fold, name), model in learner.nuisance.items():
        model.write().overwrite().save(f"{path}/nuisance/{fold}-{name}")
    learner.final.write().overwrite().save(f"{path}/final")
    spark = SparkSession.active()
    about = [(learner.features, sorted({k for k, _ in learner.nuisance}))]
    spark.createDataFrame(about, "features array<string>, folds array<int>").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load(spark: SparkSession, path: str) -> Learner:
    about = spark.read.parquet(f"{path}/about").first()
    nuisance = {(k, name): GBTClassificationModel.load(f"{path}/nuisance/{k}-{name}") for k in about.folds for name in NUISANCE}
    return Learner(nuisance, GBTRegressionModel.load(f"{path}/final"), list(about.features))


def effects(learner: Learner, rows: DataFrame) -> DataFrame:
    """``rows`` with cate, the effect that the final model predicts from the features in their order."""
    return learner.final.transform(assemble(rows, learner.features)).drop("features")


def decide_rows(learner: Learner, rows: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``rows`` with cate, decision and voucher; rows without any feature get no decision."""
    known = reduce(lambda a, b: a | b, (F.col(f).isNotNull() for f in learner.features))
    scored = effects(learner, rows).withColumn("cate", F.when(known, F.col("cate")))
    decision, voucher = decide(F.col("cate"), threshold)
    return scored.withColumns({"decision": decision, "voucher": voucher})


def drawn(salt: str, key: str = "tie") -> Column:
    """A number from 0 to 1 that hangs on key and salt alone."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(salt), F.col(key)), 256), 1, 8), 16, 10).cast("double") / float(2**32)


def sanity_of(rows: DataFrame, scores: dict[str, str], seed: int = 42) -> DataFrame:
    """(score, random_near_zero, oracle_beats_random, oracle_is_one, noise_lowers, better_than_random) of the metric on these outcomes, a row for each named column of scores.

    All rankings go through in one pass; the drawn one and the one that knows the outcomes are those of every score.
    """
    spreads = rows.agg(*(F.stddev_pop(c) for c in scores.values())).first()
    # A sum of three uniforms, scaled to five standard deviations of the score.
    draw = drawn(f"{seed}a") + drawn(f"{seed}b") + drawn(f"{seed}c") - 1.5
    ways = {"random": drawn(f"{seed}r"), "oracle": oracle(F.col("y"), F.col("w"))}
    for k, (c, spread) in enumerate(zip(scores.values(), spreads, strict=True)):
        ways |= {f"own{k}": F.col(c), f"noisy{k}": F.col(c) + draw * (2 * (spread or 0.0) * 5)}
    # One row a ranking.
    got = rankings(rows, ways, "oracle").groupBy().agg(*(F.max(F.when(F.col("ranking") == k, F.col("qini"))).alias(k) for k in ways))
    flags = lambda own, noisy: (
        (F.abs("random") < 0.05).alias("random_near_zero"), (F.col("oracle") > F.col("random")).alias("oracle_beats_random"), (F.abs(F.col("oracle") - 1) < 1e-9).alias("oracle_is_one"),
        (F.col(noisy) < F.col(own) + 1e-9).alias("noise_lowers"), (F.col(own) > F.col("random")).alias("better_than_random"),
    )
    return got.select(F.inline(F.array(*(F.struct(F.lit(name).alias("score"), *flags(f"own{k}", f"noisy{k}")) for k, name in enumerate(scores)))))


def sanity(rows: DataFrame, seed: int = 42, score: str = "score") -> DataFrame:
    """(random_near_zero, oracle_beats_random, oracle_is_one, noise_lowers, better_than_random) of the metric on these outcomes and this score."""
    return sanity_of(rows, {score: score}, seed).drop("score")


def decide(score: Column, threshold: float = DEFAULT_THRESHOLD) -> tuple[Column, Column]:
    """Decision and voucher of a score; a null or NaN score gets no decision."""
    known = score.isNotNull() & ~F.isnan(score)
    send = known & (score >= threshold)
    return F.when(send, "SEND_VOUCHER").when(known, "NO_VOUCHER").otherwise("NO_DECISION"), F.when(send, "voucher_30").otherwise("no_voucher")


def log_sample(decisions: DataFrame, rate: float, key: str) -> DataFrame:
    """The same share of decisions on every run: by hashed key."""
    return decisions.where(F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("double") < rate * float(2**32))
