"""The numbered queries, each its operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontam, graph, langid, licenses, lines, minhash, mixing, negatives, neighbours, periods, quality, secrets, substrings
from tidewater.llm.common import fold, table
from tidewater.llm.sql import ORACLE_SQL  # noqa: F401


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    score = quality.scorer(spark, quality.fit(docs, learn))
    scored = docs.select("doc_id", score("text").alias("score"))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", quality.predicted().alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    found = langid.predict(docs, model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.deduplicate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document with the training positions of its occurrences, range-sorted by the first; unused ones come last."""
    mixed = mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "positions")
    order = (F.coalesce(F.try_element_at("positions", F.lit(1)), F.lit(2.0)).alias("first"), F.col("doc_id"))
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.links(table(spark, sf_dir, "embeddings"))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # One document in ten is made periodic from some word on.
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("h", h).withColumn("w", F.when((h % 10 == 0), words))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    times = F.ceil((n - a) / p)
    part = lambda begin, length: F.slice("w", (begin + 1).cast("int"), length.cast("int"))
    planted = F.slice(F.concat(part(F.lit(0), a), F.flatten(F.array_repeat(part(a, p), times.cast("int")))), 1, n.cast("int"))
    docs = docs.select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
    found = periods.repetitions(docs)
    runs = F.col("runs")
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), (-best["l"]).alias("length"), best["period"].alias("period"),
        F.floor(-1000 * best["l"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"), "collapsed_sha256",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_lines,
        op3_decontamination,
        op4_licenses,
        op5_substrings,
        op6_mixing,
        op7_language,
        op8_neighbours,
        op9_minhash,
        op10_secrets,
        op11_negatives,
        op12_near_vectors,
        op13_periods,
    )
}
