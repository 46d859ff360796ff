"""A training corpus from raw documents: five stages, each a DataFrame in and a DataFrame out.

Every stage works on what the one before kept, written as Parquet and read again. Labels, benchmark
and other tables come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontam, lines, minhash, mixing, quality
from tidewater.llm.common import cut, drop_written, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject (score of at least 0.3).

    Every row is judged by its own text, so repeated rows and ids share one fate; null and empty texts
    get the score of no evidence. A score of exactly 0.3 stays.
    """
    score = quality.scorer(spark, quality.fit(docs, table(spark, sf_dir, "labels")))
    return docs.where(score("text") >= quality.THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; what has no words left because of that goes.

    Null, empty and blank texts stay as they are, as do rows with a null doc_id; of rows that repeat a
    doc_id the one with the smallest text stays.
    """
    return lines.cleaned(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity of 0.8 or more on five words), that of the smallest doc_id.

    Texts without words and rows with a null doc_id are nobody's duplicates; rows that repeat a doc_id
    count once.
    """
    return minhash.deduplicate(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; null and empty texts stay, and each row is judged for itself."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row an occurrence, with its position.

    Texts without words aren't taken; null sources are a source of their own, and rows with a null
    doc_id each count for themselves. Ties in position go by doc_id.
    """
    return mixing.curriculum(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("source_mixing", mixing_stage),
]

#: Compression, SimHash and MinHash have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's output is a table before the next reads it.

    With it, the tables that a stage worked on and the one it read are deleted.
    """
    docs = table(spark, sf_dir, "documents")
    mark = written()
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
        drop_written(spark, mark, keep=1)
    return docs
