"""Shared pieces: bounded Arrow batches, tables that cut lineage, label folds."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows a Python worker receives at once. Texts may be long, so a batch stays small.
BATCH_ROWS = 256


#: The folder of a local session without that setting, once there is one.
_own: str | None = None


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as ``spark.checkpoint.dir`` names it.

    Only a local session may go without that setting; it then gets a temporary folder of its own.
    """
    global _own
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own = _own or "file://" + tempfile.mkdtemp(prefix="spark-tidewater-", dir="/tmp")
    return f"{root}/tidewater-{spark.sparkContext.applicationId}"


class _Written(threading.local):
    """Folders of the tables that ``cut`` has written in this thread and nobody has dropped yet, in order."""

    def __init__(self):
        self.paths: list[str] = []


_here = _Written()


def _store(spark: SparkSession, path: str):
    """A folder and the file system that it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: Spark's setting that deletes a query's shuffle files as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    What follows depends on that table alone: a lost executor costs a file read, not the whole
    history, and Spark knows the table's true size when it plans joins. The shuffles that made it go as it
    is written; Spark would keep them until the driver happens to collect its garbage. Tables that nobody
    drops before are deleted as the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    _here.paths.append(path)
    folder, store = _store(spark, scratch(spark))
    store.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark for ``drop_written``: how many tables this thread has now; queries in other threads keep theirs."""
    return len(_here.paths)


def drop_written(spark: SparkSession, begin: int, keep: int = 0) -> None:
    """Delete the tables that this thread has written since its mark ``begin``, but for the last ``keep``; no frame in use may read them."""
    paths = _here.paths
    end = max(begin, len(paths) - keep)
    for path in paths[begin:end]:
        at, store = _store(spark, path)
        store.delete(at, True)
    del paths[begin:end]


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts may be long: Arrow batches of this session hold ``BATCH_ROWS`` rows from now on, as Spark reads the setting when a query runs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_batches(df: DataFrame, columns: list[str], schema: str, start: Callable[[], Callable]) -> DataFrame:
    """Run Python over small Arrow batches of ``columns``.

    ``start()`` runs once a task and returns a function from the columns' Python lists to a list of
    output arrays in the order of ``schema``; only the named columns travel.
    """
    spark = df.sparkSession
    small_batches(spark)
    fields = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                out = step(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, target, strict=True)], schema=target
                )

    return df.select(*columns).mapInArrow(run, fields)


def _repeated(docs: DataFrame) -> bool:
    known = docs.where(F.col("doc_id").isNotNull())
    return not known.groupBy("doc_id").count().where("count > 1").isEmpty()


def one_per_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with each doc_id once: of rows that repeat one, the smallest text. Rows with a null doc_id all stay."""
    docs = docs.select("doc_id", "text")
    if not _repeated(docs):
        return docs
    known = docs.where(F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.min("text").alias("text")).union(docs.where(F.col("doc_id").isNull()))


def first_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with one row a doc_id, that of the smallest text, and all rows with a null doc_id."""
    if not _repeated(docs):
        return docs
    known = docs.where(F.col("doc_id").isNotNull())
    # A null text counts as larger than any, as it does in min().
    order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    return known.withColumn("_tidewater_n", F.row_number().over(order)).where("_tidewater_n = 1").drop("_tidewater_n").union(docs.where(F.col("doc_id").isNull()))


#: Bounds of the sample that the compression dictionary is built from.
DICTIONARY_DOCS, DICTIONARY_CHARS, DICTIONARY_BYTES = 1000, 1024, 65_536


def sampled_texts(docs: DataFrame, number: int, chars: int) -> list[str]:
    """The beginnings of about ``number`` texts (all, if they are fewer), drawn at random in the tasks, so that no more than these travel."""
    share = number / max(1, docs.count())
    drawn = docs.where((F.length("text") > 0) & (F.rand(20240229) < share)).select(F.substring("text", 1, chars).alias("t"))
    return [r.t for r in drawn.collect()]


def text_dictionary(docs: DataFrame) -> bytes:
    """A zstandard dictionary for these texts, empty if there is too little; it changes sizes, not results.

    It is built from a random sample: of some ``DICTIONARY_DOCS`` texts, whatever the size of the
    corpus, the first ``DICTIONARY_CHARS`` characters come to the driver.
    """
    sample = [t.encode("utf-8", "surrogatepass") for t in sampled_texts(docs, DICTIONARY_DOCS, DICTIONARY_CHARS)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes() if len(sample) > 20 else b""
    except zstandard.ZstdError:
        return b""


def zipper(dictionary: bytes) -> tuple[Callable[[bytes], bytes], Callable[[bytes | None], bytes]]:
    """Functions that compress bytes and bring them back; nothing comes back as nothing."""
    options: dict = {"level": 3}
    more: dict = {}
    if dictionary:
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=3)
        options = {"level": 3, "dict_data": data}
        more = {"dict_data": data}
    packer = zstandard.ZstdCompressor(write_checksum=False, write_dict_id=False, **options)
    opener = zstandard.ZstdDecompressor(**more)
    return packer.compress, lambda z: b"" if z is None else opener.decompress(z)


def zipped(docs: DataFrame, dictionary: bytes) -> DataFrame:
    """(doc_id, z): texts compressed, to travel and to wait on disk at less than half the size."""

    def start():
        pack = zipper(dictionary)[0]
        return lambda ids, texts: (ids, [None if t is None else pack(t.encode("utf-8", "surrogatepass")) for t in texts])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, z binary", start)
