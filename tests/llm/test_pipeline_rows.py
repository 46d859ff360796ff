"""The pipeline's stages row by row on planted documents, and tables of two queries at once."""

from __future__ import annotations

import random
import threading

import corpus_pipeline
from tidewater.llm.common import cut, drop_written, fold, written
from tidewater.llm.queries import op1_quality, op7_language

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def words(seed, n):
    """Words of letters, as the line stage takes all digits for one."""
    r = random.Random(seed)
    return ["".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(n)]


def text(seed, n=80):
    return " ".join(words(seed, n))


def documents(spark, texts, sources=3):
    return spark.createDataFrame([(k, t, "en", f"s{k % sources}", None if t is None else len(t)) for k, t in texts.items()], SCHEMA)


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def changed(seed, n, at):
    w = words(seed, n)
    w[at] = "another"
    return " ".join(w)


ITEM = text(900, 30)
LINE = text(901, 20)
#: By doc_id: clean texts, then what some stage has to take out.
CLEAN = {k: text(k) for k in range(20)} | {20: None, 21: ""}
JUNK = {k: " ".join(f"{w}$$$" for w in words(k, 80)) for k in range(30, 40)}
REPEATED = {50: f"{LINE}\n{text(50)}", 51: f"{text(51)}\n{changed(901, 20, 9)}", 52: f"{text(52)}\n{LINE}\n{text(53)}"}
NEAR = {60: text(60, 300), 61: changed(60, 300, 150), 62: changed(60, 300, 20), 63: text(60, 300)}
LEAKED = {70: f"{text(70)} {ITEM} {text(71)}", 71: f"{text(72)} {' '.join(words(900, 30)[5:15]).upper()}."}


def write_tables(spark, root):
    labels = [(k, 1, 0) for k in CLEAN if k < 20] + [(k, 0, 0) for k in JUNK]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")


def test_each_stage_keeps_and_removes_the_right_rows(spark, tmp_path):
    root, stages = str(tmp_path), dict(corpus_pipeline.STAGES)
    write_tables(spark, root)
    kept = rows(stages["quality_classifier"](spark, documents(spark, CLEAN | JUNK), root))
    assert set(kept) >= set(range(20)) and not set(kept) & set(JUNK) and all(CLEAN[k] == t for k, t in kept.items())

    left = rows(stages["line_dedup"](spark, documents(spark, CLEAN | REPEATED), root))
    assert left == CLEAN | {50: REPEATED[50], 51: text(51), 52: f"{text(52)}\n{text(53)}"}

    assert rows(stages["minhash_near_dedup"](spark, documents(spark, CLEAN | NEAR), root)) == CLEAN | {60: NEAR[60]}
    assert rows(stages["benchmark_decontamination"](spark, documents(spark, CLEAN | LEAKED), root)) == CLEAN

    mixed = stages["source_mixing"](spark, documents(spark, CLEAN), root).collect()
    taken = {k: sum(r.doc_id == k for r in mixed) for k in CLEAN}
    assert all(1 <= taken[k] <= 2 for k in range(20)) and taken[20] == taken[21] == 0
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)


def test_the_whole_pipeline_on_planted_rows(spark, tmp_path):
    root = str(tmp_path)
    write_tables(spark, root)
    # One source is mixed to 150 % of its size, so nothing that came so far is left out.
    documents(spark, CLEAN | JUNK | REPEATED | NEAR | LEAKED, 1).write.parquet(f"{root}/documents.parquet")
    out = rows(corpus_pipeline.run(spark, root))
    assert set(out) == set(range(20)) | {50, 51, 52, 60}
    assert out[51] == text(51) and out[60] == NEAR[60]


def test_tables_of_two_threads_are_their_own(spark):
    first, other = written(), []
    mine = cut(spark.range(10))

    def query():
        begin = written()
        cut(spark.range(5))
        other.append(written() - begin)
        drop_written(spark, begin)
        other.append(written() - begin)

    thread = threading.Thread(target=query)
    thread.start()
    thread.join()
    assert other == [1, 0] and written() == first + 1 and mine.count() == 10
    drop_written(spark, first)


def test_rows_without_id_are_not_held_out(spark, tmp_path):
    root = str(tmp_path)
    write_tables(spark, root)
    docs = documents(spark, CLEAN | JUNK).union(spark.createDataFrame([(None, text(99), "en", "s", 1)], SCHEMA))
    docs.write.parquet(f"{root}/documents.parquet")
    for query, parts, rest in ((op1_quality, 5, 0), (op7_language, 4, 2)):
        got = query(spark, root)
        assert got.where("held_out IS NULL").count() == 0 and got.where("doc_id IS NULL AND NOT held_out").count() == 1
        assert got.where((fold("doc_id", parts) == rest) != got.held_out).count() == 0


def test_all_languages_are_learned(spark):
    from tidewater.llm import langid

    docs = spark.createDataFrame([(k, f"{text(k)} word", f"l{k}") for k in range(300)], "doc_id long, text string, lang string")
    assert len(langid.fit(docs)) == 300
