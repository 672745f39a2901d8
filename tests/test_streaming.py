import os

import pytest
from pyspark.sql import functions as F

from catspark.operators import index as I
from catspark.sources import artefacts as A
from catspark.sources import textdir as TD
from catspark.sources.tables import texts
from catspark.streaming.textdir import batch_counts, count_batches
from conftest import SF0001


def test_batches_of_files_counted_once(spark, tmp_dir):
    src = TD.write_text_dir(texts(spark, SF0001), os.path.join(tmp_dir, "in"))
    out = os.path.join(tmp_dir, "out")
    count_batches(spark, src, out, os.path.join(tmp_dir, "ckpt"), files_per_batch=50)
    batches = spark.read.parquet(out)
    assert batches.select("batch").distinct().count() == 4  # 200 files / 50
    got = batch_counts(spark, out).select(F.col("file").alias("title"), "word", "n")
    want = I.term_counts(texts(spark, SF0001)).select("title", "word", "n")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a restart finds nothing new: every file is counted exactly once
    count_batches(spark, src, out, os.path.join(tmp_dir, "ckpt"), files_per_batch=50)
    assert spark.read.parquet(out).count() == batches.count()


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_dir):
    src = TD.write_text_dir(texts(spark, SF0001).limit(20), os.path.join(tmp_dir, "in"))
    out = os.path.join(tmp_dir, "out")
    count_batches(spark, src, out, os.path.join(tmp_dir, "ckpt"))
    before = spark.read.parquet(out).count()
    # the state after a crash between a batch's write and its commit: no checkpoint of it
    count_batches(spark, src, out, os.path.join(tmp_dir, "ckpt2"))
    assert spark.read.parquet(out).count() == before


NAMES = ["A/B: c%d é", "x+y", "100%", "a=b?c#d", "日本 語", "plain"]


def test_document_keys_are_decoded(spark, tmp_dir):
    rows = [(t, f"line {i}\nwords of {i}") for i, t in enumerate(NAMES)]
    df = spark.createDataFrame(rows, "title string, text string")
    path = TD.write_text_dir(df, os.path.join(tmp_dir, "in"))
    got = TD.read_documents(spark, path).collect()
    assert {r["file"] for r in got} == set(NAMES) and len(got) == 2 * len(NAMES)


def test_a_document_of_several_files_is_counted_as_one(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    for part in ("cats sleep", "cats run"):
        spark.createDataFrame([("t/1", part)], "title string, text string").write.mode(
            "append").partitionBy("title").text(path)
    counts = I.file_word_count(TD.read_documents(spark, path))
    assert {(r["word"], r["file"], r["n"]) for r in counts.collect()} == {
        ("cat", "t/1", 2), ("sleep", "t/1", 1), ("run", "t/1", 1)}


def failing(spark, n=5):
    """Rows whose last one cannot be computed."""
    broken = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(n).repartition(3).select(broken.cast("long").alias("id"))


def test_an_unfinished_artefact_counts_as_absent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a")
    with pytest.raises(FileNotFoundError):
        A.load_artefact(spark, path)
    with pytest.raises(Exception, match="lost"):
        A.save_artefact(failing(spark), path)
    assert not A.is_saved(spark, path)
    assert A.load_artefact(spark, path, lambda: spark.range(5)).count() == 5
    assert A.load_artefact(spark, path, lambda: spark.range(9)).count() == 5


@pytest.mark.parametrize("layout", [{}, {"bucket_by": ["id"], "buckets": 4}])
def test_a_failed_second_save_leaves_the_first(spark, tmp_dir, layout):
    path = os.path.join(tmp_dir, "a")
    A.save_artefact(spark.range(7), path, **layout)
    first = A.load_artefact(spark, path)
    with pytest.raises(Exception, match="lost"):
        A.save_artefact(failing(spark), path, **layout)
    assert A.load_artefact(spark, path, lambda: spark.range(1)).count() == 7
    A.save_artefact(spark.range(3), path, **layout)
    assert A.load_artefact(spark, path).count() == 3
    assert first.count() == 7  # a reader of the first version goes on


def test_a_bucketed_artefact_joins_without_moving(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a")
    vec = spark.range(5000).select((F.col("id") % 700).cast("string").alias("title"),
                                   F.col("id").cast("string").alias("word"),
                                   F.lit(1.0).alias("weight"))
    A.save_artefact(vec, path, bucket_by=["title"])
    saved = A.load_artefact(spark, path)
    asked = spark.range(300).select(F.col("id").cast("string").alias("title"))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = saved.join(asked, "title")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == vec.join(asked, "title").count()
        summed = saved.groupBy("title").agg(F.sum("weight"))
        alone = summed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert plan.count("Exchange hashpartitioning") == 1  # the asked titles
    assert "Exchange" not in alone
    assert saved.schema == vec.schema or [f.name for f in saved.schema] == ["title", "word", "weight"]


def test_containers_hold_many_documents(spark, tmp_dir):
    rows = [(t, f"line {i}\r\nwords\x1e of\x10e {i}\n") for i, t in enumerate(NAMES)]
    rows += [("null", None), ("empty", ""), (None, "no key"), ("two\nlines", "a\n\nb"), ("-", "dash")]
    rows += [(f"doc{i}", "word " * (i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "title string, text string")
    path = TD.write_containers(df, os.path.join(tmp_dir, "in"), files=2)
    assert sum(f.startswith("part-") for f in os.listdir(path)) == 2
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = TD.read_containers(spark, path)
        assert lines.rdd.getNumPartitions() > 4  # a container is cut at its records
        got = sorted((r["file"] or "", r["line"]) for r in lines.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((t or "", x) for t, text in rows if text is not None for x in text.split("\n"))
    out = os.path.join(tmp_dir, "out")
    count_batches(spark, path, out, os.path.join(tmp_dir, "ckpt"), files_per_batch=1, containers=True)
    assert spark.read.parquet(out).select("batch").distinct().count() == 2
    n = {r["file"]: r["n"] for r in batch_counts(spark, out).where("word = 'word'").collect()}
    assert n["doc6"] == 6 and n["doc13"] == 6 and "doc7" not in n


def test_counts_of_a_stream_move_only_split_documents(spark, tmp_dir):
    """A document in one file is counted where it is read; one that a later file goes on with is added up."""
    path, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    whole = spark.createDataFrame([(f"doc{i}", "cats\ncat dog") for i in range(30)], "title string, text string")
    TD.write_containers(whole, path, files=2)
    count_batches(spark, path, out, os.path.join(tmp_dir, "ckpt"), files_per_batch=1, containers=True)
    plan = batch_counts(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    more = TD.write_containers(spark.createDataFrame([("doc3", "dogs"), (None, "sky")], "title string, text string"),
                               os.path.join(tmp_dir, "more"), files=1)
    for f in os.listdir(more):
        if f.startswith("part-"):
            os.link(os.path.join(more, f), os.path.join(path, f))
    count_batches(spark, path, out, os.path.join(tmp_dir, "ckpt"), files_per_batch=1, containers=True)
    got = {(r.file, r.word): r.n for r in batch_counts(spark, out).collect()}
    want = {(f"doc{i}", w): n for i in range(30) for w, n in (("cat", 2), ("dog", 1))}
    assert got == want | {("doc3", "dog"): 2, (None, "sky"): 1}
