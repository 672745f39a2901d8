"""Incremental word counting over a growing directory of text files.

The reference buffers documents as files and counts them in batches of 500
files.  Here a file stream does the batching: ``maxFilesPerTrigger`` files per
micro-batch, each batch counted with the same tokeniser/stemmer plan.  A batch
overwrites a folder of its own number, so a batch that is run again after a
crash replaces its rows, and every file is counted once.

``store_batches`` feeds a ``DocumentStore`` instead, where a document that is sent
again replaces the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import add_up, file_word_count
from ..operators.store import DocumentStore
from ..sources.textdir import file_key, stream_containers


def _run(rows: DataFrame, each, checkpoint: str):
    query = (rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def count_batches(spark: SparkSession, text_dir: str, out_path: str, checkpoint: str,
                  files_per_batch: int = 500, stem: bool = True, containers: bool = False):
    """Start the stream (all files available now) and wait for it to finish.

    ``out_path`` receives one folder (word, file, n) per batch; ``file`` is the
    document key.  ``containers``: many documents per file, else a folder each.
    """
    if containers:
        lines = stream_containers(spark, text_dir, files_per_batch)
    else:
        lines = (spark.readStream.format("text")
                 .option("maxFilesPerTrigger", files_per_batch)
                 .option("recursiveFileLookup", "true")
                 .load(text_dir)
                 .select(file_key(F.col("_metadata.file_path")).alias("file"),
                         F.col("value").alias("line")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        file_word_count(batch, stem=stem).write.mode("overwrite").parquet(
            f"{out_path}/batch={batch_id}")

    return _run(lines, write_batch, checkpoint)


def store_batches(store: DocumentStore, source: str, checkpoint: str, files_per_batch: int = 500):
    """Feed the parquet files (title, text, seq) under ``source`` to ``store``, batch by batch.

    Within a batch the text with the highest ``seq`` wins, and later batches
    win over earlier ones.
    """
    rows = (store.spark.readStream.schema("title string, text string, seq long")
            .option("maxFilesPerTrigger", files_per_batch).parquet(source))

    def put(batch: DataFrame, batch_id: int) -> None:
        store.put(batch, batch_id, order="seq")

    return _run(rows, put, checkpoint)


def batch_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """(word, file, n): a document whose files fell into several batches is added up."""
    return add_up(spark.read.parquet(out_path), "file", ["batch"])
