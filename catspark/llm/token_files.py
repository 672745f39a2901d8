"""Token-ID output (operator 4): token ids in ORC files, in ascending document order.

Spark's ORC writer stores the id lists as integer run-length encoded streams,
keeps a row index with minimum and maximum for every group of rows and a Bloom
filter on the document id.  Readers split the files by stripes; a filter on
``doc_id`` prunes files, stripes and row groups by metadata.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import parts_for, ship
from .tokens import encoder, forget, text_batches

ROW = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 1, text_bytes_per_file: int = 48 << 20,
                 stripe_bytes: int = 16 << 20, index_rows: int = 1000,
                 bloom_fpp: float = 0.01) -> str:
    """Write the ids of every document of ``df`` (plus ``end_id``) as ORC files under ``path``.

    Files are range-partitioned and sorted by document id, nulls first; rows
    with equal ids follow in the order of their texts.  Null or empty text:
    the end id alone.  Empty table: a folder without rows.  Other columns are
    ignored.  ``local_start`` counts a file's ids before the document;
    ``with_starts`` adds what the files before it hold.
    """
    ship(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    dealt = docs.repartitionByRange(parts_for(total, text_bytes_per_file), "doc_id") \
        .sortWithinPartitions("doc_id", "text")

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part, start = TaskContext.get().partitionId(), 0
        codes = encoder(tokenizer_path)
        for ids, texts in text_batches(batches):
            data = codes.encode(texts, end_id)
            counts = np.array([len(x) // 4 for x in data], np.int64)
            starts = start + np.concatenate([[0], np.cumsum(counts)])
            start = int(starts[-1])
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(data), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.full(len(ids), part, np.int32)),
                 pa.array(starts[:-1]), pa.array(counts), lists],
                ["doc_id", "part", "local_start", "n_tokens", "ids"])

    (dealt.mapInArrow(encode, ROW).write.format("orc")
     .option("orc.compress", "ZSTD").option("orc.stripe.size", stripe_bytes)
     .option("orc.create.index", "true").option("orc.row.index.stride", index_rows)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom_fpp)
     .save(path))
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; filters on doc_id are pushed down to the ORC metadata."""
    return spark.read.schema(ROW).orc(path)


def with_starts(rows: DataFrame, written: DataFrame) -> DataFrame:
    """``rows`` (with part and local_start) and ``start``: the ids of all documents before each."""
    # one row per file, so small at any size: its share of a prefix sum over the files
    counts = written.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("before"))
    return (rows.join(F.broadcast(before), "part")
            .withColumn("start", F.col("before") + F.col("local_start"))
            .drop("before", "local_start", "part"))


def ids_crc32(batches):
    """The rows with a checksum of the ids, as little-endian unsigned 32-bit, in their place."""
    import numpy as np
    import pyarrow as pa
    forget()
    for b in batches:
        lists = b.column("ids")
        ids = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<i4")
        view = memoryview(ids).cast("B")
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        starts = [0, *ends[:-1]]
        sums = [zlib.crc32(view[4 * i:4 * j]) for i, j in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(sums, pa.int64())],
                                         [*b.schema.names[:4], "ids_crc32"])


def token_digest(spark: SparkSession, df: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``df``'s tokens to the shared folder, read them back, one checksum per document."""
    rows = read_tokens(spark, write_tokens(df, scratch_path(spark, "tokens"), tokenizer_path))
    sums = rows.mapInArrow(ids_crc32, ROW.replace("ids array<int>", "ids_crc32 long"))
    return with_starts(sums, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
