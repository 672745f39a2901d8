"""A directory of text, read line-wise with a document key per line (the
map-reduce input of the reference).

Two layouts: one folder per document, and containers that hold many documents
each.  A container is a text file of records: a separator, the document's
key, a line end, the text.  Spark splits containers at the separators, so
neither the number of files nor the largest file limits the reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text_dir(texts: DataFrame, path: str, key: str = "title") -> str:
    """One folder per document key (``key=<value>/part-*.txt``)."""
    texts.select(key, "text").write.mode("overwrite").partitionBy(key).text(path)
    return path


def read_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) for every line of every file under ``path``."""
    return (spark.read.option("recursiveFileLookup", "true").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")))


def _percent_decoded(name: Column) -> Column:
    # "+" is a plain character in paths
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def file_key(file_col, key: str = "title") -> Column:
    """The document key encoded in a path written by ``write_text_dir``.

    The path is a URI whose folder name is itself percent-encoded.
    """
    folder = F.regexp_extract(file_col, f"/{key}=([^/]+)/", 1)
    name = _percent_decoded(_percent_decoded(folder))
    return F.when(name != "__HIVE_DEFAULT_PARTITION__", name)


def read_documents(spark: SparkSession, path: str, key: str = "title") -> DataFrame:
    """(file, line) with ``file`` = the document key, whatever number of files it has."""
    lines = read_text_dir(spark, path)
    return lines.select(file_key(F.col("file"), key).alias("file"), "line")


# ---------------------------------------------------------------------------
# Containers: many documents a file
# ---------------------------------------------------------------------------

RECORD, ESCAPE = "\x1e", "\x10"  # record separator; data link escape
NO_KEY = "-"                     # a key is written behind a "+"


def _escaped(c: Column) -> Column:
    c = F.replace(c, F.lit(ESCAPE), F.lit(ESCAPE + "p"))
    return F.replace(c, F.lit(RECORD), F.lit(ESCAPE + "e"))


def _unescaped(c: Column) -> Column:
    c = F.replace(c, F.lit(ESCAPE + "e"), F.lit(RECORD))
    return F.replace(c, F.lit(ESCAPE + "p"), F.lit(ESCAPE))


def write_containers(texts: DataFrame, path: str, key: str = "title",
                     files: int | None = None) -> str:
    """Write (key, text) rows as containers: one file per task, or ``files`` in all.

    A null text has no lines (an empty one has an empty line).  Line ends of a
    key are escaped.
    """
    name = F.coalesce(F.concat(F.lit("+"), F.url_encode(F.col(key).cast("string"))), F.lit(NO_KEY))
    body = F.coalesce(F.concat(F.lit("\n"), _escaped(F.col("text"))), F.lit(""))
    rows = texts.select(F.concat(name, body).alias("value"))
    rows = rows if files is None else rows.repartition(files)
    rows.write.mode("overwrite").option("lineSep", RECORD).text(path)
    return path


def _record_lines(records: DataFrame) -> DataFrame:
    name = F.substring_index("value", "\n", 1)
    key = F.when(F.startswith(name, F.lit("+")), F.url_decode(F.substring(name, 2, 1 << 30)))
    cut = F.instr("value", "\n")  # 0: no text
    body = F.when(cut > 0, _unescaped(F.substring(F.col("value"), cut + 1, F.length("value"))))
    return records.select(key.alias("file"), F.explode(F.split(body, "\n", -1)).alias("line"))


def read_containers(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) with ``file`` = the document key, for every line of every document."""
    return _record_lines(spark.read.option("lineSep", RECORD).text(path))


def stream_containers(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The same rows as a stream of containers."""
    return _record_lines(spark.readStream.format("text").option("lineSep", RECORD)
                         .option("maxFilesPerTrigger", files_per_batch).load(path))
