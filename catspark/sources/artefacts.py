"""Save and load artefacts (documents, index, centroids, clusters,
sweep); load falls back to building when absent.

Every save writes a folder of its own and adds a line to ``saves`` at the very
end: the number of the save, where its rows are and how they are laid out.  The
line with the highest number is the artefact.  A save that fails leaves no
line, so readers go on with the one before it, or build where there is none.

Rows may be bucketed and sorted by a key (``word``, ``title``).  A loaded artefact
knows its buckets, so a join or an aggregate on that key moves only the other
side's rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LINE = "number long, rows string, n long, schema string, bucket_by array<string>, buckets int"


def _saves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINE).parquet(f"{path}/saves")


def _latest(spark: SparkSession, path: str):
    """The line of the last finished save, or None."""
    try:
        return _saves(spark, path).orderBy(F.col("number").desc(), "rows").first()
    except AnalysisException:  # no such folder: nothing was ever saved
        return None


def save_artefact(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  bucket_by: list[str] | None = None, buckets: int | None = None) -> str:
    """Write ``df`` as a new version of the artefact at ``path``.

    ``partition_by``: folders, for keys of few values.  ``bucket_by``: files by
    hash of these columns, sorted by them; ``buckets`` is the number of shuffle
    partitions unless given.
    """
    spark = df.sparkSession
    rows = f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # one task per bucket, so that a bucket is one file
        dealt = df.repartition(buckets, *bucket_by)
        table = f"catspark_save_{uuid.uuid4().hex}"
        (dealt.write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).format("parquet")
         .option("path", rows).saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")  # the files stay
    else:
        writer.parquet(rows)
    last = _latest(spark, path)
    line = (0 if last is None else last["number"] + 1, rows,
            spark.read.schema(df.schema).parquet(rows).count(), df.schema.json(),
            bucket_by, buckets if bucket_by else None)
    spark.createDataFrame([line], LINE).coalesce(1).write.mode("append").parquet(f"{path}/saves")
    return path


def is_saved(spark: SparkSession, path: str) -> bool:
    """Whether a version of the artefact was written to its end."""
    return _latest(spark, path) is not None


def _column(field) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def load_artefact(spark: SparkSession, path: str, build: Callable[[], DataFrame] | None = None,
                  **layout) -> DataFrame:
    """Read the last finished version; if there is none, build it, save it (with ``layout``
    as for ``save_artefact``) and read it."""
    last = _latest(spark, path)
    if last is None:
        if build is None:
            raise FileNotFoundError(path)
        save_artefact(build(), path, **layout)
        last = _latest(spark, path)
    schema = StructType.fromJson(json.loads(last["schema"]))
    if not last["bucket_by"]:
        return spark.read.schema(schema).parquet(last["rows"])
    # the catalogue entry tells the planner about the buckets
    table = "catspark_" + last["rows"].rstrip("/").rsplit("-", 1)[1]
    keys = ", ".join(f"`{c}`" for c in last["bucket_by"])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(map(_column, schema))}) "
              f"USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {last['buckets']} BUCKETS LOCATION '{last['rows']}'")
    return spark.table(table)
