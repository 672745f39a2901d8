"""Distributed ranking helpers.

``global_rank`` numbers rows 1..N in a total order without moving all rows
into one task: a range-partitioned sort written once with each row's partition
and position, and a prefix sum over the (few) partition counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_LOW_BITS = (1 << 33) - 1


def global_rank(df: DataFrame, order_cols: list, out: str = "rank") -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order_cols`` order.

    ``order_cols`` must be a total order (add a unique tie-break).  The sorted
    rows are written with their positions before anything is counted: range
    bounds are sampled, so two runs of the same sort may cut it differently.
    """
    ordered = materialise(
        df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id()), "rank")
    part = F.shiftright("_mid", 33)
    # one row per partition: bounded by the partition count, not the data
    counts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (ordered.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(out, F.col("_before") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1)
            .drop("_mid", "_part", "_before"))
