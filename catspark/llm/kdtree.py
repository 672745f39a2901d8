"""Sharding (operator 10): k-d tree partitioning at weighted medians.

A point is a group of rows with equal texts, so copies always share a shard;
its weight is the group's bytes.  A node with more than one shard to make is
split along the dimension in which its points spread widest (relative to the
whole table's spread), at the value that gives each side its share of the
bytes.  Points with the same value are told apart by the hash of their text,
so any share can be met to within one group.

The split value is found by narrowing: bytes per bin of the current interval
are summed over the cluster (a few thousand rows per node), the bin that holds
the wanted share becomes the next interval.  All nodes of a level are split in
the same jobs; a level costs a handful of small aggregates over the points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import parts_for

#: bins per narrowing step, and hash bits that tell equal values apart
BINS, HASH_BITS = 4096, 24


def group_key(text_col: str) -> Column:
    """Equal texts have equal keys; null counts as empty."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def points(df: DataFrame, text_col: str, dims: dict[str, Column]) -> DataFrame:
    """(key, weight, rows, dims...): one row per distinct text; dims are each group's smallest."""
    aggs = [F.min(c).cast("long").alias(f"d_{name}") for name, c in dims.items()]
    return (df.groupBy(group_key(text_col).alias("key"))
            .agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1)
                 .alias("weight"), F.count(F.lit(1)).alias("rows"), *aggs))


def kd_shards(df: DataFrame, text_col: str, dims: dict[str, Column], shards: int | None = None,
              target_bytes: int | None = None) -> DataFrame:
    """(key, weight, rows, shard): the leaf of each group of equal texts; see ``group_key``.

    ``dims`` are integer columns (nulls count as 0).  Give the number of
    ``shards`` or the ``target_bytes`` of a leaf.  Leaves have near-equal bytes
    as far as groups allow: a group larger than a leaf keeps to one leaf.  Null
    and empty texts are one group.  Empty table: no rows.
    """
    names = list(dims)
    tie = F.conv(F.substring("key", 1, HASH_BITS // 4), 16, 10).cast("long")
    pts = materialise(points(df, text_col, dims)
                      .fillna(0, [f"d_{n}" for n in names])
                      .withColumn("tie", tie), "points")
    total = pts.agg(F.sum("weight")).first()[0]
    k = shards or parts_for(total, target_bytes)
    spread = pts.agg(*[F.greatest(F.lit(1), F.max(f"d_{n}") - F.min(f"d_{n}")).alias(n)
                       for n in names]).first().asDict()
    pts = pts.withColumn("node", F.lit(0).cast("long")).withColumn("leaves", F.lit(k))
    while k > 1:
        pts = materialise(_split_level(pts, names, spread), "level")
        k = (k + 1) // 2
    return pts.select("key", "weight", "rows", F.col("node").cast("int").alias("shard"))


def _split_level(pts: DataFrame, names: list[str], spread: dict) -> DataFrame:
    """Children of every node with more than one leaf to make; the rest stays as it is."""
    width = [((F.max(f"d_{n}") - F.min(f"d_{n}")) / F.lit(float(spread[n] or 1))).alias(f"w_{n}")
             for n in names]
    stats = (pts.where("leaves > 1").groupBy("node", "leaves")
             .agg(F.sum("weight").alias("all"), *width))
    widest = F.greatest(*[f"w_{n}" for n in names]) if len(names) > 1 else F.col(f"w_{names[0]}")
    axis = F.coalesce(*[F.when(F.col(f"w_{n}") == widest, F.lit(n)) for n in names])
    stats = stats.select("node", axis.alias("axis"),
                         F.floor(F.col("all") * F.floor(F.col("leaves") / 2) / F.col("leaves"))
                         .alias("want"))
    stats = materialise(stats, "axes")
    value = F.coalesce(*[F.when(F.col("axis") == n, F.col(f"d_{n}")) for n in names])
    # a point's place along its node's axis: value first, then the text's hash
    placed = materialise(pts.join(stats, "node", "left").withColumn("value", value), "placed")
    cut_value = _weighted_cut(placed.where("axis is not null"), "value", stats)
    tied = placed.join(cut_value, "node").where(F.col("value") == F.col("cut"))
    cut_tie = _weighted_cut(tied.drop("cut", "left"), "tie",
                            cut_value.select("node", F.col("left").alias("want")))
    cuts = materialise(cut_value.select("node", "cut").join(
        cut_tie.select("node", F.col("cut").alias("tie_cut")), "node", "left"), "cuts")
    right = ((F.col("value") > F.col("cut"))
             | ((F.col("value") == F.col("cut")) & (F.col("tie") >= F.col("tie_cut"))))
    half = F.floor(F.col("leaves") / 2).cast("int")
    moved = placed.join(cuts, "node", "left").withColumn("_r", F.coalesce(right, F.lit(False)))
    split = F.col("axis").isNotNull()
    # nodes are numbered by their first leaf, so that leaves come out as 0 .. k-1
    return moved.select(
        "key", "weight", "rows", "tie", *[f"d_{n}" for n in names],
        F.when(split & F.col("_r"), F.col("node") + half).otherwise(F.col("node")).alias("node"),
        F.when(~split, F.col("leaves")).when(F.col("_r"), F.col("leaves") - half)
        .otherwise(half).alias("leaves"))


def _weighted_cut(pts: DataFrame, col: str, wanted: DataFrame) -> DataFrame:
    """(node, cut, left): the value at which the weight below reaches ``want``.

    ``left`` is what is still wanted from the points that have the value itself.
    """
    bounds = materialise(
        pts.groupBy("node").agg(F.min(col).alias("lo"), (F.max(col) + 1).alias("hi"))
        .join(wanted.select("node", F.col("want").cast("long").alias("left")), "node"), "bounds")
    pts = pts.select("node", "weight", F.col(col).alias("v"))
    while bounds.where("hi - lo > 1").limit(1).count():
        step = F.ceil((F.col("hi") - F.col("lo")) / F.lit(BINS)).cast("long")
        open_ = bounds.withColumn("step", step)
        bins = (pts.join(open_, "node").where("v >= lo and v < hi")
                .groupBy("node", "lo", "hi", "left", "step",
                         F.floor((F.col("v") - F.col("lo")) / F.col("step")).cast("long").alias("b"))
                .agg(F.sum("weight").alias("w")))
        # at most BINS rows per node
        order = Window.partitionBy("node").orderBy("b")
        runs = bins.withColumn("upto", F.sum("w").over(order)).withColumn(
            "last", F.lead("b").over(order).isNull())
        hit = runs.where((F.col("upto") >= F.col("left")) | F.col("last"))
        first = hit.groupBy("node").agg(F.min_by(F.struct("lo", "hi", "left", "step", "b", "w",
                                                          "upto"), "b").alias("s"))
        lo = F.col("s.lo") + F.col("s.b") * F.col("s.step")
        bounds = materialise(first.select(
            "node", lo.alias("lo"), F.least("s.hi", lo + F.col("s.step")).alias("hi"),
            (F.col("s.left") - (F.col("s.upto") - F.col("s.w"))).alias("left")), "bounds")
    return bounds.select("node", F.col("lo").alias("cut"), "left")


def number_rows(df: DataFrame, group: str, order: list[str], n: int, out: str,
                per_bucket: int = 20_000) -> DataFrame:
    """``out`` = gapless position from 0 within ``group``, without one task per group.

    Rows are dealt to hash buckets of about ``per_bucket`` rows; counts of the
    buckets give each its first number.
    """
    buckets = parts_for(n, per_bucket)
    rows = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = rows.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select(group, "_b", (F.sum("_n").over(
        Window.partitionBy(group).orderBy("_b")) - F.col("_n")).alias("_first"))
    inside = F.row_number().over(Window.partitionBy(group, "_b").orderBy(*order))
    return (rows.withColumn("_i", inside).join(first, [group, "_b"])
            .withColumn(out, F.col("_first") + F.col("_i") - 1).drop("_b", "_i", "_first"))
