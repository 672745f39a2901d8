"""Connected components of an edge table, in a logarithmic number of rounds.

Every node points to a smaller-or-equal node of its component.  A round hooks
a node and the node it points to onto the smallest grandparent among its
neighbours and then shortcuts each pointer; rounds go on until no pointer
moves, so there is no cap on the diameter.  The pointers are written to the
shared folder each round: plans stay small, a lost executor costs one round,
and joins read written tables on both sides, so that Spark can split the rows
of a hub node over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``; component = its smallest node.

    Self loops make a component of one node; rows with a null end are ignored.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    both = materialise(pairs.union(pairs.select("v", "u")).distinct(), "edges")
    parent = materialise(both.groupBy("u").agg(F.min("v").alias("m"))
                         .select("u", F.least("u", "m").alias("f")), "parents")
    while True:
        upper = parent.select(F.col("u").alias("f"), F.col("f").alias("gf"))
        grand = materialise(parent.select("u", "f").join(upper, "f"), "grandparents")
        near = (both.join(grand.select(F.col("u").alias("v"), "gf"), "v")
                .groupBy("u").agg(F.min("gf").alias("m")))
        # a node moves to the smallest it sees, and so does the node it points to
        moves = F.explode(F.array(
            F.struct("u", F.least("f", "gf", "m").alias("f"), F.col("f").alias("old")),
            F.struct(F.col("f").alias("u"), F.col("m").alias("f"),
                     F.lit(None).cast(grand.schema["f"].dataType).alias("old"))))
        parent = materialise(grand.join(near, "u").select(moves.alias("x")).select("x.*")
                             .groupBy("u").agg(F.min("f").alias("f"), F.max("old").alias("old")),
                             "parents")
        if parent.where(F.col("f") != F.col("old")).limit(1).count() == 0:
            return parent.select(F.col("u").alias("node"), F.col("f").alias("component"))
