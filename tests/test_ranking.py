from pyspark.sql import functions as F

from catspark.operators.components import connected_components
from catspark.plans.ranking import global_rank


def _distinct_ranks(df, n):
    row = df.agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()
    assert tuple(row) == (n, n, 1, n)


def test_global_rank_is_exact(spark):
    df = spark.range(60).select((F.col("id") * 7919 % 61).alias("k")).repartition(7)
    got = [r["k"] for r in global_rank(df, ["k"]).orderBy("rank").collect()]
    assert got == sorted(got) and len(got) == 60


def test_global_rank_with_payload_and_union_at_a_million_rows(spark):
    n = 1_000_000
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"),
                               F.repeat(F.lit("p"), 40).alias("payload"))
    ranked = global_rank(df, ["k"])
    _distinct_ranks(ranked, n)
    other = global_rank(df.select("k", F.upper("payload").alias("payload")), ["k"])
    both = ranked.withColumn("s", F.lit(0)).union(other.withColumn("s", F.lit(1)))
    for s in (0, 1):
        _distinct_ranks(both.where(F.col("s") == s), n)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = spark.range(150).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(1000, 1400).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    loop = spark.createDataFrame([(5000, 5000)], "a long, b long")
    got = connected_components(chain.union(hub).union(loop).orderBy(F.rand(3)))
    rows = {r["node"]: r["component"] for r in got.collect()}
    assert len(rows) == 151 + 401 + 1
    assert {rows[i] for i in range(151)} == {0}
    assert {rows[i] for i in range(999, 1400)} == {999}
    assert rows[5000] == 5000


def test_components_of_no_edges(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty).count() == 0
