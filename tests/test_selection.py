import random

import pytest
from pyspark.sql import functions as F

from catspark.operators import catalog as C
from catspark.operators import evaluate as E
from catspark.plans import selection as S


def rows_of(n=400, seed=3):
    r = random.Random(seed)
    names = ["", "a", "a\0", "a\0b", "a\x01", "ab", "é", "日本", "z" * 40, "z" * 40 + "!", None]
    return [(r.choice(names), r.choice([None, -(1 << 63), -7, 0, 5, (1 << 63) - 1, r.randrange(50)]))
            for _ in range(n)]


def sort_key(row):
    name, number = row
    return (name is not None, (name or "").encode(), number is not None, number or 0)


def test_key_sorts_like_the_columns(spark):
    df = spark.createDataFrame(rows_of(), "name string, number long")
    got = [tuple(r)[:2] for r in df.withColumn("k", S.order_key(df, ["name", "number"]))
           .orderBy("k").collect()]
    assert got == sorted(rows_of(), key=sort_key)


@pytest.mark.parametrize("offset,n", [(0, 1), (0, 400), (0, 1000), (5, 0), (17, 40), (390, 50),
                                      (399, 1), (400, 5), (120, None), (0, None), (1000, 3)])
def test_rows_between_equals_a_sorted_list(spark, offset, n):
    rows = rows_of()
    df = spark.createDataFrame(rows, "name string, number long").repartition(5)
    got = [tuple(r) for r in S.rows_between(df, ["name", "number"], offset, n).collect()]
    want = sorted(rows, key=sort_key)[offset:None if n is None else offset + n]
    assert sorted(got, key=sort_key) == want


def test_pages_of_a_table_with_equal_rows_cover_it_once(spark):
    df = spark.createDataFrame([("x", 1)] * 30 + [("y", 1)] * 12, "name string, number long")
    n = [C.page_of(df, ["name", "number"], 10, k).count() for k in range(0, 50, 10)]
    assert n == [10, 10, 10, 10, 2]


def test_no_row_is_moved(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("title"))
    plan = E.holdout_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan and "Sort" not in plan
    assert E.holdout_split(df).count() == 200
    assert S.first_rows(df.limit(0), ["title"], 5).count() == 0
