import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catspark.operators import classify as K
from catspark.operators import evaluate as E
from catspark.plans.pipeline import Pipeline
from catspark.sources.tables import Catalogue
from conftest import SF0001, SF001


@pytest.fixture(scope="module")
def small(spark):
    return Pipeline(spark, SF0001)


def test_tf_sums_to_one_and_idf_non_negative(small):
    tf = small.index.postings.groupBy("title").agg(F.sum("tf").alias("s"))
    assert tf.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    assert small.index.vocab.where(F.col("idf") < 0).count() == 0


def test_cosine_symmetric_bounded_self_one(spark, small):
    vec = small.vectors
    v2 = vec.withColumnRenamed("title", "other")
    sims = K.cosine(vec, v2, "title", "other")
    rows = {(r.title, r.other): r.score for r in sims.collect()}
    for (a, b), s in rows.items():
        assert -1e-12 <= s <= 1 + 1e-9
        assert abs(s - rows[(b, a)]) < 1e-9
        if a == b:
            assert abs(s - 1) < 1e-9


def test_centroid_without_holdout_is_mean_of_members(spark, small):
    cents = K.centroids(small.vectors, small.cat.catpage, 5)
    cat = cents.select("cat_name").first().cat_name
    members = small.cat.catpage.where(F.col("cat_name") == cat).select(
        F.col("pag_title").alias("title"))
    size = members.count()
    mean = (small.vectors.join(members, "title").groupBy("word")
            .agg((F.sum("weight") / size).alias("m")))
    got = cents.where(F.col("cat_name") == cat).join(mean, "word")
    assert got.where(F.abs(F.col("weight") - F.col("m")) > 1e-12).count() == 0
    assert got.count() == mean.count()


def test_measures_invariants(small):
    m = small.measures
    assert m.where(F.col("fractional") > F.col("hierarchical") + 1e-12).count() == 0
    assert m.where((F.col("fractional") > 0) & (F.col("boolean") != 1)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 6), st.integers(0, 8))
def test_as_written_closed_form_equals_recurrence(a, k):
    m3 = 0.0
    for _ in range(k):
        m3 = (m3 + 0.5 * a) / a
    closed = 0.5 * k if a == 1 else 0.5 * (1 - a ** (-k)) / (1 - 1 / a)
    assert math.isclose(m3, closed, rel_tol=1e-12, abs_tol=1e-12)


def test_golden_recommendation_values(spark):
    """Unstemmed, threshold 5, hold-out = 200 pages by md5 order (FIXTURES)."""
    p = Pipeline(spark, SF001, stem=False)
    s = p.summary().first()
    assert s.n_pages == 200
    assert round(s.mean_boolean, 6) == 0.95
    assert round(s.mean_fractional, 6) == 0.290798
    assert round(s.mean_hierarchical, 6) == 0.416798
    assert round(s.mean_hierarchical_as_written, 6) == 0.460844
    assert round(s.std_fractional, 6) == 0.123158
    assert p.recs.count() == 812


def test_zero_score_padding_in_name_order(spark):
    vec = spark.createDataFrame([("p", "w1", 1.0)], "title string, word string, weight double")
    cents = spark.createDataFrame([("c", "w1", 1.0)], "cat_name string, word string, weight double")
    cats = spark.createDataFrame([("a", 9), ("b", 9), ("c", 9), ("d", 9)],
                                 "cat_name string, size long")
    cp = spark.createDataFrame([("x", "p"), ("y", "p"), ("z", "p")],
                               "cat_name string, pag_title string")
    recs, _ = K.recommend(vec, spark.createDataFrame([("p",)], "title string"), cp, cents, cats)
    got = [(r.rank, r.cat_name) for r in recs.orderBy("rank").collect()]
    assert got == [(1, "c"), (2, "a"), (3, "b")]


def test_holdout_split_size(spark):
    cat = Catalogue(spark, SF0001)
    n = cat.pages.count()
    assert E.holdout_split(cat.pages, 0.2).count() == int(n * 0.2)


def test_salted_cosine_equals_unsalted(small):
    vec = small.vectors
    cents = K.centroids(vec, small.cat.catpage, 5)
    plain = {(r.title, r.cat_name): r.score for r in K.cosine(vec, cents, "title", "cat_name")
             .collect()}
    salted = {(r.title, r.cat_name): r.score
              for r in K.cosine(vec, cents, "title", "cat_name", chunk=3).collect()}
    assert set(plain) == set(salted)
    assert max(abs(plain[k] - salted[k]) for k in plain) < 1e-9


def test_cosine_same_for_counts_and_tf(spark, small):
    """Raw-count x idf (new texts) and tf x idf (stored pages) differ by a
    per-page factor, so the scores against centroids are the same."""
    from catspark.operators import index as I
    cents = K.centroids(small.vectors, small.cat.catpage, 5)
    by_tf = {(r.title, r.cat_name): r.score
             for r in K.category_scores(small.vectors, cents).collect()}
    by_count = {(r.title, r.cat_name): r.score for r in K.category_scores(
        I.vector_of_text(small.cat.texts, small.index.vocab), cents).collect()}
    assert set(by_tf) == set(by_count)
    assert max(abs(by_tf[k] - by_count[k]) for k in by_tf) < 1e-9


def _read(spark, df):
    """``df`` with a count of the rows that were read from it, and that count."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(rows, df.schema), seen


def test_centroids_and_text_vectors_are_made_once(spark, small):
    vectors, seen = _read(spark, small.vectors)
    E.evaluation(vectors, small.cat.catpage, small.cat.catsub, small.holdout, 5)[0].collect()
    # for the centroids, for the norms of the test pages and for their entries
    assert seen.value <= 3 * small.vectors.count()
    voc, seen = _read(spark, small.index.vocab)
    texts = small.cat.texts.limit(20).withColumn("categories", F.array(F.lit("lang_en")))
    recs, meas = K.categorise_texts(texts, voc, small.centroids, small.cent_cats, small.cat.catsub)
    assert recs.count() and meas.count()
    assert seen.value == small.index.vocab.count()
