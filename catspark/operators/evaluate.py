"""Sampling, evaluation and the threshold sweep.

Samples are repeatable: pages are ordered by ``md5(title || seed)`` (plus the
threshold for the per-threshold samples), the same order in any engine.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.selection import first_rows
from ..session import materialise
from . import classify as K
from .topn import best_categories

SEED = "42"


def _sample_key(seed: str = SEED, extra=None):
    parts = [F.col("title"), F.lit(seed)]
    if extra is not None:
        parts.append(extra.cast("string"))
    return F.md5(F.concat(*parts))


def sample_pages(pages: DataFrame, n: int, seed: str = SEED) -> DataFrame:
    """Exactly ``n`` pages (all if fewer), a repeatable random sample."""
    return (pages.select("title").orderBy(_sample_key(seed), "title").limit(n))


def holdout_split(pages: DataFrame, fraction: float = 0.2, seed: str = SEED) -> DataFrame:
    """The first floor(N * fraction) pages in sample order.

    The last key of the sample is found by counting; the sample is a filter.
    """
    keyed = pages.select("title", _sample_key(seed).alias("_h"))
    return first_rows(keyed, ["_h", "title"], floor(pages.count() * fraction)).select("title")


def evaluation(vectors: DataFrame, catpage: DataFrame, catsub: DataFrame,
               test_pages: DataFrame, min_pages: int = 5, holdout: bool = False):
    """Measures of the test pages and their means.

    Returns (per-page measures, one-row summary).  ``holdout=True`` keeps the
    test pages out of the centroid sums.
    """
    cents = materialise(K.centroids(vectors, catpage, min_pages, test_pages if holdout else None),
                        "eval_centroids")  # read for the norms and for the entries
    cats = K.centroid_categories(catpage, min_pages)
    counts = materialise(K.suggestion_counts(test_pages, catpage, cats), "eval_counts")
    scores = best_categories(vectors.join(test_pages, "title", "left_semi"), cents, counts, cats)
    recs = materialise(K.recommendations(scores, counts, cats), "eval_recs")
    meas = K.measures(recs, catpage, catsub, counts)
    summary = meas.agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("boolean").alias("n_success"),
        F.avg("boolean").alias("mean_boolean"),
        F.avg("fractional").alias("mean_fractional"),
        F.avg("hierarchical").alias("mean_hierarchical"),
        F.avg("hierarchical_as_written").alias("mean_hierarchical_as_written"))
    return meas, summary


def per_threshold_samples(test: DataFrame, thresholds: list[int], n_pages: int,
                          seed: str = SEED) -> DataFrame:
    """E5: (t, title) a fresh sample of ``n_pages`` test pages per threshold.

    ``row_number <= n`` per threshold plans as a partial group limit before
    the shuffle, so each task forwards at most n rows per threshold.
    """
    t_col = F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("t")
    expanded = test.select("title", t_col)
    w = Window.partitionBy("t").orderBy(_sample_key(seed, F.col("t")), "title")
    return (expanded.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n_pages).select("t", "title"))


def threshold_sweep(vectors: DataFrame, catpage: DataFrame, catsub: DataFrame,
                    pages: DataFrame, min_pag: int = 4, max_pag: int = 50,
                    n_pages: int = 100, fraction: float = 0.2,
                    seed: str = SEED) -> DataFrame:
    """One row per threshold t in [min_pag, max_pag].

    Hold out ``fraction`` of the pages, build centroids once at ``min_pag``
    without them, and for each t keep the centroids of categories with >= t
    pages and score a fresh sample of ``n_pages`` hold-out pages.  Scores do
    not depend on t, so every sampled page is scored once.
    """
    thresholds = list(range(min_pag, max_pag + 1))
    test = materialise(holdout_split(pages, fraction, seed), "sweep_holdout")
    cents = materialise(K.centroids(vectors, catpage, min_pag, test), "sweep_centroids")
    sizes = K.centroid_categories(catpage, min_pag)
    sampled = per_threshold_samples(test, thresholds, n_pages, seed)
    scored_pages = sampled.select("title").distinct()
    scores = K.category_scores(vectors.join(scored_pages, "title", "left_semi"), cents)
    # a category is alive at every threshold up to its bucket
    bucket = F.least(F.col("size"), F.lit(max_pag)).cast("int").alias("b")
    buckets = materialise(sizes.select("cat_name", bucket), "sweep_buckets")
    alive = F.explode(F.sequence(F.lit(min_pag), F.col("b"))).alias("t")
    n_cent = (buckets.groupBy("b").agg(F.count(F.lit(1)).alias("n"))  # a row per bucket
              .select("n", alive).groupBy("t").agg(F.sum("n").alias("n_centroids")))
    actual = (catpage.join(scored_pages.withColumnRenamed("title", "pag_title"), "pag_title",
                           "left_semi")
              .groupBy("pag_title").agg(F.count(F.lit(1)).alias("n_actual"))
              .withColumnRenamed("pag_title", "title"))
    counts = (sampled.join(actual, "title").join(n_cent, "t")
              .withColumn("n", F.least("n_actual", "n_centroids"))
              .select("t", "title", "n_actual", "n"))
    # small intermediates, written once: every later step reads them several
    # times (and a lost executor does not recompute the scoring)
    counts = materialise(counts, "sweep_counts")
    most = K.most_suggestions(counts)
    # the best at any threshold are among the best of each bucket: only those
    # are compared at the thresholds (a category is never exploded over them)
    best = (scores.join(buckets, "cat_name")
            .withColumn("_r", F.row_number().over(K.best_first("title", "b")))
            .where(F.col("_r") <= most).drop("_r"))
    scored = materialise(best, "sweep_scores").join(counts.select("t", "title"), "title").where(
        F.col("b") >= F.col("t"))
    names = K.first_names(K.first_names(buckets, most, ["b"]).select("cat_name", alive), most,
                          ["t"])
    recs = materialise(K.rank_candidates(scored, counts.where(F.col("n") >= 1), names, most,
                                         ["t"]), "sweep_recs")
    meas = K.measures(recs, catpage, catsub, counts, group=["t"])
    return (meas.groupBy("t").agg(
        F.avg("boolean").alias("mean_boolean"),
        F.stddev_pop("boolean").alias("std_boolean"),
        F.avg("fractional").alias("mean_fractional"),
        F.stddev_pop("fractional").alias("std_fractional"),
        F.avg("hierarchical").alias("mean_hierarchical"),
        F.stddev_pop("hierarchical").alias("std_hierarchical"))
        .join(n_cent, "t")
        .select(F.col("t").cast("int").alias("n_pages"), "n_centroids", "mean_boolean",
                "std_boolean", "mean_fractional", "std_fractional", "mean_hierarchical",
                "std_hierarchical"))


def sweep_long(sweep: DataFrame) -> DataFrame:
    """Three rows per threshold (Boolean, Fractional, Hierarchical)."""
    return sweep.selectExpr(
        "n_pages", "n_centroids",
        "stack(3, 'Boolean', mean_boolean, std_boolean, "
        "'Fractional', mean_fractional, std_fractional, "
        "'Hierarchical', mean_hierarchical, std_hierarchical) AS (type, mean, std)")
