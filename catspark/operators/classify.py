"""Centroids, scoring, recommendation and measures.

Inputs are long tables: ``page_vectors(title, word, weight)``,
``catpage(cat_name, pag_title)`` and ``catsub(cat_name, cat_name_sub)``.
Cosine is a shuffle join on ``word`` of length-normalised vectors followed by
a (title, cat_name) aggregate; zero weights are dropped before any join
(they add nothing to a dot product or a norm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

SCORE_DIGITS = 9  # scores are compared at this precision when ranking


# ---------------------------------------------------------------------------
# K1-K2: centroids
# ---------------------------------------------------------------------------

def category_sizes(catpage: DataFrame) -> DataFrame:
    """(cat_name, size) = pages per category, from the whole catalogue."""
    return catpage.groupBy("cat_name").agg(F.count(F.lit(1)).alias("size"))


def centroid_categories(catpage: DataFrame, min_pages: int = 5) -> DataFrame:
    """Categories that get a centroid (size >= min_pages), with their size."""
    return category_sizes(catpage).where(F.col("size") >= min_pages)


def centroids(vectors: DataFrame, catpage: DataFrame, min_pages: int = 5,
              holdout: DataFrame | None = None) -> DataFrame:
    """K1/K2: (cat_name, word, weight) = sum of member vectors / category size.

    Hold-out pages (``holdout(title)``) leave the sums but not the sizes.  A
    category whose pages are all held out has an empty centroid (no rows) but
    still counts as a centroid (see ``centroid_categories``).
    """
    members = (catpage.join(centroid_categories(catpage, min_pages), "cat_name")
               .withColumnRenamed("pag_title", "title"))
    if holdout is not None:
        members = members.join(holdout.select("title"), "title", "left_anti")
    return (vectors.join(members, "title")
            .groupBy("cat_name", "word")
            .agg(F.sum(F.col("weight") / F.col("size")).alias("weight")))


# ---------------------------------------------------------------------------
# V5 / K3: cosine scores
# ---------------------------------------------------------------------------

def normalise(vectors: DataFrame, key: str) -> DataFrame:
    """Unit-length vectors; zero weights and zero vectors disappear.

    Norms come from a map-side-combined aggregate joined back on the key (a
    huge vector is never sorted in one task as a window would need)."""
    nz = vectors.where(F.col("weight") != 0)
    norms = nz.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"))
    return (nz.join(norms, key)
            .withColumn("weight", F.col("weight") / F.col("_norm")).drop("_norm"))


def cosine(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
           chunk: int = 2000) -> DataFrame:
    """(left_key, right_key, score) for every pair sharing a non-zero word.

    Pairs without a shared word score 0.0 and are not emitted.  Both sides of
    a word are split into blocks of about ``chunk`` entries by key hash, and
    each pair of blocks is a join key of its own: at most chunk^2 products come
    from one key, however frequent the word is on either side.
    """
    a = normalise(left, left_key).select(left_key, "word", F.col("weight").alias("_a"))
    b = normalise(right, right_key).select(right_key, "word", F.col("weight").alias("_b"))
    count = lambda df, n: df.groupBy("word").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias(n))
    blocks = count(a, "_na").join(count(b, "_nb"), "word")  # words of both sides only
    hot = materialise(blocks.where("_na > 1 or _nb > 1"), "hot_words")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.coalesce(n, F.lit(1))).cast("int")
    a = (a.join(hot, "word", "left").withColumn("_i", own(left_key, "_na"))
         .withColumn("_j", every("_nb")).drop("_na", "_nb"))
    b = (b.join(hot, "word", "left").withColumn("_j", own(right_key, "_nb"))
         .withColumn("_i", every("_na")).drop("_na", "_nb"))
    return (a.join(b, ["word", "_i", "_j"])
            .groupBy(left_key, right_key)
            .agg(F.sum(F.col("_a") * F.col("_b")).alias("score")))


def category_scores(vectors: DataFrame, cents: DataFrame) -> DataFrame:
    """K3: (title, cat_name, score) for pages sharing a word with a centroid.

    ``cosine`` with its products added up where they are made: what moves is a
    row of partial scores per page and chunk of words, not a row per product."""
    from .topn import all_scores
    return all_scores(vectors, cents)


# ---------------------------------------------------------------------------
# K4-K5: top-n with the reference's tie order
# ---------------------------------------------------------------------------

def suggestion_counts(pages: DataFrame, catpage: DataFrame, cent_cats: DataFrame,
                      n: int | None = None) -> DataFrame:
    """K5: (title, n_actual, n) with n = given, else min(#centroids, #actual)."""
    actual = (catpage.join(pages.select(F.col("title").alias("pag_title")), "pag_title",
                           "left_semi")
              .groupBy("pag_title").agg(F.count(F.lit(1)).alias("n_actual"))
              .withColumnRenamed("pag_title", "title"))
    if n is not None:
        return actual.withColumn("n", F.lit(n).cast("long"))
    n_cent = cent_cats.agg(F.count(F.lit(1))).scalar()
    return actual.withColumn("n", F.least(F.col("n_actual"), n_cent))


def first_names(cent_cats: DataFrame, most: int, group: list[str]) -> DataFrame:
    """([group], cat_name, slot): the first ``most`` names (of each group) in name order."""
    if not group:
        first = cent_cats.select("cat_name").orderBy("cat_name").limit(most)
        return first.withColumn("slot", F.row_number().over(Window.orderBy("cat_name"))
                                .cast("long"))  # at most `most` rows
    w = Window.partitionBy(*group).orderBy("cat_name")
    return (cent_cats.select(*group, "cat_name").withColumn("slot", F.row_number().over(w))
            .where(F.col("slot") <= most).withColumn("slot", F.col("slot").cast("long")))


def _padding(counts: DataFrame, ranked: DataFrame, group: list[str]) -> DataFrame:
    """For each page the first ``n`` centroid names (score 0 candidates).

    Slots 1..n are exploded per page and equi-joined to ``first_names``, so no
    page is paired with more than n categories.
    """
    slots = counts.select(*group, "title",
                          F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("slot"))
    return (slots.join(ranked, [*group, "slot"])
            .select(*group, "title", "cat_name", F.lit(0.0).alias("score")))


def recommendations(scores: DataFrame, counts: DataFrame, cent_cats: DataFrame,
                    group: list[str] | None = None) -> DataFrame:
    """K4: ([group], title, rank, cat_name, score) top-n per page.

    Order: score desc (compared at ``SCORE_DIGITS``), then category name, as
    the stable sort over name-ordered centroids does.  Pages sharing words
    with fewer than n centroids are padded with score-0 categories by name.
    ``scores(title, cat_name, score)`` may hold categories outside
    ``cent_cats``; they are ignored.
    """
    group = list(group or [])
    counts = counts.where(F.col("n") >= 1)
    most = most_suggestions(counts)
    scored = (scores.join(counts.select(*group, "title"), "title")
              .join(cent_cats.select(*group, "cat_name"), [*group, "cat_name"], "left_semi"))
    return rank_candidates(scored, counts, first_names(cent_cats, most, group), most, group)


def most_suggestions(counts: DataFrame) -> int:
    """The largest n of any page."""
    return counts.agg(F.max("n")).first()[0] or 0


def best_first(*keys: str):
    """Window over the candidates of a page: best score first, then name."""
    return Window.partitionBy(*keys).orderBy(F.round("score", SCORE_DIGITS).desc(),
                                             F.col("cat_name"))


def rank_candidates(scored: DataFrame, counts: DataFrame, names: DataFrame, most: int,
                    group: list[str]) -> DataFrame:
    """The n best of ``scored`` and the padding ``names`` per page.

    The bound ``most`` is a literal, so Spark keeps at most that many rows per
    page in each task before the shuffle by page.
    """
    keys = [*group, "title"]
    top = (scored.select(*keys, "cat_name", "score")
           .withColumn("_r", F.row_number().over(best_first(*keys)))
           .where(F.col("_r") <= most).drop("_r"))
    cands = (top.unionByName(_padding(counts, names, group))
             .groupBy(*keys, "cat_name").agg(F.max("score").alias("score")))
    return (cands.join(counts.select(*keys, "n"), keys)
            .withColumn("rank", F.row_number().over(best_first(*keys)))
            .where(F.col("rank") <= F.col("n"))
            .select(*group, "title", F.col("rank").cast("int").alias("rank"), "cat_name",
                    "score"))


# ---------------------------------------------------------------------------
# K6-K9: measures
# ---------------------------------------------------------------------------

def father_son(pairs: DataFrame, catsub: DataFrame, a: str = "cat_a",
               b: str = "cat_b") -> DataFrame:
    """Q11: pairs (a, b) where one is the direct parent of the other."""
    edges = (catsub.select(F.col("cat_name").alias(a), F.col("cat_name_sub").alias(b))
             .union(catsub.select(F.col("cat_name_sub").alias(a), F.col("cat_name").alias(b))))
    return pairs.join(edges.distinct(), [a, b], "left_semi")


def brothers(pairs: DataFrame, catsub: DataFrame, a: str = "cat_a",
             b: str = "cat_b") -> DataFrame:
    """Q12: pairs (a, b), a != b, sharing at least one parent.

    Each pair is expanded to the parents of ``a`` only and then semi-joined
    on (parent, b), so no group is ever expanded into all its sibling pairs.
    """
    parents_a = catsub.select(F.col("cat_name").alias("_parent"),
                              F.col("cat_name_sub").alias(a))
    children = catsub.select(F.col("cat_name").alias("_parent"),
                             F.col("cat_name_sub").alias(b))
    hits = (pairs.select(a, b).distinct().where(F.col(a) != F.col(b))
            .join(parents_a, a).join(children, ["_parent", b], "left_semi")
            .select(a, b).distinct())
    return pairs.join(hits, [a, b], "left_semi")


def measures(recs: DataFrame, catpage: DataFrame, catsub: DataFrame,
             counts: DataFrame, group: list[str] | None = None) -> DataFrame:
    """K6-K8 per page: boolean, fractional, hierarchical (documented meaning)
    and hierarchical as the reference's loop computes it (closed form)."""
    group = list(group or [])
    keys = [*group, "title"]
    titles = counts.select(F.col("title").alias("pag_title")).distinct()
    actual = (catpage.join(titles, "pag_title", "left_semi")
              .select(F.col("pag_title").alias("title"), F.col("cat_name").alias("actual")))
    flagged = (recs.join(actual.withColumnRenamed("actual", "cat_name")
                         .withColumn("hit", F.lit(1)), ["title", "cat_name"], "left")
               .withColumn("hit", F.coalesce("hit", F.lit(0))))
    per_page = flagged.groupBy(*keys).agg(
        F.max("hit").alias("boolean"),
        F.sum("hit").alias("hits"),
        F.sum(1 - F.col("hit")).alias("misses"))
    # partial credit for each (miss, actual category) pair of the same page
    pairs = (flagged.where(F.col("hit") == 0)
             .select(*keys, F.col("cat_name").alias("cat_b"))
             .join(actual.withColumnRenamed("actual", "cat_a"), "title"))
    links = pairs.select("cat_a", "cat_b").distinct()
    fs = father_son(links, catsub).withColumn("fs", F.lit(True))
    br = brothers(links, catsub).withColumn("br", F.lit(True))
    credit = (pairs.join(fs, ["cat_a", "cat_b"], "left")
              .join(br, ["cat_a", "cat_b"], "left")
              .select(*keys, F.when(F.col("fs"), 0.5).when(F.col("br"), 0.25)
                      .otherwise(0.0).alias("credit"))
              .groupBy(*keys).agg(F.sum("credit").alias("credit")))
    a = F.col("n_actual").cast("double")
    k = F.col("misses").cast("double")
    n = F.col("n").cast("double")
    frac = F.col("hits") / n
    as_written = F.when(a == 1, 0.5 * k).otherwise(
        0.5 * (1 - F.pow(a, -k)) / (1 - 1 / a))
    return (per_page.join(counts, keys).join(credit, keys, "left")
            .select(*keys,
                    F.col("boolean").cast("int").alias("boolean"),
                    frac.alias("fractional"),
                    (frac + F.coalesce("credit", F.lit(0.0)) / a / n).alias("hierarchical"),
                    (frac + as_written / n).alias("hierarchical_as_written")))


def recommendation_report(recs: DataFrame, catpage: DataFrame, meas: DataFrame) -> DataFrame:
    """K9: sorted actual and suggested names plus the measures, one row per page."""
    actual = (catpage.join(meas.select(F.col("title").alias("pag_title")), "pag_title",
                           "left_semi")
              .groupBy("pag_title")
              .agg(F.array_join(F.array_sort(F.collect_list("cat_name")), ", ").alias("actual"))
              .withColumnRenamed("pag_title", "title"))
    suggested = recs.groupBy("title").agg(
        F.array_join(F.array_sort(F.collect_list("cat_name")), ", ").alias("suggested"))
    return (meas.join(actual, "title").join(suggested, "title")
            .select("title", "actual", "suggested", (F.col("fractional") != 0).alias("success"),
                    "boolean", "fractional", "hierarchical"))


# ---------------------------------------------------------------------------
# End-to-end: recommend categories for a set of pages
# ---------------------------------------------------------------------------

def recommend(vectors: DataFrame, pages: DataFrame, catpage: DataFrame,
              cents: DataFrame, cent_cats: DataFrame, n: int | None = None):
    """K4-K5 for ``pages(title)``: returns (recommendations, counts).

    Only categories that can enter a page's best n are scored.
    """
    from .topn import best_categories
    counts = suggestion_counts(pages, catpage, cent_cats, n)
    page_vecs = vectors.join(pages.select("title"), "title", "left_semi")
    scores = best_categories(page_vecs, cents, counts, cent_cats)
    return recommendations(scores, counts, cent_cats), counts


def categorise_texts(texts: DataFrame, voc: DataFrame, cents: DataFrame,
                     cent_cats: DataFrame, catsub: DataFrame, n: int | None = None,
                     stem: bool = True):
    """Recommend categories for unseen ``texts(title, text, categories)``
    (vectors = raw counts x corpus idf) and score them against the texts' own
    category lists.  Returns (recommendations, measures)."""
    from .index import vector_of_text
    from .topn import best_categories
    own = texts.select(F.explode(F.array_distinct("categories")).alias("cat_name"),
                       F.col("title").alias("pag_title"))
    # read for the norms and for the entries
    vecs = materialise(vector_of_text(texts.select("title", "text"), voc, stem=stem),
                       "text_vectors")
    pages = texts.select("title")
    counts = suggestion_counts(pages, own, cent_cats, n)
    recs = recommendations(best_categories(vecs, cents, counts, cent_cats), counts, cent_cats)
    return recs, measures(recs, own, catsub, counts)
