"""Catalogue operators over pages / categories / catpage / catsub
(S5, Q1-Q12, C1-C5).

Point lookups of the reference (one title, one category, one pair) are
batch operators here: they take a DataFrame of keys and answer for all of
them with one join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.selection import rows_between
from .classify import brothers, category_sizes, father_son

# ---------------------------------------------------------------------------
# Scans with optional offset / limit (ordered by key, tie-broken)
# ---------------------------------------------------------------------------

SCAN_ORDER = {
    "pages": ["title"],
    "categories": ["name"],
    "catpage": ["pag_title", "cat_name"],
    "catsub": ["cat_name_sub", "cat_name"],
}


def page_of(table: DataFrame, order: list[str], nrows: int | None, offset: int) -> DataFrame:
    """Rows offset .. offset + nrows - 1 in ``order``.

    A first page is a top-k; a later one is a filter between two keys that
    counting finds, so the rows before it are neither sorted nor moved.
    """
    if nrows is None and not offset:
        return table
    if not offset:
        return table.orderBy(*order).limit(nrows)
    rows = rows_between(table, order, offset, nrows)
    return rows if nrows is None else rows.orderBy(*order)


def scan(table: DataFrame, kind: str, nrows: int | None = None, offset: int = 0) -> DataFrame:
    """Rows of ``table`` in key order; ``nrows``/``offset`` page through it."""
    return page_of(table, SCAN_ORDER[kind], nrows, offset)


# ---------------------------------------------------------------------------
# Q1-Q12
# ---------------------------------------------------------------------------

def row_count(table: DataFrame, alias: str = "n") -> DataFrame:
    """Q1: one-row count."""
    return table.agg(F.count(F.lit(1)).alias(alias))


def is_in_pages(titles: DataFrame, pages: DataFrame, title: str = "title") -> DataFrame:
    """Q2: (title, found) for every asked title."""
    hits = pages.select(F.col("title").alias(title)).distinct().withColumn("_hit", F.lit(True))
    return (titles.select(title).join(hits, title, "left")
            .select(title, F.coalesce("_hit", F.lit(False)).alias("found")))


def top_categories(catsub: DataFrame, nrows: int | None = None, offset: int = 0) -> DataFrame:
    """Q3: parents that are nobody's child."""
    subs = catsub.select(F.col("cat_name_sub").alias("cat_name"))
    roots = catsub.select("cat_name").distinct().join(subs, "cat_name", "left_anti")
    return page_of(roots, ["cat_name"], nrows, offset)


def biggest_categories(catpage: DataFrame, catsub: DataFrame, min_pages: int = 500) -> DataFrame:
    """Q4: leaf categories (not a parent) with >= min_pages pages, excluding
    names containing birth/death in any letter case; biggest first."""
    parents = catsub.select("cat_name").distinct()
    kept = (catpage.where(~F.col("cat_name").ilike("%birth%")
                          & ~F.col("cat_name").ilike("%death%"))
            .join(parents, "cat_name", "left_anti"))
    return (kept.groupBy("cat_name").agg(F.count(F.lit(1)).alias("c"))
            .where(F.col("c") >= min_pages)
            .orderBy(F.col("c").desc(), "cat_name"))


def avg_categories_per_page(catpage: DataFrame) -> DataFrame:
    """Q5: mean number of categories per page (two aggregation stages)."""
    per_page = catpage.groupBy("pag_title").agg(F.count(F.lit(1)).alias("c"))
    return per_page.agg(F.avg("c").alias("avg_categories"))


def pages_of_category(catpage: DataFrame, cats: DataFrame) -> DataFrame:
    """Q6: (cat_name, pag_title) for each asked category."""
    return catpage.join(cats.select("cat_name").distinct(), "cat_name", "left_semi")


def categories_of_page(catpage: DataFrame, pages: DataFrame) -> DataFrame:
    """Q7: (pag_title, cat_name) for each asked page."""
    asked = pages.select(F.col("title").alias("pag_title")).distinct()
    return catpage.join(asked, "pag_title", "left_semi")


def category_sizes_at_least(catpage: DataFrame, min_pages: int = 1) -> DataFrame:
    """Q8: (cat_name, c) for categories with >= min_pages pages."""
    return (category_sizes(catpage).where(F.col("size") >= min_pages)
            .select("cat_name", F.col("size").alias("c")).orderBy("cat_name"))


def categories_by_page(catpage: DataFrame, min_pages: int, sep: str = " | ") -> DataFrame:
    """Q9: for pages with at least one category of >= min_pages pages, all of
    their categories (sorted), as an array and as one string."""
    big = category_sizes(catpage).where(F.col("size") >= min_pages).select("cat_name")
    qualifying = catpage.join(big, "cat_name", "left_semi").select("pag_title").distinct()
    return (catpage.join(qualifying, "pag_title", "left_semi")
            .groupBy("pag_title")
            .agg(F.array_sort(F.collect_set("cat_name")).alias("categories"))
            .withColumn("categories_text", F.array_join("categories", sep)))


def small_categories(catpage: DataFrame, min_pages: int) -> DataFrame:
    """Q10: categories with fewer than min_pages pages (the ones to drop)."""
    return category_sizes(catpage).where(F.col("size") < min_pages).select("cat_name")


__all__ = ["father_son", "brothers"]


# ---------------------------------------------------------------------------
# Batch loading and constraints
# ---------------------------------------------------------------------------

def bulk_upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing plus the new rows whose key is absent; duplicates ignored."""
    fresh = new.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh)


def bulk_load(existing: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """C1 over the four tables (pages, categories, catpage, catsub).

    Rows whose key is present are ignored, and so are edges from a category to
    itself, which the table's check constraint refuses.
    """
    loops = F.col("cat_name") == F.col("cat_name_sub")
    new = new | {"catsub": new["catsub"].where(~loops)}
    return {kind: bulk_upsert(existing[kind], new[kind], SCAN_ORDER[kind]) for kind in SCAN_ORDER}


def insert_conflicts(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The new rows a strict insert would reject: (keys..., reason)."""
    clash = (new.select(*keys).distinct().join(existing.select(*keys), keys, "left_semi")
             .withColumn("reason", F.lit("exists")))
    dup = (new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > 1).select(*keys).withColumn("reason", F.lit("duplicate")))
    return clash.unionByName(dup)


def append_catpage(categories: DataFrame, catpage: DataFrame, pairs: DataFrame) -> DataFrame:
    """Insert (cat_name, pag_title) pairs, creating missing categories
    (not pages); returns the change set as (table, key1, key2)."""
    new_cats = (pairs.select(F.col("cat_name").alias("name")).distinct()
                .join(categories.select("name"), "name", "left_anti"))
    new_pairs = (pairs.select("cat_name", "pag_title").distinct()
                 .join(catpage, ["cat_name", "pag_title"], "left_anti"))
    return (new_cats.select(F.lit("categories").alias("table"), F.col("name").alias("key1"),
                            F.lit(None).cast("string").alias("key2"))
            .unionByName(new_pairs.select(F.lit("catpage").alias("table"),
                                          F.col("cat_name").alias("key1"),
                                          F.col("pag_title").alias("key2"))))


def append_catsub(categories: DataFrame, catsub: DataFrame, edges: DataFrame) -> DataFrame:
    """C4: insert (cat_name, cat_name_sub) edges creating both categories.
    A duplicate edge or a self-loop is an error: such edges are reported in
    the change set with table = 'error' instead of being inserted."""
    edges = edges.select("cat_name", "cat_name_sub")
    names = (edges.select(F.col("cat_name").alias("name"))
             .union(edges.select(F.col("cat_name_sub").alias("name"))).distinct()
             .join(categories.select("name"), "name", "left_anti"))
    keys = ["cat_name", "cat_name_sub"]
    dup_in_batch = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    bad = (edges.join(catsub, keys, "left_semi")
           .union(edges.where(F.col("cat_name") == F.col("cat_name_sub")))
           .union(dup_in_batch.select(*keys)).distinct())
    good = edges.distinct().join(bad, keys, "left_anti")
    row = lambda t, a, b: (F.lit(t).alias("table"), F.col(a).alias("key1"),
                           F.col(b).alias("key2"))
    return reduce(DataFrame.unionByName, [
        names.select(F.lit("categories").alias("table"), F.col("name").alias("key1"),
                     F.lit(None).cast("string").alias("key2")),
        good.select(*row("catsub", "cat_name", "cat_name_sub")),
        bad.select(*row("error", "cat_name", "cat_name_sub")),
    ])


def check_constraints(pages: DataFrame, categories: DataFrame, catpage: DataFrame,
                      catsub: DataFrame) -> DataFrame:
    """violations(rule, n) for primary keys, foreign keys and the
    cat_name != cat_name_sub check; every rule is reported, 0 if clean."""
    def dup(df, keys, rule):
        return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n"))

    def orphan(df, col, target, tcol, rule):
        return (df.select(F.col(col).alias("_k"))
                .join(target.select(F.col(tcol).alias("_k")), "_k", "left_anti")
                .agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n"))

    checks = [
        dup(pages, ["title"], "pk_pages"),
        dup(categories, ["name"], "pk_categories"),
        dup(catpage, ["cat_name", "pag_title"], "pk_catpage"),
        dup(catsub, ["cat_name", "cat_name_sub"], "pk_catsub"),
        orphan(catpage, "pag_title", pages, "title", "fk_catpage_page"),
        orphan(catpage, "cat_name", categories, "name", "fk_catpage_category"),
        orphan(catsub, "cat_name", categories, "name", "fk_catsub_parent"),
        orphan(catsub, "cat_name_sub", categories, "name", "fk_catsub_child"),
        catsub.where(F.col("cat_name") == F.col("cat_name_sub"))
              .agg(F.count(F.lit(1)).alias("n")).select(F.lit("check_self_loop").alias("rule"),
                                                        "n"),
    ]
    return reduce(DataFrame.unionByName, checks)
