"""Dump projections and filters (P2-P12): pages -> catalogue rows and texts.

Input is the page table of ``sources.dump.read_dump``:
``(title, ns, id, redirect, text, malformed)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.selection import first_rows
from ..session import materialise

ARTICLE_NS, CATEGORY_NS = 0, 14
CATEGORY_PREFIX_LEN = len("Category:")


def _is_valid():
    return (F.col("malformed").isNull() & F.col("ns").isin(ARTICLE_NS, CATEGORY_NS)
            & F.col("redirect").isNull())


def valid_pages(pages: DataFrame) -> DataFrame:
    """P2 + P3: well-formed, article or category namespace, not a redirect; adds
    ``kind`` and the normalised title."""
    return (pages.where(_is_valid()).drop("malformed")
            .withColumn("kind", F.when(F.col("ns") == CATEGORY_NS, "category")
                        .otherwise("article"))
            .withColumn("title", T.norm_name(F.col("title"))))


def split_body(valid: DataFrame) -> DataFrame:
    """Text before the first category link is the body, the rest is the
    category text; pages without text or without a link give no row."""
    cut = F.instr("text", T.CATEGORY_MARKER)
    return (valid.where(F.col("text").isNotNull() & (cut > 0))
            .select("id", "title", "kind",
                    F.expr("substr(text, 1, instr(text, '[[Category:') - 1)").alias("body"),
                    F.expr("substr(text, instr(text, '[[Category:'))").alias("cat_text")))


def extract_catpage(split: DataFrame) -> DataFrame:
    """(cat_name, pag_title) from article category links."""
    return (split.where(F.col("kind") == "article")
            .select(F.explode(T.category_links(F.col("cat_text"))).alias("raw"),
                    F.col("title").alias("pag_title"))
            .select(T.norm_name(F.col("raw")).alias("cat_name"), "pag_title").distinct())


def child_name(title):
    """Category page title without "Category:", re-normalised."""
    return T.norm_name(F.substring(title, CATEGORY_PREFIX_LEN + 1, 1 << 30))


def extract_catsub(split: DataFrame, truncate: bool = False) -> DataFrame:
    """(cat_name = parent, cat_name_sub = child) from category pages.

    ``truncate=True`` cuts parent names at the first of ``( . * ? ) [ | ]`` as
    the reference's character class does; the default keeps whole names so
    parents match article categories.
    """
    return (split.where(F.col("kind") == "category")
            .select(F.explode(T.category_links(F.col("cat_text"), truncate)).alias("raw"),
                    child_name(F.col("title")).alias("cat_name_sub"))
            .select(T.norm_name(F.col("raw")).alias("cat_name"), "cat_name_sub").distinct())


def plain_texts(split: DataFrame) -> DataFrame:
    """(title, text) = article body with markup removed."""
    return (split.where(F.col("kind") == "article")
            .select("title", T.plain_text(F.col("body")).alias("text")))


def limit_pages(pages: DataFrame, max_pages: int) -> DataFrame:
    """P10: the first ``max_pages`` valid pages in page-id order (the cap is
    the operator's purpose: ingest a prefix of the dump).  The last id is found
    by counting, so nothing is sorted."""
    valid = valid_pages(pages)
    ids = materialise(valid.select("id"), "page_ids")  # the dump is parsed once for them
    return first_rows(valid, ["id"], max_pages, counted=ids)


def ingest_stats(pages: DataFrame) -> DataFrame:
    """Total, valid and malformed pages (records that are not well-formed XML)."""
    return pages.agg(F.count(F.lit(1)).alias("total_pages"),
                     F.count_if(_is_valid()).alias("valid_pages"),
                     F.count_if(F.col("malformed").isNotNull()).alias("malformed_pages"))


def derive_pages(split: DataFrame) -> DataFrame:
    """Titles of articles that have a category marker."""
    return split.where(F.col("kind") == "article").select("title").distinct()


def derive_categories(split: DataFrame, truncate: bool = False) -> DataFrame:
    """Categories of articles, parents and children of category pages."""
    cp = extract_catpage(split).select(F.col("cat_name").alias("name"))
    cs = extract_catsub(split, truncate)
    children = (split.where(F.col("kind") == "category")
                .select(child_name(F.col("title")).alias("name")))
    return (cp.union(cs.select(F.col("cat_name").alias("name"))).union(children).distinct())
