"""Canonical tables bound from the driver's parquet tables.

``texts(title, text)``, ``catpage(cat_name, pag_title)``,
``catsub(cat_name, cat_name_sub)``, ``page_titles(title)`` and
``categories(name)``.  The categories are derived from the columns of every
document (language, source, their pair, quality/toxicity labels and birth or
death years), so each table grows with the corpus.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _title(col: str = "doc_id"):
    return F.col(col).cast("string")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(_title().alias("title"), "text")


def catpage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    pag = _title().alias("pag_title")
    year = lambda base, mod: (F.lit(base) + F.col("doc_id") % mod).cast("string")
    parts = [
        docs.select(F.concat(F.lit("lang_"), "lang").alias("cat_name"), pag),
        docs.select(F.col("source").alias("cat_name"), pag),
        docs.select(F.concat("source", F.lit(",_"), "lang").alias("cat_name"), pag),
        labels.select(F.concat(F.lit("quality_"), F.col("quality").cast("string"))
                      .alias("cat_name"), pag),
        labels.select(F.concat(F.lit("toxic_"), F.col("toxic").cast("string"))
                      .alias("cat_name"), pag),
        docs.where(F.col("doc_id") % 5 == 0)
            .select(F.concat(year(1900, 100), F.lit("_Births")).alias("cat_name"), pag),
        docs.where(F.col("doc_id") % 7 == 0)
            .select(F.concat(year(1950, 60), F.lit("_deaths")).alias("cat_name"), pag),
    ]
    return _union(parts).distinct()


def catsub(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("quality", "toxic")
    pair = F.concat("source", F.lit(",_"), "lang")
    lang = F.concat(F.lit("lang_"), "lang")
    parts = [
        docs.select(lang.alias("cat_name"), pair.alias("cat_name_sub")),
        docs.select(F.col("source").alias("cat_name"), pair.alias("cat_name_sub")),
        docs.select(F.lit("languages").alias("cat_name"), lang.alias("cat_name_sub")),
        labels.select(F.lit("labels").alias("cat_name"),
                      F.concat(F.lit("quality_"), F.col("quality").cast("string"))
                      .alias("cat_name_sub")),
        labels.select(F.lit("labels").alias("cat_name"),
                      F.concat(F.lit("toxic_"), F.col("toxic").cast("string"))
                      .alias("cat_name_sub")),
    ]
    return _union(parts).distinct()


def page_titles(cp: DataFrame) -> DataFrame:
    return cp.select(F.col("pag_title").alias("title")).distinct()


def categories(cp: DataFrame, cs: DataFrame) -> DataFrame:
    return (cp.select(F.col("cat_name").alias("name"))
            .union(cs.select(F.col("cat_name").alias("name")))
            .union(cs.select(F.col("cat_name_sub").alias("name")))
            .distinct())


class Catalogue:
    """The bound tables of one corpus directory.

    ``store(df, name)`` may write a table and read it back; it is called when a
    table is first asked for, so a query writes only what it reads.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, store=lambda df, name: df):
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = store

    @cached_property
    def texts(self) -> DataFrame:
        return texts(self.spark, self.sf_dir)

    @cached_property
    def catpage(self) -> DataFrame:
        return self.store(catpage(self.spark, self.sf_dir), "catpage")

    @cached_property
    def catsub(self) -> DataFrame:
        return self.store(catsub(self.spark, self.sf_dir), "catsub")

    @cached_property
    def pages(self) -> DataFrame:
        return self.store(page_titles(self.catpage), "pages")

    @cached_property
    def categories(self) -> DataFrame:
        return self.store(categories(self.catpage, self.catsub), "categories")


# ---------------------------------------------------------------------------
# The same bindings as DuckDB SQL (oracle side)
# ---------------------------------------------------------------------------

TEXTS_SQL = "SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents"

CATPAGE_SQL = """SELECT DISTINCT cat_name, pag_title FROM (
  SELECT concat('lang_', lang) AS cat_name, CAST(doc_id AS VARCHAR) AS pag_title FROM documents
  UNION ALL SELECT source, CAST(doc_id AS VARCHAR) FROM documents
  UNION ALL SELECT concat(source, ',_', lang), CAST(doc_id AS VARCHAR) FROM documents
  UNION ALL SELECT concat('quality_', CAST(quality AS VARCHAR)), CAST(doc_id AS VARCHAR) FROM labels
  UNION ALL SELECT concat('toxic_', CAST(toxic AS VARCHAR)), CAST(doc_id AS VARCHAR) FROM labels
  UNION ALL SELECT concat(CAST(1900 + doc_id % 100 AS VARCHAR), '_Births'), CAST(doc_id AS VARCHAR)
            FROM documents WHERE doc_id % 5 = 0
  UNION ALL SELECT concat(CAST(1950 + doc_id % 60 AS VARCHAR), '_deaths'), CAST(doc_id AS VARCHAR)
            FROM documents WHERE doc_id % 7 = 0) x"""

CATSUB_SQL = """SELECT DISTINCT cat_name, cat_name_sub FROM (
  SELECT concat('lang_', lang) AS cat_name, concat(source, ',_', lang) AS cat_name_sub FROM documents
  UNION ALL SELECT source, concat(source, ',_', lang) FROM documents
  UNION ALL SELECT 'languages', concat('lang_', lang) FROM documents
  UNION ALL SELECT 'labels', concat('quality_', CAST(quality AS VARCHAR)) FROM labels
  UNION ALL SELECT 'labels', concat('toxic_', CAST(toxic AS VARCHAR)) FROM labels) x"""

PAGES_SQL = "SELECT DISTINCT pag_title AS title FROM catpage"

CATEGORIES_SQL = """SELECT cat_name AS name FROM catpage UNION SELECT cat_name FROM catsub
  UNION SELECT cat_name_sub FROM catsub"""


def with_bindings(body: str) -> str:
    """Prefix a DuckDB query with the canonical tables as CTEs."""
    return (f"WITH texts AS ({TEXTS_SQL}),\ncatpage AS ({CATPAGE_SQL}),\n"
            f"catsub AS ({CATSUB_SQL}),\npage_titles AS ({PAGES_SQL}),\n"
            f"categories AS ({CATEGORIES_SQL})\n{body}")


# ---------------------------------------------------------------------------
# Encyclopedia pages derived from documents (the dump binding)
# ---------------------------------------------------------------------------
# Articles: every document, titled "Doc  <id>" (two spaces), its whole text
# followed by three category links; category pages: one per language, with
# parent links, and one per labelled document; redirects and template pages:
# one per source.

def _link_text(source, lang):
    nl = F.lit("\n")
    return F.concat(nl, F.lit("[[Category:"), source, F.lit("|"), lang, F.lit("]]"), nl,
                    F.lit("[[Category:  Lang   "), lang, F.lit(" (x) ]][[Category:U.S. "),
                    source, F.lit("]]"))


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(title, ns, id, redirect_title, text) pages built from ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    none = F.lit(None).cast("string")
    articles = docs.select(F.concat(F.lit("Doc  "), F.col("doc_id").cast("string")).alias("title"),
                           F.lit(0).alias("ns"), F.col("doc_id").alias("id"),
                           none.alias("redirect_title"),
                           F.concat("text", _link_text(F.col("source"), F.col("lang")))
                           .alias("text"))
    from ..plans.ranking import global_rank
    langs = global_rank(docs.select("lang").distinct(), ["lang"], "_r")
    cats = langs.select(
        F.concat(F.lit("Category:Lang  "), "lang", F.lit(" (x)")).alias("title"),
        F.lit(14).alias("ns"),
        (F.lit(1 << 40) + F.col("_r")).alias("id"),
        none.alias("redirect_title"),
        F.lit("intro [[Category:Languages (all)|x]][[Category:U.S. folks]][[Category:All]]")
        .alias("text"))
    sources = global_rank(docs.select("source").distinct(), ["source"], "_r")
    sid = F.col("_r")
    redirects = sources.select(
        F.concat(F.lit("Src "), "source").alias("title"), F.lit(0).alias("ns"),
        (F.lit(2 << 40) + sid).alias("id"),
        F.concat(F.lit("Category:"), "source").alias("redirect_title"),
        F.lit("#REDIRECT [[Category:X]]").alias("text"))
    templates = sources.select(
        F.concat(F.lit("Template:"), "source").alias("title"), F.lit(10).alias("ns"),
        (F.lit(3 << 40) + sid).alias("id"), none.alias("redirect_title"),
        F.lit("[[Category:T]]").alias("text"))
    # category pages that grow with the corpus: one per labelled document
    labels = read_table(spark, sf_dir, "labels")
    q, t = (F.col(c).cast("string") for c in ("quality", "toxic"))
    sets = labels.select(
        F.concat(F.lit("Category:Doc  "), F.col("doc_id").cast("string"), F.lit(" (q"), q,
                 F.lit(")")).alias("title"),
        F.lit(14).alias("ns"), (F.lit(4 << 40) + F.col("doc_id")).alias("id"),
        none.alias("redirect_title"),
        F.concat(F.lit("intro [[Category:Quality ("), q, F.lit(")|x]][[Category:U.S. toxic "), t,
                 F.lit("]]")).alias("text"))
    return (articles.unionByName(cats).unionByName(redirects).unionByName(templates)
            .unionByName(sets))


WIKI_PAGES_SQL = f"""SELECT concat('Doc  ', CAST(doc_id AS VARCHAR)) AS title, 0 AS ns,
  doc_id AS id, CAST(NULL AS VARCHAR) AS redirect_title,
  concat(text, chr(10), '[[Category:', source, '|', lang, ']]', chr(10),
         '[[Category:  Lang   ', lang, ' (x) ]][[Category:U.S. ', source, ']]') AS text
  FROM documents
UNION ALL SELECT concat('Category:Lang  ', lang, ' (x)'), 14,
  {1 << 40} + row_number() OVER (ORDER BY lang), CAST(NULL AS VARCHAR),
  'intro [[Category:Languages (all)|x]][[Category:U.S. folks]][[Category:All]]'
  FROM (SELECT DISTINCT lang FROM documents)
UNION ALL SELECT concat('Src ', source), 0, {2 << 40} + row_number() OVER (ORDER BY source),
  concat('Category:', source), '#REDIRECT [[Category:X]]' FROM (SELECT DISTINCT source FROM documents)
UNION ALL SELECT concat('Template:', source), 10, {3 << 40} + row_number() OVER (ORDER BY source),
  CAST(NULL AS VARCHAR), '[[Category:T]]' FROM (SELECT DISTINCT source FROM documents)
UNION ALL SELECT concat('Category:Doc  ', CAST(doc_id AS VARCHAR), ' (q', CAST(quality AS VARCHAR),
  ')'), 14, {4 << 40} + doc_id, CAST(NULL AS VARCHAR), concat('intro [[Category:Quality (',
  CAST(quality AS VARCHAR), ')|x]][[Category:U.S. toxic ', CAST(toxic AS VARCHAR), ']]')
  FROM labels"""
