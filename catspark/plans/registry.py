"""Registered queries: one Spark plan and (where expressible) one DuckDB SQL
twin per operator key of the survey's inventory.

Spark callables take (spark, sf_dir) and return a DataFrame with every float
rounded to 6 digits; SQL twins use the driver's pre-registered views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify as K
from ..operators import evaluate as E
from ..operators import index as I
from ..operators import sentences as S
from . import oracle as O
from .pipeline import Pipeline, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


CORPUS = O.BASE + S.sentence_ctes()


def _p(spark, sf_dir, **kw) -> Pipeline:
    return Pipeline(spark, sf_dir, **kw)


# ---------------------------------------------------------------------------
# Text -> index
# ---------------------------------------------------------------------------

@register("tokens", O.render(O.INDEX, "SELECT title, token FROM toks"))
def q_tokens(spark, sf_dir):
    return I.tokens(_p(spark, sf_dir).cat.texts)


@register("alpha_tokens", O.render(
    O.INDEX, f"SELECT title, token FROM toks WHERE regexp_matches(token, "
             f"{O.T.sql_literal(O.T.WORD_PATTERN)})"))
def q_alpha_tokens(spark, sf_dir):
    return I.alpha_tokens(I.tokens(_p(spark, sf_dir).cat.texts))


@register("content_tokens", O.render(O.INDEX, "SELECT title, token FROM ctoks"))
def q_content_tokens(spark, sf_dir):
    return I.content_tokens(I.tokens(_p(spark, sf_dir).cat.texts))


@register("abbreviations", O.render(CORPUS, f"SELECT type, n_with, n_without, {O.r6('score')} "
                                            "FROM abbrs"))
def q_abbreviations(spark, sf_dir):
    """Abbreviations that the corpus itself shows."""
    return S.abbreviations(S.words(_p(spark, sf_dir).cat.texts))


@register("sentence_starters", O.render(CORPUS, f"SELECT type, n, n_first, {O.r6('ratio')} "
                                                "FROM starts"))
def q_sentence_starters(spark, sf_dir):
    found = S.counted_words(_p(spark, sf_dir).cat.texts)
    return S.sentence_starters(found, S.abbreviations(found))


@register("sentence_tokens", O.render(CORPUS, "SELECT title, token FROM s_toks"))
def q_sentence_tokens(spark, sf_dir):
    """T1 where abbreviations keep their period."""
    return S.sentence_tokens(_p(spark, sf_dir).cat.texts)


@register("stems", O.render(O.INDEX, "SELECT token, word FROM stems"))
def q_stems(spark, sf_dir):
    return I.stems(I.content_tokens(I.tokens(_p(spark, sf_dir).cat.texts)))


@register("term_counts", O.render(O.INDEX, "SELECT title, word, n FROM counts"))
def q_term_counts(spark, sf_dir):
    return _p(spark, sf_dir).index.counts


@register("tf", O.render(O.INDEX, f"SELECT word, title, {O.r6('tf')} FROM postings"))
def q_tf(spark, sf_dir):
    return _p(spark, sf_dir).index.postings


@register("document_frequency", O.render(O.INDEX, "SELECT word, df FROM vocab"))
def q_df(spark, sf_dir):
    return _p(spark, sf_dir).index.vocab.select("word", "df")


@register("idf", O.render(O.INDEX, f"SELECT word, df, {O.r6('idf')} FROM vocab"))
def q_idf(spark, sf_dir):
    return _p(spark, sf_dir).index.vocab


@register("inverted_index", O.render(
    O.INDEX, f"SELECT word, {O.r6('idf')}, title, {O.r6('tf')} FROM postings "
             "JOIN vocab USING (word)"))
def q_inverted_index(spark, sf_dir):
    idx = _p(spark, sf_dir).index
    return I.inverted_index(idx.postings, idx.vocab).select("word", "idf", "title", "tf")


@register("page_vectors", O.render(O.INDEX, f"SELECT title, word, {O.r6('weight')} "
                                             "FROM vectors"))
def q_page_vectors(spark, sf_dir):
    return _p(spark, sf_dir).vectors


@register("term_ids", O.render(O.INDEX, "SELECT word, CAST(row_number() OVER (ORDER BY word) "
                                         "AS BIGINT) AS term_id FROM vocab"))
def q_term_ids(spark, sf_dir):
    return I.term_ids(_p(spark, sf_dir).index.vocab)


# ---------------------------------------------------------------------------
# Centroids, scores, recommendations, measures
# ---------------------------------------------------------------------------

@register("centroids", O.render(O.INDEX + O.centroid_ctes(5, holdout=False),
                                f"SELECT cat_name, word, {O.r6('weight')} FROM centroids"))
def q_centroids(spark, sf_dir):
    p = _p(spark, sf_dir)
    return K.centroids(p.vectors, p.cat.catpage, 5)


@register("centroids_holdout", O.render(O.INDEX + O.HOLDOUT + O.centroid_ctes(5, True),
                                        f"SELECT cat_name, word, {O.r6('weight')} "
                                        "FROM centroids"))
def q_centroids_holdout(spark, sf_dir):
    return _p(spark, sf_dir).centroids


@register("holdout_split", O.render(O.BASE + O.HOLDOUT, "SELECT title FROM holdout"))
def q_holdout(spark, sf_dir):
    return _p(spark, sf_dir).holdout


@register("category_scores", O.render(O.RECOMMEND, f"SELECT title, cat_name, "
                                                    f"{O.r6('score')} FROM scores"))
def q_scores(spark, sf_dir):
    p = _p(spark, sf_dir)
    return K.category_scores(p.vectors.join(p.holdout, "title", "left_semi"), p.centroids)


@register("recommendations", O.render(O.RECOMMEND, f"SELECT title, CAST(rank AS INTEGER) "
                                                    f"AS rank, cat_name, {O.r6('score')} "
                                                    "FROM recs"))
def q_recommendations(spark, sf_dir):
    return _p(spark, sf_dir).recs


RECOMMEND_N = [(name, sql.replace("SELECT count(*) FROM cent_cats", "3").replace(
    "least(count(*), (3))", "3")) for name, sql in O.RECOMMEND]


@register("recommend_n", O.render(RECOMMEND_N, "SELECT title, CAST(rank AS INTEGER) AS rank, "
                                               f"cat_name, {O.r6('score')} FROM recs"))
def q_recommend_n(spark, sf_dir):
    """K5 with a given n: three categories for every held-out page."""
    p = _p(spark, sf_dir)
    recs, _ = K.recommend(p.vectors, p.holdout, p.cat.catpage, p.centroids, p.cent_cats, n=3)
    return recs


@register("suggestion_counts", O.render(O.RECOMMEND, "SELECT title, n_actual, n FROM counts_n"))
def q_suggestion_counts(spark, sf_dir):
    return _p(spark, sf_dir).counts


@register("boolean_measure", O.render(O.RECOMMEND, "SELECT title, boolean FROM measures"))
def q_boolean(spark, sf_dir):
    return _p(spark, sf_dir).measures.select("title", "boolean")


@register("fractional_measure", O.render(O.RECOMMEND, f"SELECT title, {O.r6('fractional')} "
                                                       "FROM measures"))
def q_fractional(spark, sf_dir):
    return _p(spark, sf_dir).measures.select("title", "fractional")


@register("hierarchical_measure", O.render(O.RECOMMEND, f"SELECT title, "
                                                         f"{O.r6('hierarchical')} "
                                                         "FROM measures"))
def q_hierarchical(spark, sf_dir):
    return _p(spark, sf_dir).measures.select("title", "hierarchical")


@register("hierarchical_as_written", O.render(
    O.RECOMMEND, f"SELECT title, {O.r6('hierarchical_as_written')} FROM measures"))
def q_hierarchical_as_written(spark, sf_dir):
    return _p(spark, sf_dir).measures.select("title", "hierarchical_as_written")


@register("recommendation_report", O.render(
    O.RECOMMEND,
    "SELECT m.title, a.actual, s.suggested, (m.fractional <> 0) AS success, m.boolean, "
    f"{O.r6('m.fractional', 'fractional')}, {O.r6('m.hierarchical', 'hierarchical')} "
    "FROM measures m JOIN (SELECT title, array_to_string(list_sort(list(actual)), ', ') "
    "AS actual FROM actual GROUP BY title) a USING (title) JOIN (SELECT title, "
    "array_to_string(list_sort(list(cat_name)), ', ') AS suggested FROM recs "
    "GROUP BY title) s USING (title)"))
def q_report(spark, sf_dir):
    p = _p(spark, sf_dir)
    return K.recommendation_report(p.recs, p.cat.catpage, p.measures)


EVAL_SQL = O.render(
    O.RECOMMEND,
    "SELECT count(*) AS n_pages, CAST(sum(boolean) AS BIGINT) AS n_success, "
    f"{O.r6('avg(boolean)', 'mean_boolean')}, {O.r6('avg(fractional)', 'mean_fractional')}, "
    f"{O.r6('avg(hierarchical)', 'mean_hierarchical')}, "
    f"{O.r6('avg(hierarchical_as_written)', 'mean_hierarchical_as_written')}, "
    f"{O.r6('stddev_pop(fractional)', 'std_fractional')} FROM measures")


@register("evaluation", EVAL_SQL)
def q_evaluation(spark, sf_dir):
    return _p(spark, sf_dir).summary()


# ---------------------------------------------------------------------------
# Catalogue
# ---------------------------------------------------------------------------

from ..operators import catalog as C  # noqa: E402

CAT = O.BASE


def _cat(spark, sf_dir):
    return _p(spark, sf_dir).cat


@register("scan_pages", O.render(CAT, "SELECT title FROM page_titles"))
def q_scan_pages(spark, sf_dir):
    return C.scan(_cat(spark, sf_dir).pages, "pages")


@register("scan_categories", O.render(CAT, "SELECT name FROM categories"))
def q_scan_categories(spark, sf_dir):
    return C.scan(_cat(spark, sf_dir).categories, "categories")


@register("scan_catpage", O.render(CAT, "SELECT cat_name, pag_title FROM catpage"))
def q_scan_catpage(spark, sf_dir):
    return C.scan(_cat(spark, sf_dir).catpage, "catpage")


@register("scan_catsub", O.render(CAT, "SELECT cat_name, cat_name_sub FROM catsub"))
def q_scan_catsub(spark, sf_dir):
    return C.scan(_cat(spark, sf_dir).catsub, "catsub")


#: kind -> (binding in SQL, columns): pages 2 and on of each table, in key order
PAGED = {"pages": ("page_titles", "title"), "categories": ("categories", "name"),
         "catpage": ("catpage", "pag_title, cat_name"),
         "catsub": ("catsub", "cat_name_sub, cat_name")}


def _register_paged(kind: str, binding: str, order: str):
    @register(f"scan_{kind}_paged", O.render(
        CAT, f"SELECT * FROM {binding} ORDER BY {order} LIMIT 40 OFFSET 25"))
    def paged(spark, sf_dir):
        """Rows 26 to 65 in key order."""
        return C.scan(getattr(_cat(spark, sf_dir), kind), kind, nrows=40, offset=25)


for _kind, (_binding, _order) in PAGED.items():
    _register_paged(_kind, _binding, _order)


@register("n_categories", O.render(CAT, "SELECT count(*) AS n FROM categories"))
def q_n_categories(spark, sf_dir):
    return C.row_count(_cat(spark, sf_dir).categories)


@register("n_pages", O.render(CAT, "SELECT count(*) AS n FROM page_titles"))
def q_n_pages(spark, sf_dir):
    return C.row_count(_cat(spark, sf_dir).pages)


ASKED_TITLES_SQL = ("SELECT DISTINCT CAST(item_id AS VARCHAR) AS title FROM benchmark UNION "
                    "SELECT DISTINCT CAST(conv_id AS VARCHAR) FROM conversations")


def _asked_titles(spark, sf_dir):
    from ..sources.tables import read_table
    b = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("title"))
    c = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("title"))
    return b.union(c).distinct()


@register("is_in_pages", O.render(
    CAT + [("asked", ASKED_TITLES_SQL)],
    "SELECT a.title, (p.title IS NOT NULL) AS found FROM asked a "
    "LEFT JOIN page_titles p ON p.title = a.title"))
def q_is_in_pages(spark, sf_dir):
    return C.is_in_pages(_asked_titles(spark, sf_dir), _cat(spark, sf_dir).pages)


@register("top_categories", O.render(
    CAT, "SELECT DISTINCT cat_name FROM catsub WHERE cat_name NOT IN "
         "(SELECT cat_name_sub FROM catsub)"))
def q_top_categories(spark, sf_dir):
    return C.top_categories(_cat(spark, sf_dir).catsub)


@register("top_categories_paged", O.render(
    CAT, "SELECT DISTINCT cat_name FROM catsub WHERE cat_name NOT IN "
         "(SELECT cat_name_sub FROM catsub) ORDER BY cat_name LIMIT 10 OFFSET 5"))
def q_top_categories_paged(spark, sf_dir):
    return C.top_categories(_cat(spark, sf_dir).catsub, nrows=10, offset=5)


@register("biggest_categories", O.render(
    CAT, "SELECT cat_name, count(*) AS c FROM catpage WHERE cat_name NOT ILIKE '%birth%' "
         "AND cat_name NOT ILIKE '%death%' AND cat_name NOT IN (SELECT cat_name FROM catsub) "
         "GROUP BY cat_name HAVING count(*) >= 5"))
def q_biggest(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return C.biggest_categories(c.catpage, c.catsub, 5)


@register("avg_categories_per_page", O.render(
    CAT, f"SELECT {O.r6('avg(c)', 'avg_categories')} FROM (SELECT pag_title, count(*) AS c "
         "FROM catpage GROUP BY pag_title)"))
def q_avg_cats(spark, sf_dir):
    return C.avg_categories_per_page(_cat(spark, sf_dir).catpage)


@register("pages_of_category", O.render(
    CAT, "SELECT cat_name, pag_title FROM catpage WHERE cat_name IN "
         "(SELECT cat_name_sub FROM catsub WHERE cat_name = 'languages')"))
def q_pages_of_category(spark, sf_dir):
    c = _cat(spark, sf_dir)
    asked = c.catsub.where(F.col("cat_name") == "languages").select(
        F.col("cat_name_sub").alias("cat_name"))
    return C.pages_of_category(c.catpage, asked)


@register("categories_of_page", O.render(
    CAT + O.HOLDOUT, "SELECT pag_title, cat_name FROM catpage WHERE pag_title IN "
                     "(SELECT title FROM holdout)"))
def q_categories_of_page(spark, sf_dir):
    p = _p(spark, sf_dir)
    return C.categories_of_page(p.cat.catpage, p.holdout)


@register("category_sizes", O.render(
    CAT, "SELECT cat_name, count(*) AS c FROM catpage GROUP BY cat_name HAVING count(*) >= 1"))
def q_category_sizes(spark, sf_dir):
    return C.category_sizes_at_least(_cat(spark, sf_dir).catpage, 1)


@register("categories_by_page", O.render(
    CAT, "SELECT pag_title, array_to_string(list_sort(list(DISTINCT cat_name)), ' | ') "
         "AS categories_text FROM catpage WHERE pag_title IN (SELECT pag_title FROM catpage "
         "WHERE cat_name IN (SELECT cat_name FROM catpage GROUP BY cat_name "
         "HAVING count(*) >= 50)) GROUP BY pag_title"))
def q_categories_by_page(spark, sf_dir):
    return C.categories_by_page(_cat(spark, sf_dir).catpage, 50).select(
        "pag_title", "categories_text")


@register("small_categories", O.render(
    CAT, "SELECT cat_name FROM catpage GROUP BY cat_name HAVING count(*) < 5"))
def q_small_categories(spark, sf_dir):
    return C.small_categories(_cat(spark, sf_dir).catpage, 5)


def _miss_pairs(spark, sf_dir):
    """(cat_a = actual category, cat_b = missed suggestion) of the hold-out
    pages: the pairs the hierarchical measure asks about."""
    p = _p(spark, sf_dir)
    actual = p.cat.catpage.select(F.col("pag_title").alias("title"),
                                  F.col("cat_name").alias("cat_a"))
    misses = p.recs.join(p.cat.catpage.select(F.col("pag_title").alias("title"), "cat_name"),
                         ["title", "cat_name"], "left_anti")
    return (misses.select("title", F.col("cat_name").alias("cat_b")).join(actual, "title")
            .select("cat_a", "cat_b").distinct()), p


MISS_PAIRS = O.RECOMMEND + [("miss_pairs", "SELECT DISTINCT cat_a, cat_b FROM pairs")]


@register("father_son", O.render(
    MISS_PAIRS, "SELECT cat_a, cat_b FROM miss_pairs n WHERE EXISTS (SELECT 1 FROM "
                "catsub s WHERE (s.cat_name = n.cat_a AND s.cat_name_sub = n.cat_b) OR "
                "(s.cat_name = n.cat_b AND s.cat_name_sub = n.cat_a))"))
def q_father_son(spark, sf_dir):
    pairs, p = _miss_pairs(spark, sf_dir)
    return C.father_son(pairs, p.cat.catsub)


@register("brothers", O.render(
    MISS_PAIRS, "SELECT cat_a, cat_b FROM miss_pairs n WHERE n.cat_a <> n.cat_b AND "
                "EXISTS (SELECT 1 FROM catsub s1 JOIN catsub s2 ON s1.cat_name = "
                "s2.cat_name WHERE s1.cat_name_sub = n.cat_a AND "
                "s2.cat_name_sub = n.cat_b)"))
def q_brothers(spark, sf_dir):
    pairs, p = _miss_pairs(spark, sf_dir)
    return C.brothers(pairs, p.cat.catsub)


# The stored half of each table (even page titles, child names by hash) and the
# incoming other half plus a part of the stored one; together they cover every row.
SPLIT = [
    ("old_cp", "SELECT * FROM catpage WHERE CAST(pag_title AS BIGINT) % 2 = 0"),
    ("new_cp", "SELECT * FROM catpage WHERE CAST(pag_title AS BIGINT) % 2 = 1 "
               "OR CAST(pag_title AS BIGINT) % 6 = 0"),
    ("old_cs", "SELECT * FROM catsub WHERE substr(md5(cat_name_sub), 1, 1) < '8'"),
    ("new_cs", "SELECT * FROM catsub WHERE substr(md5(cat_name_sub), 1, 1) >= '8' "
               "OR substr(md5(cat_name_sub), 1, 1) < '2' "
               "UNION ALL SELECT 'languages', 'languages'"),
    ("old_cats", "SELECT cat_name AS name FROM old_cp UNION SELECT cat_name FROM old_cs "
                 "UNION SELECT cat_name_sub FROM old_cs"),
    ("new_cats", "SELECT cat_name AS name FROM new_cp UNION SELECT cat_name FROM new_cs "
                 "UNION SELECT cat_name_sub FROM new_cs"),
    ("old_pages", "SELECT DISTINCT pag_title AS title FROM old_cp"),
    ("new_pages", "SELECT pag_title AS title FROM new_cp"),
]


def _split_tables(spark, sf_dir):
    """(stored, incoming) tables by kind; incoming pages repeat, incoming edges hold a loop."""
    from ..sources.tables import categories
    c = _cat(spark, sf_dir)
    n = F.col("pag_title").cast("long")
    h = F.substring(F.md5("cat_name_sub"), 1, 1)
    loop = spark.range(1).select(F.lit("languages").alias("cat_name"),
                                 F.lit("languages").alias("cat_name_sub"))
    old_cp, new_cp = c.catpage.where(n % 2 == 0), c.catpage.where((n % 2 == 1) | (n % 6 == 0))
    old_cs, new_cs = c.catsub.where(h < "8"), c.catsub.where((h >= "8") | (h < "2")).union(loop)
    titles = lambda cp: cp.select(F.col("pag_title").alias("title"))
    return ({"pages": titles(old_cp).distinct(), "categories": categories(old_cp, old_cs),
             "catpage": old_cp, "catsub": old_cs},
            {"pages": titles(new_cp), "categories": categories(new_cp, new_cs),
             "catpage": new_cp, "catsub": new_cs})


@register("bulk_upsert", O.render(
    CAT + SPLIT, "SELECT cat_name, pag_title FROM old_cp UNION SELECT cat_name, pag_title "
                 "FROM new_cp"))
def q_bulk_upsert(spark, sf_dir):
    old, new = _split_tables(spark, sf_dir)
    return C.bulk_upsert(old["catpage"], new["catpage"], ["cat_name", "pag_title"])


@register("bulk_load", O.render(
    CAT + SPLIT,
    "SELECT 'pages' AS kind, title AS key1, CAST(NULL AS VARCHAR) AS key2 FROM old_pages UNION "
    "SELECT 'pages', title, NULL FROM new_pages UNION SELECT 'categories', name, NULL FROM old_cats "
    "UNION SELECT 'categories', name, NULL FROM new_cats UNION SELECT 'catpage', pag_title, cat_name "
    "FROM old_cp UNION SELECT 'catpage', pag_title, cat_name FROM new_cp UNION SELECT 'catsub', "
    "cat_name_sub, cat_name FROM old_cs UNION SELECT 'catsub', cat_name_sub, cat_name FROM new_cs "
    "WHERE cat_name <> cat_name_sub"))
def q_bulk_load(spark, sf_dir):
    """C1 over the four tables; the loop among the incoming edges is ignored."""
    from functools import reduce
    loaded = C.bulk_load(*_split_tables(spark, sf_dir))
    none = F.lit(None).cast("string")
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(kind).alias("kind"), F.col(C.SCAN_ORDER[kind][0]).alias("key1"),
                  (F.col(C.SCAN_ORDER[kind][1]) if len(C.SCAN_ORDER[kind]) > 1 else none)
                  .alias("key2")) for kind, df in loaded.items()])


@register("insert_conflicts", O.render(
    CAT + SPLIT, "SELECT DISTINCT title, 'exists' AS reason FROM new_pages WHERE title IN "
                 "(SELECT title FROM old_pages) UNION ALL SELECT title, 'duplicate' FROM "
                 "new_pages GROUP BY title HAVING count(*) > 1"))
def q_insert_conflicts(spark, sf_dir):
    old, new = _split_tables(spark, sf_dir)
    return C.insert_conflicts(old["pages"], new["pages"], ["title"])


@register("append_catpage", O.render(
    CAT + SPLIT,
    "SELECT 'categories' AS \"table\", name AS key1, CAST(NULL AS VARCHAR) AS key2 FROM "
    "(SELECT DISTINCT cat_name AS name FROM new_cp) WHERE name NOT IN "
    "(SELECT name FROM old_cats) UNION ALL SELECT 'catpage', cat_name, pag_title FROM "
    "new_cp n WHERE NOT EXISTS (SELECT 1 FROM "
    "old_cp b WHERE b.cat_name = n.cat_name AND b.pag_title = n.pag_title)"))
def q_append_catpage(spark, sf_dir):
    old, new = _split_tables(spark, sf_dir)
    return C.append_catpage(old["categories"], old["catpage"], new["catpage"])


BAD_EDGES = [("bad_edges", "SELECT cat_name, cat_name_sub FROM new_cs WHERE cat_name = "
                           "cat_name_sub UNION SELECT n.cat_name, n.cat_name_sub FROM new_cs n "
                           "JOIN old_cs o ON o.cat_name = n.cat_name AND "
                           "o.cat_name_sub = n.cat_name_sub")]


@register("append_catsub", O.render(
    CAT + SPLIT + BAD_EDGES,
    "SELECT 'categories' AS \"table\", name AS key1, CAST(NULL AS VARCHAR) AS key2 FROM "
    "(SELECT cat_name AS name FROM new_cs UNION SELECT cat_name_sub FROM new_cs) "
    "WHERE name NOT IN (SELECT name FROM old_cats) "
    "UNION ALL SELECT 'catsub', cat_name, cat_name_sub FROM (SELECT DISTINCT * FROM new_cs) "
    "n WHERE NOT EXISTS (SELECT 1 FROM bad_edges b WHERE b.cat_name = n.cat_name AND "
    "b.cat_name_sub = n.cat_name_sub) "
    "UNION ALL SELECT 'error', cat_name, cat_name_sub FROM bad_edges"))
def q_append_catsub(spark, sf_dir):
    old, new = _split_tables(spark, sf_dir)
    return C.append_catsub(old["categories"], old["catsub"], new["catsub"])


CHECK = [
    ("cp_faulty", "SELECT cat_name, pag_title FROM catpage UNION ALL SELECT 'lang_en', '-1'"),
    ("cs_faulty", "SELECT cat_name, cat_name_sub FROM catsub UNION ALL "
                  "SELECT 'languages', 'languages'"),
]


def _violation(rule, sql):
    return f"SELECT '{rule}' AS rule, count(*) AS n FROM ({sql})"


@register("check_constraints", O.render(CAT + CHECK, " UNION ALL ".join([
    _violation("pk_pages", "SELECT title FROM page_titles GROUP BY title HAVING count(*) > 1"),
    _violation("pk_categories", "SELECT name FROM categories GROUP BY name HAVING count(*) > 1"),
    _violation("pk_catpage", "SELECT cat_name, pag_title FROM cp_faulty GROUP BY ALL "
                             "HAVING count(*) > 1"),
    _violation("pk_catsub", "SELECT cat_name, cat_name_sub FROM cs_faulty GROUP BY ALL "
                            "HAVING count(*) > 1"),
    _violation("fk_catpage_page", "SELECT pag_title FROM cp_faulty WHERE pag_title NOT IN "
                                  "(SELECT title FROM page_titles)"),
    _violation("fk_catpage_category", "SELECT cat_name FROM cp_faulty WHERE cat_name NOT IN "
                                      "(SELECT name FROM categories)"),
    _violation("fk_catsub_parent", "SELECT cat_name FROM cs_faulty WHERE cat_name NOT IN "
                                   "(SELECT name FROM categories)"),
    _violation("fk_catsub_child", "SELECT cat_name_sub FROM cs_faulty WHERE cat_name_sub "
                                  "NOT IN (SELECT name FROM categories)"),
    _violation("check_self_loop", "SELECT * FROM cs_faulty WHERE cat_name = cat_name_sub"),
])))
def q_check_constraints(spark, sf_dir):
    c = _cat(spark, sf_dir)
    one = c.spark.range(1)
    cp = c.catpage.union(one.select(F.lit("lang_en").alias("cat_name"),
                                    F.lit("-1").alias("pag_title")))
    cs = c.catsub.union(one.select(F.lit("languages").alias("cat_name"),
                                   F.lit("languages").alias("cat_name_sub")))
    return C.check_constraints(c.pages, c.categories, cp, cs)


# ---------------------------------------------------------------------------
# Dump ingest
# ---------------------------------------------------------------------------

from ..operators import ingest as G  # noqa: E402
from ..session import materialise, scratch_path  # noqa: E402
from ..sources import dump as D  # noqa: E402
from ..sources.tables import WIKI_PAGES_SQL, wiki_pages  # noqa: E402


def _dump(spark, sf_dir):
    """Pages written as an XML dump under the shared folder and scanned back."""
    path = D.write_dump(wiki_pages(spark, sf_dir), scratch_path(spark, "dump"))
    return D.read_dump(spark, path)


def _split(spark, sf_dir):
    return G.split_body(G.valid_pages(_dump(spark, sf_dir)))


N = O.T.norm_name_sql
@register("dump_pages_prefixed", f"SELECT title, ns, id, text, redirect_title FROM "
                                 f"({WIKI_PAGES_SQL}) w")
def q_dump_pages_prefixed(spark, sf_dir):
    """A dump whose element names carry a namespace prefix."""
    path = D.write_dump(wiki_pages(spark, sf_dir), scratch_path(spark, "dump"), prefix="mw")
    return D.read_dump(spark, path, prefix="mw").select(
        "title", "ns", "id", "text", F.col("redirect._title").alias("redirect_title"))


INGEST = [
    ("wiki", WIKI_PAGES_SQL),
    ("valid", f"SELECT {N('title')} AS title, ns, id, CASE WHEN ns = 14 THEN 'category' "
              "ELSE 'article' END AS kind, text FROM wiki WHERE ns IN (0, 14) "
              "AND redirect_title IS NULL"),
    ("split", "SELECT id, title, kind, substr(text, 1, instr(text, '[[Category:') - 1) AS body, "
              "substr(text, instr(text, '[[Category:')) AS cat_text FROM valid "
              "WHERE text IS NOT NULL AND instr(text, '[[Category:') > 0"),
    ("x_catpage", f"SELECT DISTINCT {N('raw')} AS cat_name, pag_title FROM (SELECT unnest("
                  f"{O.T.category_links_sql('cat_text')}) AS raw, title AS pag_title "
                  "FROM split WHERE kind = 'article')"),
    ("x_catsub", f"SELECT DISTINCT {N('raw')} AS cat_name, cat_name_sub FROM (SELECT unnest("
                 f"{O.T.category_links_sql('cat_text')}) AS raw, {N('substr(title, 10)')} "
                 "AS cat_name_sub FROM split WHERE kind = 'category')"),
    ("x_catsub_t", f"SELECT DISTINCT {N('raw')} AS cat_name, cat_name_sub FROM (SELECT unnest("
                   f"{O.T.category_links_sql('cat_text', True)}) AS raw, "
                   f"{N('substr(title, 10)')} AS cat_name_sub FROM split "
                   "WHERE kind = 'category')"),
]


@register("dump_pages", O.render(INGEST, "SELECT title, ns, id, text, redirect_title FROM wiki"))
def q_dump_pages(spark, sf_dir):
    return _dump(spark, sf_dir).select("title", "ns", "id", "text",
                                       F.col("redirect._title").alias("redirect_title"))


@register("valid_pages", O.render(INGEST, "SELECT title, ns, id, kind FROM valid"))
def q_valid_pages(spark, sf_dir):
    return G.valid_pages(_dump(spark, sf_dir)).select("title", "ns", "id", "kind")


@register("split_body", O.render(INGEST, "SELECT id, title, kind, body, cat_text FROM split"))
def q_split_body(spark, sf_dir):
    return _split(spark, sf_dir)


@register("norm_name", O.render(INGEST, f"SELECT id, {N('title')} AS name FROM wiki"))
def q_norm_name(spark, sf_dir):
    return wiki_pages(spark, sf_dir).select("id", O.T.norm_name(F.col("title")).alias("name"))


@register("extract_catpage", O.render(INGEST, "SELECT cat_name, pag_title FROM x_catpage"))
def q_extract_catpage(spark, sf_dir):
    return G.extract_catpage(_split(spark, sf_dir))


@register("extract_catsub", O.render(INGEST, "SELECT cat_name, cat_name_sub FROM x_catsub"))
def q_extract_catsub(spark, sf_dir):
    return G.extract_catsub(_split(spark, sf_dir))


@register("extract_catsub_truncated", O.render(INGEST, "SELECT cat_name, cat_name_sub "
                                                       "FROM x_catsub_t"))
def q_extract_catsub_truncated(spark, sf_dir):
    return G.extract_catsub(_split(spark, sf_dir), truncate=True)


@register("plain_text", O.render(INGEST, f"SELECT title, {O.T.plain_text_sql('body')} AS text "
                                         "FROM split WHERE kind = 'article'"))
def q_plain_text(spark, sf_dir):
    return G.plain_texts(_split(spark, sf_dir))


@register("plain_text_html", f"SELECT page_id, {O.T.plain_text_sql('html')} AS text FROM pages")
def q_plain_text_html(spark, sf_dir):
    from ..sources.tables import read_table
    return read_table(spark, sf_dir, "pages").select(
        "page_id", O.T.plain_text(F.col("html")).alias("text"))


NESTED = ("concat('{{box|{| ', source, ' [[x|', lang, ']] |}}} [[File:', lang, '|{{q|{| a |}}}', "
          "body, ' [[', source, '|', lang, ']]]] {{open [[tail ', source)")


@register("plain_text_nested", "SELECT doc_id, " + O.T.apply_rules_sql(
    "concat(' ', regexp_replace(text, '[^A-Za-z \n]', '', 'g'), ' ', lang, ' {{open [[tail ', source)",
    [O.T.TRIM_RULE]) + " AS text FROM documents WHERE text IS NOT NULL")
def q_plain_text_nested(spark, sf_dir):
    """P9 where templates, tables and links hold each other and marks stay open."""
    from ..sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents").where("text IS NOT NULL").withColumn(
        "body", F.regexp_replace("text", "[^A-Za-z \n]", ""))
    return docs.select("doc_id", O.T.plain_text(F.expr(NESTED)).alias("text"))


@register("limit_pages", O.render(INGEST, "SELECT title, ns, id, kind FROM valid "
                                         "ORDER BY id LIMIT 150"))
def q_limit_pages(spark, sf_dir):
    return G.limit_pages(_dump(spark, sf_dir), 150).select("title", "ns", "id", "kind")


@register("ingest_stats", O.render(
    INGEST, "SELECT count(*) AS total_pages, count(*) FILTER (WHERE ns IN (0, 14) AND "
            "redirect_title IS NULL) AS valid_pages, CAST(0 AS BIGINT) AS malformed_pages "
            "FROM wiki"))
def q_ingest_stats(spark, sf_dir):
    return G.ingest_stats(_dump(spark, sf_dir))


@register("ingest_stats_malformed", O.render(
    INGEST, "SELECT (SELECT count(*) FROM wiki) + (SELECT count(*) FROM labels) AS total_pages, "
            "(SELECT count(*) FROM valid) AS valid_pages, "
            "(SELECT count(*) FROM labels) AS malformed_pages"))
def q_ingest_stats_malformed(spark, sf_dir):
    """P11 over a dump that also holds a broken page for every labelled document."""
    path = D.write_dump(wiki_pages(spark, sf_dir), scratch_path(spark, "dump"))
    labels = read_table(spark, sf_dir, "labels")
    labels.select(F.concat(F.lit("  <page>\n    <title>Broken "), F.col("doc_id").cast("string"),
                           F.lit("</ns>\n  </page>")).alias("value")).write.mode("append").text(path)
    return G.ingest_stats(D.read_dump(spark, path))


@register("derive_pages", O.render(INGEST, "SELECT DISTINCT title FROM split "
                                           "WHERE kind = 'article'"))
def q_derive_pages(spark, sf_dir):
    return G.derive_pages(_split(spark, sf_dir))


@register("derive_categories", O.render(
    INGEST, "SELECT cat_name AS name FROM x_catpage UNION SELECT cat_name FROM x_catsub "
            f"UNION SELECT {N('substr(title, 10)')} FROM split WHERE kind = 'category'"))
def q_derive_categories(spark, sf_dir):
    return G.derive_categories(_split(spark, sf_dir))


# ---------------------------------------------------------------------------
# Text completion (T6-T9, S2-S4), vectors (V3-V7), unseen texts
# ---------------------------------------------------------------------------

from ..operators import similarity as V  # noqa: E402
from ..sources import artefacts as A  # noqa: E402
from ..sources import textdir as TD  # noqa: E402
from ..sources.tables import read_table  # noqa: E402


@register("freq_dist", O.render(
    O.INDEX, "SELECT title, to_json(map_from_entries(list_sort(list({'word': word, 'n': n}))))"
             "::VARCHAR AS freq_json FROM counts GROUP BY title"))
def q_freq_dist(spark, sf_dir):
    """T6; the map is compared as its JSON text."""
    fd = I.freq_dist(_p(spark, sf_dir).index.counts)
    return fd.select("title", F.to_json("freq").alias("freq_json"))


@register("dedupe_documents", O.render(
    CAT, "SELECT title, doc_id, text FROM (SELECT source AS title, doc_id, text, "
         "row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn FROM documents) "
         "WHERE rn = 1"))
def q_dedupe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("source").alias("title"), "doc_id", "text")
    return I.dedupe_documents(docs, "title", "doc_id")


REPLACED = [("texts", "SELECT CAST(doc_id AS VARCHAR) AS title, CASE WHEN doc_id % 20 = 0 THEN "
                      "concat(text, ' ', source, ' replaced') WHEN doc_id % 10 = 0 THEN "
                      "concat('only ', lang, ' is left') ELSE text END AS text FROM documents")]
REPLACED += [c for c in O.INDEX if c[0] != "texts"]


def _replaced(spark, sf_dir):
    """A store that got every document, and then every tenth a second time with another text."""
    from ..operators.store import DocumentStore
    docs = read_table(spark, sf_dir, "documents").withColumn("title", F.col("doc_id").cast("string"))
    store = DocumentStore(spark, scratch_path(spark, "store"))
    store.put(docs.select("title", "text"), 0)
    longer = F.concat("text", F.lit(" "), "source", F.lit(" replaced"))
    short = F.concat(F.lit("only "), "lang", F.lit(" is left"))
    store.put(docs.where("doc_id % 10 = 0").select(
        "title", F.when(F.col("doc_id") % 20 == 0, longer).otherwise(short).alias("text")), 1)
    return store


@register("replaced_documents", O.render(REPLACED, "SELECT title, word, n FROM counts"))
def q_replaced_documents(spark, sf_dir):
    """Counts after a tenth of the titles was sent twice, equal to a rebuild."""
    return _replaced(spark, sf_dir).counts()


@register("replaced_vocab", O.render(REPLACED, f"SELECT word, df, {O.r6('idf')} FROM vocab"))
def q_replaced_vocab(spark, sf_dir):
    """I2/I3 of the same store, from signed document frequencies."""
    return _replaced(spark, sf_dir).vocab()


def _text_dir_lines(spark, sf_dir):
    """Documents written as containers (many a file) and read back line by line."""
    path = TD.write_containers(_p(spark, sf_dir).cat.texts, scratch_path(spark, "containers"))
    return TD.read_containers(spark, path)


@register("text_dir_scan", O.render(CAT, "SELECT title, unnest(string_split(text, chr(10))) "
                                         "AS line FROM texts"))
def q_text_dir_scan(spark, sf_dir):
    return _text_dir_lines(spark, sf_dir).withColumnRenamed("file", "title")


LINES = CAT + [("lines_t", "SELECT title, unnest(string_split(text, chr(10))) AS text "
                           "FROM texts")] + O.index_ctes("lines_t", "l_")


@register("file_word_count", O.render(LINES, "SELECT word, title, n FROM l_counts"))
def q_file_word_count(spark, sf_dir):
    counts = I.file_word_count(_text_dir_lines(spark, sf_dir))
    return counts.select("word", F.col("file").alias("title"), "n")


@register("file_word_lists", O.render(
    LINES, "SELECT title AS file, to_json(list_sort(list({'word': word, 'n': n})))::VARCHAR "
           "AS words_json FROM l_counts GROUP BY title"))
def q_file_word_lists(spark, sf_dir):
    """T9; the (word, n) list is compared as its JSON text."""
    counts = I.file_word_count(_text_dir_lines(spark, sf_dir))
    return I.file_word_lists(counts).select("file", F.to_json("words").alias("words_json"))


@register("artefact_roundtrip", O.render(O.INDEX + O.HOLDOUT + O.centroid_ctes(5, True),
                                         f"SELECT cat_name, word, {O.r6('weight')} "
                                         "FROM centroids"))
def q_artefact_roundtrip(spark, sf_dir):
    p = _p(spark, sf_dir)
    return _saved_and_loaded(spark, "centroids", lambda: p.centroids, bucket_by=["word"])


def _saved_and_loaded(spark, name, build, **layout):
    """The first load builds and saves, the second reads what was saved."""
    path = scratch_path(spark, name)
    A.load_artefact(spark, path, build=build, **layout)
    return A.load_artefact(spark, path)


@register("artefact_documents", O.render(O.INDEX, "SELECT title, word, n FROM counts"))
def q_artefact_documents(spark, sf_dir):
    p = _p(spark, sf_dir)
    return _saved_and_loaded(spark, "documents", lambda: p.index.counts)


@register("artefact_index", O.render(
    O.INDEX, f"SELECT word, {O.r6('idf')}, title, {O.r6('tf')} FROM postings "
             "JOIN vocab USING (word)"))
def q_artefact_index(spark, sf_dir):
    idx = _p(spark, sf_dir).index
    return _saved_and_loaded(spark, "index", lambda: I.inverted_index(idx.postings, idx.vocab),
                             bucket_by=["word"])


@register("artefact_vectors", O.render(
    O.INDEX + O.HOLDOUT, f"SELECT title, word, {O.r6('weight')} FROM vectors "
                         "WHERE title IN (SELECT title FROM holdout)"))
def q_artefact_vectors(spark, sf_dir):
    """V3 over saved vectors, bucketed by title: the lookup moves the titles only."""
    p = _p(spark, sf_dir)
    saved = _saved_and_loaded(spark, "vectors", lambda: p.vectors, bucket_by=["title"])
    return I.vector_of_page(saved, p.holdout)


@register("vector_of_page", O.render(
    O.INDEX + O.HOLDOUT, f"SELECT title, word, {O.r6('weight')} FROM vectors "
                         "WHERE title IN (SELECT title FROM holdout)"))
def q_vector_of_page(spark, sf_dir):
    p = _p(spark, sf_dir)
    return I.vector_of_page(p.vectors, p.holdout)


CONV = [("conv_texts", "SELECT concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) "
                       "AS title, text, role FROM conversations")]
CONV_INDEX = O.INDEX + CONV + O.index_ctes("conv_texts", "c_") + [
    ("conv_vectors", "SELECT title, word, n * idf AS weight FROM c_counts "
                     "JOIN vocab USING (word)")]


def _conv_texts(spark, sf_dir):
    return read_table(spark, sf_dir, "conversations").select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
        .alias("title"), "text", "role", "conv_id", "turn")


@register("vector_of_text", O.render(CONV_INDEX, f"SELECT title, word, {O.r6('weight')} "
                                                 "FROM conv_vectors"))
def q_vector_of_text(spark, sf_dir):
    p = _p(spark, sf_dir)
    return I.vector_of_text(_conv_texts(spark, sf_dir).select("title", "text"), p.index.vocab)


COS_PAIRS = CONV_INDEX + [
    ("turn_pairs", "SELECT DISTINCT a, b FROM (SELECT title AS a, lag(title) OVER "
                   "(PARTITION BY conv_id ORDER BY turn) AS b FROM (SELECT concat(CAST(conv_id "
                   "AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS title, conv_id, turn "
                   "FROM conversations)) WHERE b IS NOT NULL"),
    ("nv", "SELECT title, word, weight / sqrt(sum(weight * weight) OVER (PARTITION BY title)) "
           "AS w FROM conv_vectors WHERE weight <> 0"),
    ("dots", "SELECT p.a, p.b, sum(x.w * y.w) AS score FROM turn_pairs p JOIN nv x ON "
             "x.title = p.a JOIN nv y ON y.title = p.b AND y.word = x.word GROUP BY p.a, p.b"),
]


@register("cosine_pairs", O.render(
    COS_PAIRS, "SELECT p.a, p.b, round(coalesce(d.score, 0.0), 6) AS score FROM turn_pairs p "
               "LEFT JOIN dots d ON d.a = p.a AND d.b = p.b"))
def q_cosine_pairs(spark, sf_dir):
    from pyspark.sql import Window
    p = _p(spark, sf_dir)
    conv = _conv_texts(spark, sf_dir)
    vecs = I.vector_of_text(conv.select("title", "text"), p.index.vocab)
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = (conv.select(F.col("title").alias("a"), F.lag("title").over(w).alias("b"))
             .where(F.col("b").isNotNull()))
    return V.cosine_pairs(vecs, pairs)


SIM = O.INDEX + [
    ("nvec", "SELECT title, word, weight / sqrt(sum(weight * weight) OVER (PARTITION BY title)) "
             "AS w FROM vectors WHERE weight <> 0"),
    ("sims", "SELECT x.title AS a, y.title AS b, sum(x.w * y.w) AS sim FROM nvec x JOIN nvec y "
             "ON x.word = y.word AND x.title < y.title GROUP BY x.title, y.title"),
]


@register("similarity_pairs", O.render(SIM, f"SELECT a, b, {O.r6('sim')} FROM sims "
                                            "WHERE sim > 0.1"))
def q_similarity_pairs(spark, sf_dir):
    return V.similarity_pairs(_p(spark, sf_dir).vectors, min_sim=0.1)


DBSCAN = SIM + [
    ("nbr", "SELECT a, b FROM sims WHERE sim >= 0.5 UNION ALL "
            "SELECT b, a FROM sims WHERE sim >= 0.5"),
    ("cores", "SELECT a AS title FROM nbr GROUP BY a HAVING count(*) + 1 >= 5"),
    ("core_edges", "SELECT a, b FROM nbr WHERE a IN (SELECT title FROM cores) "
                   "AND b IN (SELECT title FROM cores)"),
]
DBSCAN_SQL = O.render(DBSCAN, """, cc AS (SELECT node, min(label) AS label FROM (
  WITH RECURSIVE reach(node, label) AS (
    SELECT title, title FROM cores
    UNION
    SELECT e.b, r.label FROM reach r JOIN core_edges e ON e.a = r.node)
  SELECT * FROM reach) GROUP BY node),
ids AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster_id
        FROM (SELECT DISTINCT label FROM cc)),
core_ids AS (SELECT c.node AS title, i.cluster_id FROM cc c JOIN ids i USING (label)),
border AS (SELECT n.a AS title, min(k.cluster_id) AS cluster_id FROM nbr n
           JOIN core_ids k ON k.title = n.b WHERE n.a NOT IN (SELECT title FROM cores)
           GROUP BY n.a),
assigned AS (SELECT * FROM core_ids UNION ALL SELECT * FROM border)
SELECT t.title, CAST(coalesce(a.cluster_id, -1) AS INTEGER) AS cluster_id
FROM (SELECT DISTINCT title FROM texts) t LEFT JOIN assigned a USING (title)""")
# render() emits "WITH ... )\n" + final; the final here continues the CTE list
DBSCAN_SQL = DBSCAN_SQL.replace("\n, cc AS", ",\ncc AS", 1)


@register("dbscan_clusters", DBSCAN_SQL)
def q_dbscan(spark, sf_dir):
    p = _p(spark, sf_dir)
    return V.dbscan_clusters(p.vectors, p.cat.texts, eps=0.5, min_pts=5)


@register("artefact_clusters", DBSCAN_SQL)
def q_artefact_clusters(spark, sf_dir):
    return _saved_and_loaded(spark, "clusters", lambda: q_dbscan(spark, sf_dir))


@register("categorise_texts", O.render(
    CONV_INDEX + [("conv_catpage", "SELECT DISTINCT role AS cat_name, title AS pag_title "
                                   "FROM conv_texts")]
    + O.centroid_ctes(5, holdout=False)
    + O.scoring_ctes("conv_texts", "conv_vectors", catpage="conv_catpage")
    + O.measure_ctes("conv_catpage"),
    "SELECT r.title, CAST(r.rank AS INTEGER) AS rank, r.cat_name, round(r.score, 6) AS score, "
    "m.boolean, round(m.fractional, 6) AS fractional, round(m.hierarchical, 6) AS hierarchical "
    "FROM recs r JOIN measures m USING (title)"))
def q_categorise_texts(spark, sf_dir):
    p = _p(spark, sf_dir)
    conv = _conv_texts(spark, sf_dir).select("title", "text",
                                             F.array("role").alias("categories"))
    cents = materialise(K.centroids(p.vectors, p.cat.catpage, 5), "centroids")
    recs, meas = K.categorise_texts(conv, p.index.vocab, cents, p.cent_cats, p.cat.catsub)
    return recs.join(meas.select("title", "boolean", "fractional", "hierarchical"), "title")


# ---------------------------------------------------------------------------
# Sampling and the sweep
# ---------------------------------------------------------------------------

@register("sample_pages", O.render(CAT, "SELECT title FROM page_titles ORDER BY "
                                        "md5(concat(title, '42')), title LIMIT 100"))
def q_sample_pages(spark, sf_dir):
    return E.sample_pages(_cat(spark, sf_dir).pages, 100)


SWEEP_T = list(range(4, 51))
THR_SQL = ("SELECT unnest(generate_series(4, 50)) AS t")


@register("per_threshold_samples", O.render(
    CAT + O.HOLDOUT + [("thr", THR_SQL)],
    "SELECT t, title FROM (SELECT thr.t, h.title, row_number() OVER (PARTITION BY thr.t ORDER "
    "BY md5(concat(h.title, '42', CAST(thr.t AS VARCHAR))), h.title) AS rn FROM holdout h "
    "CROSS JOIN thr) WHERE rn <= 100"))
def q_per_threshold_samples(spark, sf_dir):
    p = _p(spark, sf_dir)
    return E.per_threshold_samples(p.holdout, SWEEP_T, 100)


SWEEP_COLS = ["mean_boolean", "std_boolean", "mean_fractional", "std_fractional",
              "mean_hierarchical", "std_hierarchical"]


def _sweep(spark, sf_dir):
    p = _p(spark, sf_dir)
    return E.threshold_sweep(p.vectors, p.cat.catpage, p.cat.catsub, p.cat.pages,
                             min_pag=4, max_pag=50, n_pages=100, fraction=0.2)


@register("threshold_sweep", O.render(
    O.sweep_ctes(4, 50, 100),
    "SELECT n_pages, n_centroids, " + ", ".join(O.r6(c) for c in SWEEP_COLS) + " FROM sweep"))
def q_threshold_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)


@register("artefact_sweep", O.render(
    O.sweep_ctes(4, 50, 100),
    "SELECT n_pages, n_centroids, " + ", ".join(O.r6(c) for c in SWEEP_COLS) + " FROM sweep"))
def q_artefact_sweep(spark, sf_dir):
    return _saved_and_loaded(spark, "sweep", lambda: _sweep(spark, sf_dir))


@register("sweep_long", O.render(
    O.sweep_ctes(4, 50, 100),
    " UNION ALL ".join(
        f"SELECT n_pages, n_centroids, '{label}' AS type, {O.r6('mean_' + k, 'mean')}, "
        f"{O.r6('std_' + k, 'std')} FROM sweep"
        for label, k in (("Boolean", "boolean"), ("Fractional", "fractional"),
                         ("Hierarchical", "hierarchical")))))
def q_sweep_long(spark, sf_dir):
    return E.sweep_long(_sweep(spark, sf_dir))


@register("inverted_index_nested", O.render(
    O.INDEX, "SELECT word, chunk, round(any_value(idf), 6) AS idf, string_agg(title || ':' || "
             "CAST(CAST(round(tf * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY title) AS docs FROM ("
             "SELECT word, idf, title, tf, CAST(CAST('0x' || substr(md5(title), 1, 8) AS BIGINT) % "
             "greatest(1, CAST(ceil(df / 50.0) AS BIGINT)) AS INTEGER) AS chunk "
             "FROM postings JOIN vocab USING (word)) GROUP BY word, chunk"))
def q_inverted_index_nested(spark, sf_dir):
    """I4 nested; the map is compared as title:millionths text, in title order."""
    idx = _p(spark, sf_dir).index
    entry = lambda e: F.concat(e["key"], F.lit(":"), F.round(
        e["value"] * 1e6).cast("long").cast("string"))
    return I.inverted_index_nested(idx.postings, idx.vocab, max_entries=50).select(
        "word", "chunk", "idf",
        F.array_join(F.transform(F.map_entries("docs"), entry), ",").alias("docs"))


@register("streaming_word_count", O.render(LINES, "SELECT word, title, n FROM l_counts"))
def q_streaming_word_count(spark, sf_dir):
    """T8 as a stream of containers: three per micro-batch, a folder of counts per batch."""
    from ..streaming.textdir import batch_counts, count_batches
    text_dir = TD.write_containers(_p(spark, sf_dir).cat.texts, scratch_path(spark, "stream-in"),
                                   files=8)
    out = scratch_path(spark, "stream-out")
    count_batches(spark, text_dir, out, scratch_path(spark, "stream-ckpt"), files_per_batch=3,
                  containers=True)
    return batch_counts(spark, out).withColumnRenamed("file", "title")


SAMPLE_EVAL = (O.INDEX + [("sampled", "SELECT title FROM page_titles ORDER BY "
                                      "md5(concat(title, '42')), title LIMIT 100")]
               + O.centroid_ctes(5, holdout=False) + O.scoring_ctes("sampled")
               + O.measure_ctes())


@register("evaluation_sample", O.render(
    SAMPLE_EVAL,
    "SELECT count(*) AS n_pages, CAST(sum(boolean) AS BIGINT) AS n_success, "
    f"{O.r6('avg(boolean)', 'mean_boolean')}, {O.r6('avg(fractional)', 'mean_fractional')}, "
    f"{O.r6('avg(hierarchical)', 'mean_hierarchical')}, "
    f"{O.r6('avg(hierarchical_as_written)', 'mean_hierarchical_as_written')} FROM measures"))
def q_evaluation_sample(spark, sf_dir):
    """E3 as the reference's demo runs it: n sampled pages, centroids from all
    pages (no hold-out), mean of the three measures."""
    p = _p(spark, sf_dir)
    test = E.sample_pages(p.cat.pages, 100)
    _, summary = E.evaluation(p.vectors, p.cat.catpage, p.cat.catsub, test, 5, holdout=False)
    return summary
