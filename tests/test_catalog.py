from pyspark.sql import functions as F

from catspark.operators import catalog as C
from catspark.sources.tables import Catalogue
from conftest import SF0001


def test_golden_catalogue_counts(spark):
    c = Catalogue(spark, SF0001)
    assert c.catpage.count() == 843
    assert c.catsub.count() == 130
    assert (c.pages.count(), c.categories.count()) == (200, 140)
    assert C.top_categories(c.catsub).count() == 22
    assert round(C.avg_categories_per_page(c.catpage).first()[0], 3) == 4.215
    assert C.biggest_categories(c.catpage, c.catsub, 5).count() == 21


def test_scan_offset_limit(spark):
    c = Catalogue(spark, SF0001)
    all_titles = [r.title for r in c.pages.orderBy("title").collect()]
    page = [r.title for r in C.scan(c.pages, "pages", nrows=10, offset=5).collect()]
    assert page == all_titles[5:15]


def test_constraints_find_seeded_faults(spark):
    c = Catalogue(spark, SF0001)
    one = spark.range(1)
    cp = c.catpage.union(one.select(F.lit("lang_en"), F.lit("-1")))
    cs = c.catsub.union(one.select(F.lit("languages"), F.lit("languages")))
    got = {r.rule: r.n for r in C.check_constraints(c.pages, c.categories, cp, cs).collect()}
    assert got["fk_catpage_page"] == 1
    assert got["check_self_loop"] == 1
    assert got["pk_catpage"] == 0


def test_hierarchy_relations(spark):
    cs = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "c")],
                               "cat_name string, cat_name_sub string")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("p", "a"), ("a", "a")],
                                  "cat_a string, cat_b string")
    assert {tuple(r) for r in C.brothers(pairs, cs).collect()} == {("a", "b")}
    assert {tuple(r) for r in C.father_son(pairs, cs).collect()} == {("p", "a")}
