import __spark_entry__ as entry
from conftest import SF0001
from oracle_check import digest, duck

FAST_KEYS = ["term_counts", "idf", "recommendations", "hierarchical_measure",
             "biggest_categories", "extract_catsub", "categories_by_page", "evaluation"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["title", "boolean", "fractional", "hierarchical",
                          "hierarchical_as_written"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_rows_only():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70


def test_oracle_subset_sf0001(spark):
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(SF0001)
    for key in FAST_KEYS:
        df = qs[key](spark, SF0001)
        res = con.sql(sqls[key])
        hs, _ = digest(df.columns, [tuple(r) for r in df.collect()])
        hd, _ = digest(res.columns, res.fetchall())
        assert hs == hd, key
