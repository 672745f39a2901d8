import os

from pyspark.sql import functions as F

from catspark.operators import ingest as G
from catspark.sources.dump import read_dump

NS = "http://www.mediawiki.org/xml/export-0.10/"
PAGES = [
    (1, "Alan  Turing", 0, None,
     "Body '''bold''' [[link|shown]] {{t|x}} &lt;ref&gt;r&lt;/ref&gt;\n"
     "[[Category:People (UK)|Turing]]\n[[Category: Computer  scientists ]]"
     "[[Category:U.S. folks]]"),
    (2, "AT", 0, "Alan Turing", "#REDIRECT [[Category:X]]"),
    (3, "Category:People (UK)", 14, None,
     "intro [[Category:People (by country)|x]][[Category:U.S. folks]][[Category:All]]"),
    (4, "Template:Z", 10, None, "[[Category:T]]"),
    (5, "Nocat", 0, None, "nothing"),
    (6, "Nul", 0, None, None),
]


def _write_sample(path):
    parts = [f'<mediawiki xmlns="{NS}" version="0.10">', "  <siteinfo/>"]
    for pid, title, ns, redirect, text in PAGES:
        red = f'    <redirect title="{redirect}" />\n' if redirect else ""
        body = "<text />" if text is None else f'<text xml:space="preserve">{text}</text>'
        parts.append(f"  <page>\n    <title>{title}</title>\n    <ns>{ns}</ns>\n"
                     f"    <id>{pid}</id>\n{red}    <revision><id>{pid}0</id>{body}"
                     "</revision>\n  </page>")
    parts.append("</mediawiki>")
    with open(path, "w") as f:
        f.write("\n".join(parts))


def test_dump_sample(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dump.xml")
    _write_sample(path)
    pages = read_dump(spark, path)
    stats = G.ingest_stats(pages).first()
    assert tuple(stats) == (6, 4, 0)
    split = G.split_body(G.valid_pages(pages))
    assert {r.title for r in G.derive_pages(split).collect()} == {"Alan_Turing"}
    cp = {(r.cat_name, r.pag_title) for r in G.extract_catpage(split).collect()}
    assert cp == {("People_(UK)", "Alan_Turing"), ("Computer_scientists", "Alan_Turing"),
                  ("U.S._folks", "Alan_Turing")}
    exact = {(r.cat_name, r.cat_name_sub) for r in G.extract_catsub(split).collect()}
    assert exact == {("People_(by_country)", "People_(UK)"), ("U.S._folks", "People_(UK)"),
                     ("All", "People_(UK)")}
    cut = {r.cat_name for r in G.extract_catsub(split, truncate=True).collect()}
    assert cut == {"People", "U", "All"}


def test_large_dump_splits_over_tasks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big.xml")
    with open(path, "w") as f:
        f.write(f'<mediawiki xmlns="{NS}">\n')
        for i in range(1, 20001):
            red = '<redirect title="x" />' if i % 10 == 0 else ""
            f.write(f"  <page><title>P {i}</title><ns>0</ns><id>{i}</id>{red}<revision>"
                    f"<id>{i}</id><text>some words here [[Category:C{i % 7}]]</text>"
                    "</revision></page>\n")
        f.write("</mediawiki>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        pages = read_dump(spark, path)
        assert pages.rdd.getNumPartitions() > 1
        row = pages.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"),
                        F.count_distinct("id").alias("d")).first()
        assert (row.n, row.s, row.d) == (20000, 20000 * 20001 // 2, 20000)
        assert G.valid_pages(pages).count() == 18000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_prefixed_namespace_dump(spark, tmp_dir):
    path = os.path.join(tmp_dir, "prefixed.xml")
    with open(path, "w") as f:
        f.write(f'<mw:mediawiki xmlns:mw="{NS}">\n')
        for i in (1, 2):
            f.write(f"<mw:page><mw:title>T {i}</mw:title><mw:ns>0</mw:ns><mw:id>{i}</mw:id>"
                    f"<mw:revision><mw:id>{i}</mw:id><mw:text>x [[Category:C {i}]]</mw:text>"
                    "</mw:revision></mw:page>\n")
        f.write("</mw:mediawiki>\n")
    pages = read_dump(spark, path, prefix="mw")
    rows = sorted((r.title, r.ns, r.id, r.text) for r in pages.collect())
    assert rows == [("T 1", 0, 1, "x [[Category:C 1]]"), ("T 2", 0, 2, "x [[Category:C 2]]")]
    cp = {(r.cat_name, r.pag_title) for r in
          G.extract_catpage(G.split_body(G.valid_pages(pages))).collect()}
    assert cp == {("C_1", "T_1"), ("C_2", "T_2")}


def test_malformed_pages_are_counted(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.xml")
    page = "<page><title>{t}</title><ns>0</ns><id>{i}</id><revision><text>{x}</text></revision></page>\n"
    with open(path, "w") as f:
        f.write(f'<mediawiki xmlns="{NS}">\n' + page.format(t="A", i=1, x="ok [[Category:C]]")
                + page.format(t="B", i=2, x="bare & ampersand") + page.format(t="C", i=3, x="fine")
                + "</mediawiki>\n")
    pages = read_dump(spark, path)
    assert tuple(G.ingest_stats(pages).first()) == (3, 2, 1)
    bad = [r.malformed for r in pages.where("malformed is not null").collect()]
    assert len(bad) == 1 and "bare & ampersand" in bad[0]
    assert {r.title for r in G.valid_pages(pages).collect()} == {"A", "C"}


def test_page_cap_keeps_the_first_ids(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dump.xml")
    _write_sample(path)
    got = G.limit_pages(read_dump(spark, path), 2)
    assert sorted((r.id, r.title) for r in got.collect()) == [
        (1, "Alan_Turing"), (3, "Category:People_(UK)")]
