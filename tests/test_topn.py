import numpy as np
from pyspark.sql import functions as F

from catspark.operators import classify as K
from catspark.operators import topn
from catspark.plans.pipeline import Pipeline
from conftest import SF0001


def best(df):
    return {(r["title"], r["rank"]): (r["cat_name"], round(r["score"], 8)) for r in df.collect()}


def test_bounded_top_n_equals_full_scores(spark, monkeypatch):
    p = Pipeline(spark, SF0001)
    pages = p.cat.pages
    counts = K.suggestion_counts(pages, p.cat.catpage, p.cent_cats)
    full = best(K.recommendations(K.category_scores(p.vectors, p.centroids), counts, p.cent_cats))
    for pages_, words, blocks in ((512, 1_000_000, 64), (30, 4000, 2)):
        monkeypatch.setattr(topn, "CHUNK_PAGES", pages_)
        monkeypatch.setattr(topn, "CHUNK_WORDS", words)
        monkeypatch.setattr(topn, "CHUNK_BLOCKS", blocks)
        scores = topn.best_categories(p.vectors, p.centroids, counts, p.cent_cats)
        assert best(K.recommendations(scores, counts, p.cent_cats)) == full
    assert topn.best_categories(p.vectors.limit(0), p.centroids, counts, p.cent_cats).count() == 0


def test_blocks_that_cannot_enter_are_skipped():
    r = np.random.default_rng(2)
    n_pages, n_cats, n_words = 60, 240, 400
    topic = r.integers(0, 12, n_cats)
    topic.sort()
    cents = np.zeros((n_cats, n_words))
    for c in range(n_cats):
        own = topic[c] * 30 + r.choice(30, 20, replace=False)
        cents[c, own] = r.random(20)
        cents[c, 360 + r.choice(40, 5, replace=False)] = 0.1
    cents /= np.linalg.norm(cents, axis=1, keepdims=True)
    pages = np.zeros((n_pages, n_words))
    for i in range(n_pages):
        pages[i, r.integers(0, 12) * 30 + r.choice(30, 15, replace=False)] = r.random(15)
        pages[i, 360 + r.choice(40, 8, replace=False)] = 0.1
    pages /= np.linalg.norm(pages, axis=1, keepdims=True)
    want = r.integers(1, 6, n_pages)
    pi, pw = np.nonzero(pages)
    ci, cw = np.nonzero(cents)
    page, cat, score, scored = topn.make_chunk_best(4, 1e-8)(
        pi, want[pi], pw, pages[pi, pw], ci + 1, cw, cents[ci, cw])
    full = pages @ cents.T
    for i in range(n_pages):
        mine = {(c - 1): s for p, c, s in zip(page, cat, score, strict=True) if p == i}
        order = np.lexsort((np.arange(n_cats), -full[i]))[:want[i]]
        assert all(c in mine and abs(mine[c] - full[i, c]) < 1e-12 for c in order)
    assert scored < 0.3 * n_pages * n_cats


def test_pages_and_centroids_without_shared_words(spark):
    vec = spark.createDataFrame([("p", "a", 1.0), ("q", "z", 1.0)], "title string, word string, weight double")
    cents = spark.createDataFrame([("c", "a", 2.0), ("d", "b", 1.0)],
                                  "cat_name string, word string, weight double")
    cats = cents.select("cat_name").withColumn("size", F.lit(5))
    counts = spark.createDataFrame([("p", 1, 2), ("q", 1, 2)], "title string, n_actual long, n long")
    got = topn.best_categories(vec, cents, counts, cats).collect()
    assert [tuple(r) for r in got] == [("p", "c", 1.0)]
    recs = best(K.recommendations(topn.best_categories(vec, cents, counts, cats), counts, cats))
    assert recs == {("p", 1): ("c", 1.0), ("p", 2): ("d", 0.0), ("q", 1): ("c", 0.0), ("q", 2): ("d", 0.0)}


def test_sums_over_chunks_of_words_equal_full_scores(spark, monkeypatch):
    p = Pipeline(spark, SF0001)
    counts = K.suggestion_counts(p.cat.pages, p.cat.catpage, p.cent_cats)
    plain = {(r["title"], r["cat_name"]): r["score"]
             for r in K.cosine(p.vectors, p.centroids, "title", "cat_name").collect()}
    sent = []

    def recorded(page_rows, words, *args, **kw):
        sent.append(page_rows)
        return summed(page_rows, words, *args, **kw)

    summed = topn.summed_scores
    monkeypatch.setattr(topn, "summed_scores", recorded)
    monkeypatch.setattr(topn, "COPIES", 0)
    for entries, blocks in ((10_000_000, 64), (3000, 64), (3000, 2)):
        monkeypatch.setattr(topn, "CHUNK_ENTRIES", entries)
        monkeypatch.setattr(topn, "CHUNK_BLOCKS", blocks)
        scores = {(r["title"], r["cat_name"]): r["score"]
                  for r in K.category_scores(p.vectors, p.centroids).collect()}
        assert scores.keys() == plain.keys()
        assert all(abs(scores[k] - plain[k]) < 1e-12 for k in plain)
        few = topn.best_categories(p.vectors, p.centroids, counts, p.cent_cats)
        full = K.recommendations(K.category_scores(p.vectors, p.centroids), counts, p.cent_cats)
        assert best(K.recommendations(few, counts, p.cent_cats)) == best(full)
        assert few.count() < len(plain)
    assert len(sent) == 9


def test_idle_cores_share_words_or_pages_by_what_moves(spark, monkeypatch):
    # 6 million entries and 10,000 pages on 8 cores: copies for 8 parts of the pages would be 480 MB
    spans, chunks, parts = topn.deal(6_000_000, 190, 10_000, 8)
    assert spans * chunks * parts == 8
    assert 6_000_000 * parts * topn.ENTRY_BYTES + 10_000 * chunks * 190 * 8 < 200_000_000
    assert topn.deal(100_000_000, 190, 10_000, 8)[1:] == (9, 1)
    assert topn.deal(100, 190, 10_000_000, 8) == (1, 1, 8)
    assert topn.deal(0, 0, 0, 8)[0] == 1
    p = Pipeline(spark, SF0001)
    found = []
    for bytes_ in (0, 1 << 40):  # parts only, chunks only
        monkeypatch.setattr(topn, "ENTRY_BYTES", bytes_)
        found.append({(r["title"], r["cat_name"]): r["score"]
                      for r in K.category_scores(p.vectors, p.centroids).collect()})
    assert found[0].keys() == found[1].keys()
    assert all(abs(found[0][k] - found[1][k]) < 1e-12 for k in found[0])
