import os
import random

from catspark.operators import index as I
from catspark.operators.store import DocumentStore
from catspark.streaming.textdir import store_batches

WORDS = ["cats", "dogs", "running", "sleep", "houses", "trees", "the", "of", "42"]


def batches(seed=1, n=4):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        titles = r.sample([f"t{i}" for i in range(12)], r.randint(3, 9))
        out.append([(t, r.choice([None, "", " ".join(r.choice(WORDS) for _ in range(r.randint(1, 9)))]))
                    for t in titles])
    return out


def rebuilt(spark, live):
    texts = spark.createDataFrame(sorted(live.items()), "title string, text string")
    counts = I.term_counts(texts)
    voc = I.vocab(I.postings(counts), I.document_count(texts))
    return ({tuple(r) for r in counts.select("title", "word", "n").collect()},
            {(r["word"], r["df"], round(r["idf"], 9)) for r in voc.collect()})


def state(store):
    return ({tuple(r) for r in store.counts().collect()},
            {(r["word"], r["df"], round(r["idf"], 9)) for r in store.vocab().collect()})


def test_later_texts_retract_earlier_ones(spark, tmp_dir):
    store, live = DocumentStore(spark, os.path.join(tmp_dir, "s")), {}
    for i, rows in enumerate(batches()):
        store.put(spark.createDataFrame(rows, "title string, text string"), i)
        live |= dict(rows)
        assert state(store) == rebuilt(spark, live)
    assert {r["title"] for r in store.titles().collect()} == set(live)
    # a batch that runs again changes nothing
    store.put(spark.createDataFrame(batches()[-1], "title string, text string"), 3)
    assert state(store) == rebuilt(spark, live)
    small = store.compact(os.path.join(tmp_dir, "c"))
    assert state(small) == rebuilt(spark, live)
    small.put(spark.createDataFrame([("t1", "trees"), (None, "no title")],
                                    "title string, text string"), 1)
    assert state(small) == rebuilt(spark, live | {"t1": "trees"})


def test_stream_of_texts_replaces(spark, tmp_dir):
    src, live = os.path.join(tmp_dir, "in"), {}
    store = DocumentStore(spark, os.path.join(tmp_dir, "s"))
    for rows in batches(2, 3):
        # the same titles twice in a batch: the higher seq wins
        seq = [(t, "dogs dogs", 0) for t, _ in rows] + [(t, x, 1) for t, x in rows]
        spark.createDataFrame(seq, "title string, text string, seq long").coalesce(1).write.mode(
            "append").parquet(src)
        live |= dict(rows)
        store_batches(store, src, os.path.join(tmp_dir, "ckpt"))
    assert state(store) == rebuilt(spark, live)
