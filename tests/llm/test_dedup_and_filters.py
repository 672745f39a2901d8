import hashlib
import random
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from catspark.llm import decontamination, neardup, quality, substring


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("window", [20, 3])
def test_substring_dedup_equals_brute_force(spark, window):
    df, rows = cases.documents(spark)
    want = cases.removed_words(rows, window)
    expect = []
    for r in rows:
        w, gone = want[r[0] is None, r[0] or 0, r[1] or ""]
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expect.append((r[0], len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest(),
                       left if any(gone) else None))
    got = substring.dedup_substrings(df, window=window).select(
        "_id", "n_words", "n_removed", "kept_sha256", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(expect, key=key)


def test_substring_dedup_carries_whole_rows(spark):
    """With ``carry`` every row comes back with its other columns and the text that is left."""
    df, rows = cases.documents(spark)
    plain = {(r["_id"], r["_h"]): r["text"] for r in substring.dedup_substrings(df).collect()}
    got = substring.dedup_substrings(df, carry=True).collect()
    assert sorted((tuple(r["row"]) for r in got), key=key) == sorted(
        (tuple(x for x, c in zip(r, df.columns, strict=True) if c != "text") for r in df.collect()),
        key=key)
    whole = {(r["_id"], r["_h"]): r["text"] for r in
             df.select(F.col("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("_h"),
                       "text").collect()}
    assert any(r["n_removed"] for r in got)
    for r in got:
        k = r["_id"], r["_h"]
        assert r["text"] == (plain[k] if r["n_removed"] else whole[k])


def test_substring_dedup_when_prefixes_exceed_a_task(spark):
    """A tiny limit sends prefixes to longer ones, and the commonest windows to an aggregate."""
    df, rows = cases.documents(spark)
    normal = substring.dedup_substrings(df).drop("spans", "_h").collect()
    tight = substring.dedup_substrings(df, limit=3).drop("spans", "_h").collect()
    assert sorted(map(tuple, normal), key=key) == sorted(map(tuple, tight), key=key)


@pytest.mark.parametrize("window", [3, 4, 20])
def test_suffix_order_and_common_prefixes(window):
    """Sorted keys are in the order of the words, and neighbours' prefixes are counted in words."""
    rng = np.random.default_rng(window)
    codes = rng.choice([0, 1, 255, 256, 65535], (500, window), p=[.6, .1, .1, .1, .1])
    codes = np.concatenate([codes, codes[:100]])
    prints = rng.integers(0, 2, len(codes)).astype(np.uint64)
    keys = substring.sort_keys(codes.astype(">u2"))
    order = np.lexsort((prints, *keys.T[::-1]))
    rows = [(*codes[i].tolist(), int(prints[i])) for i in order]
    assert rows == sorted(rows)
    expect = [0]
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        same = next((i for i in range(window) if a[i] != b[i]), window)
        expect.append(window - 1 if same == window and a[-1] != b[-1] else same)
    assert substring.common_prefixes(keys[order], prints[order], window).tolist() == expect


def test_substring_anchors_known_within_a_batch(spark):
    """Copies and shared passages in one batch and over batches, whichever row comes first."""
    passage = " ".join(f"p{i}" for i in range(40))
    own = lambda k, n=30: " ".join(f"w{k}x{i}" for i in range(n))
    texts = [own(k) + " " + passage + " " + own(k + 100) for k in range(6)] + [passage + " " + own(7)]
    rows = [(i + 10, t) for i, t in enumerate(texts)]
    rows += [(3, texts[2]), (30, texts[0]), (30, texts[0]), (31, own(50) + " " + own(50))]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")
        want = cases.removed_words(rows, 20)
        got = {(r["_id"], r["kept_sha256"], r["n_removed"])
               for r in substring.dedup_substrings(df).collect()}
        expect = set()
        for d, t in rows:
            w, gone = want[False, d, t]
            left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
            expect.add((d, hashlib.sha256(left.encode()).hexdigest(), sum(gone)))
        assert got == expect


def test_substring_spans_name_the_removed_words(spark):
    df, rows = cases.documents(spark)
    want = cases.removed_words(rows, 20)
    for r in substring.dedup_substrings(df).join(
            df.select(F.col("doc_id").alias("d"), F.col("text").alias("t")).distinct(),
            F.col("_id").eqNullSafe(F.col("d")) & (F.xxhash64("d", "t") == F.col("_h"))).collect():
        gone = want[r["d"] is None, r["d"] or 0, r["t"] or ""][1]
        flags = [False] * len(gone)
        for at, n in np.frombuffer(r["spans"] or b"", "<u4").reshape(-1, 2).tolist():
            flags[at:at + n] = [True] * n
        assert flags == gone


def test_near_duplicates_equal_brute_force(spark):
    df, rows = cases.documents(spark)
    got = neardup.near_duplicates(df).collect()
    nodes = {}
    for r in got:
        nodes.setdefault((r["_id"], r["_h"]), r["node"])
    hashed = df.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("x")).collect()
    pairs = [(nodes[r["doc_id"], r["x"]], r["text"]) for r in hashed]
    want = cases.classes(pairs)
    assert len(got) == len(rows)
    assert all(r["class_id"] == want[r["node"]] for r in got)
    assert all(r["node"] == r["_id"] for r in got if r["_id"] is not None)


def test_near_duplicates_of_a_star_whose_copies_differ_from_each_other(spark):
    """Copies near their original only: the class must not fall apart."""
    r = random.Random(3)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(400)]
    texts = [" ".join(base)]
    for i in range(40):
        w = list(base)
        for p in r.sample(range(400), 8):
            w[p] = f"e{i}x{p}"
        texts.append(" ".join(w))
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    bags = [cases.shingles(t) for t in texts]
    assert cases.similarity(bags[0], bags[1]) > 0.8 > cases.similarity(bags[1], bags[2])
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {min(i for i, _ in rows)}
    assert all(r["n_verified"] >= 1 for r in got)


def test_near_duplicates_that_repeat_a_passage_equal_brute_force(spark):
    """Plain Jaccard 0.8 and more, probability Jaccard far less: both kinds of bands are needed."""
    r = random.Random(7)
    texts = []
    for m, w in [(10, 20), (10, 100), (40, 3), (30, 50)]:
        base = [f"w{r.randrange(10 ** 6)}" for _ in range(204)]
        passage = [f"p{r.randrange(10 ** 6)}" for _ in range(m)]
        texts += [" ".join(base), " ".join(base + passage * w), " ".join(base[:150])]
        # both repeat something, not the same
        texts.append(" ".join(base[:100] * w + base[100:]))
    bags = [cases.shingles(t) for t in texts]
    assert cases.similarity(bags[4], bags[5]) > 0.8 > 0.3 > cases.probability_jaccard(
        bags[4], bags[5])
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["node"]: r["class_id"] for r in got} == cases.classes(rows)


def test_near_duplicates_in_a_bucket_whose_centre_is_like_neither(spark):
    """One band only: a pair shares no other bucket, and no third text connects it."""
    r = random.Random(5)
    new = lambda k: [f"w{r.randrange(10 ** 6)}" for _ in range(k)]
    template = new(300)
    texts = [" ".join(template + new(150)) for _ in range(20)]
    texts[12] = texts[11].rsplit(" ", 8)[0] + " " + " ".join(new(8))
    texts[15] = texts[14] + " " + " ".join(new(20) * 6)  # with a repeated passage
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = cases.classes(rows)
    assert sorted(n for n, c in want.items() if n != c) == [12, 15]
    got = neardup.near_duplicates(df, bands=1, rows=1).collect()
    assert {x["node"]: x["class_id"] for x in got} == want


def test_rare_pairs_equal_brute_force(spark):
    """All similar pairs of different classes meet, also those similar by weight only."""
    rng = np.random.default_rng(4)
    bags, rows = [], []
    base = np.unique(rng.integers(0, 1 << 32, 400)).astype("<u4")
    for i in range(120):
        if i % 3 and bags:  # an edited copy, or one with other weights
            a, w = (x.copy() for x in bags[rng.integers(0, len(bags))])
            drop = rng.random(len(a)) < rng.choice([0.02, 0.1, 0.2])
            a, w = a[~drop], w[~drop]
            if i % 5 == 0:
                w[rng.random(len(w)) < 0.3] += np.uint32(rng.integers(1, 40))
        else:  # frequent shingles and some of its own
            own = rng.integers(0, 1 << 32, rng.integers(0, 60)).astype("<u4")
            a = np.unique(np.r_[rng.choice(base, rng.integers(5, 200), replace=False), own])
            w = np.ones(len(a), "<u4")
        order = np.argsort(a)
        bags.append((a[order], w[order].astype("<u4")))
        rows.append((i, i % 7 if i % 2 else i, bags[-1][0].tobytes(),
                     bags[-1][1].tobytes() if (w > 1).any() else None))
    df = spark.createDataFrame(rows, "member long, class long, shingles binary, weights binary")
    got = {tuple(r) for r in neardup.rare_pairs(df.select("member", "class"), df.drop("class"), 0.8)
           .collect()}
    similar = {(i, j) for i in range(120) for j in range(i + 1, 120)
               if rows[i][1] != rows[j][1] and neardup.similarity(*bags[i], *bags[j]) >= 0.8}
    assert len(similar) > 30 and similar <= got and len(got) < 2000


def test_near_duplicates_of_an_id_with_several_texts(spark):
    """Each text of an id is compared, whichever comes first."""
    r = random.Random(6)
    new = lambda k: [f"w{r.randrange(10 ** 6)}" for _ in range(k)]
    a, b = new(300), new(300)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a[:-2] + new(2))),
            (3, " ".join(b[:-2] + new(2))), (4, " ".join(new(300))), (1, " ".join(a))]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = neardup.near_duplicates(df).collect()
        assert len(got) == 6
        assert {x["node"]: x["class_id"] for x in got} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_bitmap_bounds_hold_for_random_texts(spark):
    rng = np.random.default_rng(9)
    rows, bags = [], []
    for i in range(60):
        a = np.unique(rng.integers(0, rng.integers(20, 900), rng.integers(5, 600))).astype("<u4")
        a = a * np.uint32(2654435761)
        w = rng.integers(1, 2 + i % 4, len(a)).astype("<u4")
        a.sort()
        bags.append((a, w))
        rows.append((i, a.tobytes(), w.tobytes() if (w > 1).any() else None))
    marks = neardup.bitmaps(spark.createDataFrame(
        rows, "member long, shingles binary, weights binary")).cache()
    other = marks.select([F.col(c).alias(f"o_{c}") for c in marks.columns])
    for threshold in (0.3, 0.5, 0.8):
        kept = {tuple(x) for x in marks.join(other, neardup.may_be_similar(threshold, "o_"))
                .select("member", "o_member").collect()}
        similar = {(i, j) for i, (a, wa) in enumerate(bags) for j, (b, wb) in enumerate(bags)
                   if neardup.similarity(a, wa, b, wb) >= threshold}
        assert similar <= kept and len(kept) < 3600 * 0.9


def test_prob_minhash_estimates_probability_jaccard():
    rng = np.random.default_rng(5)
    a, b = np.arange(0, 300, dtype="<u4"), np.arange(60, 360, dtype="<u4")
    wa, wb = (rng.integers(1, 6, 300).astype("<u4") for _ in range(2))
    true = neardup.probability_jaccard(a, wa, b, wb)
    bags = [dict(zip(x.tolist(), w.tolist(), strict=True)) for x, w in ((a, wa), (b, wb))]
    assert abs(true - cases.probability_jaccard(*bags)) < 1e-12
    shingles, weights = np.r_[a, b], np.r_[wa, wb]
    owner = np.repeat([0, 1], 300)
    sketch = neardup.prob_minhash(shingles, weights, owner, 2, 8192)
    assert abs((sketch[0] == sketch[1]).mean() - true) < 0.03


BENCH = [(1, None), (2, ""), (3, "two words"), (None, "a b c d")]


def test_decontamination_equals_brute_force(spark):
    df, rows = cases.documents(spark)
    w = cases.SPACED.findall(rows[0][1] or rows[1][1])
    texts = cases.make_texts()
    passage = texts[0].split()
    items = BENCH + [(10, " ".join(passage[5:40]).upper()), (11, " ".join(passage[12:25])),
                     (11, " ".join(passage[12:25])), (12, " ".join(texts[1].split()[:6])),
                     (13, "the " * 30), (14, "x"), (15, " ".join(w[:13])), (7, "é ü ñ 日本")]
    bench = spark.createDataFrame([(*i, 0, "q") for i in items],
                                  "item_id long, text string, length int, w string")
    got = decontamination.decontaminate(df, bench).select(
        "_id", "n_words", "n_hit", "items", "contaminated").collect()
    got = [(r[0], r[1], r[2], tuple(r[3]), r[4]) for r in got]
    assert sorted(got, key=key) == sorted(cases.contamination(rows, items), key=key)


def test_decontamination_without_items_or_documents(spark):
    df, rows = cases.documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.decontaminate(df, none)
    assert got.count() == len(rows) and got.where("n_hit > 0 or contaminated").count() == 0
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.decontaminate(cases.empty(spark), bench).count() == 0


def base_stats(text):
    w = cases.SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if cases.SPACED.search(x)]
    runs = {}
    for k in range(len(w) - 4):
        runs.setdefault(tuple(w[k:k + 5]), []).append(k)
    covered = {q for at in runs.values() if len(at) > 1 for p in at for q in range(p, p + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_quality_statistics_equal_brute_force(spark):
    df, rows = cases.documents(spark)
    got = quality.quality(df).select("_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                     "n_repeat_words", "base_failed").collect()
    want = []
    for r in rows:
        s = base_stats(r[1])
        want.append((r[0], *s, s[0] < 10 or 100 * s[4] > 20 * s[0]))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def brute_mcd(x, support, floors):
    """Concentration steps from three starts on whole-number vectors, as documented."""
    n, p = x.shape
    q = np.sort(x, axis=0)
    at = lambda s: q[int(np.ceil(n * s)) - 1]

    def moments(rows):
        return rows.mean(axis=0), np.cov(rows.T, bias=True) + np.diag(floors ** 2)

    def inner(mean, scatter, share):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)
        bins = np.floor(np.log1p(d) * quality.DISTANCE_BINS)
        return moments(x[bins <= np.sort(bins)[int(np.ceil(n * share)) - 1]])

    quartiles = (at(0.5).astype(float),
                 np.diag(np.maximum((at(0.75) - at(0.25)) / 1.349, floors) ** 2))
    ends = []
    for i, now in enumerate((quartiles, moments(x), inner(*quartiles, 0.5))):
        best, old = None, np.inf
        while True:
            now = inner(*now, support)
            det = np.linalg.slogdet(now[1])[1]
            if best is not None and det >= old - 1e-3:
                break
            best, old = now, det
        ends.append((round(old, 9), i, best))
    return min(ends, key=lambda e: e[:2])[2]


def outliers(spark, rows):
    """Check distances and verdicts of ``rows`` against brute force; (verdicts, group per id)."""
    df = spark.createDataFrame(rows, cases.DOC)
    got = {r["_id"]: (r["kept"], r["distance2"]) for r in quality.quality(df).collect()}
    names = list(quality.FLOORS)
    vec = {r["doc_id"]: [r[n] for n in names] for r in quality.base_statistics(df).withColumns(
        quality.vector()).where("not base_failed").collect()}
    past = [r for r in rows if r[0] in vec]
    levels = [lambda r: (r[2], r[3]), lambda r: (r[2],), lambda r: ()]
    counts = [Counter(map(level, past)) for level in levels]
    group = {}
    for r in past:
        fits = [i for i, level in enumerate(levels) if counts[i][level(r)] >= 50]
        group[r[0]] = (fits[0], levels[fits[0]](r)) if fits else None
    floors = np.array([quality.FLOORS[n] * quality.SCALE for n in names])
    cut = quality.chi2_quantile(1 - 1e-6, 5) * quality.consistency(0.75, 5)
    for g in set(group.values()):
        ids = [i for i in group if group[i] == g]
        if g is None:
            assert all(got[i] == (True, None) for i in ids)
            continue
        x = np.array([vec[r[0]] for r in past if levels[g[0]](r) == g[1]])
        mean, scatter = brute_mcd(x, 0.75, floors)
        for i in ids:
            z = np.array(vec[i]) - mean
            d = z @ np.linalg.inv(scatter) @ z
            assert abs(got[i][1] - d) < 1e-6 * max(1, d)
            assert got[i][0] == (d <= cut)
    assert all(got[r[0]] == (False, None) for r in rows if r[0] not in vec)
    return {i: k for i, (k, _) in got.items()}, group


def vocabulary(r):
    return ["".join(r.choice("aeiounrst") for _ in range(r.randint(2, 9))) for _ in range(500)]


def test_outliers_equal_brute_force(spark):
    r = random.Random(11)
    vocab = vocabulary(r)
    rows = []
    for i in range(400):
        w = [r.choice(vocab) for _ in range(int(r.lognormvariate(4.5, 0.7)) + 12)]
        if i % 20 == 0:
            w = [x + "$$$" for x in w]
        if i % 33 == 0:
            w = ["q" * 40 for _ in w[:9]] + [f"{x}{k}" * 6 for k, x in enumerate(w)]
        rows.append((i, " ".join(w), "en" if i % 2 else "fr", "s" if i % 4 else f"t{i}", 0))
    kept, group = outliers(spark, rows)
    assert {g[0] for g in group.values()} == {0, 1}
    assert 20 <= sum(not kept[i] for i in group) <= 40


def test_outliers_of_small_groups_are_judged_by_larger_ones(spark):
    r = random.Random(13)
    vocab = vocabulary(r)
    rows = []
    for i in range(400):
        w = [r.choice(vocab) for _ in range(int(r.lognormvariate(4.5, 0.5)) + 12)]
        small = i >= 340 and i % 2 == 0  # 30 texts, most of them outliers
        odd = small and i % 6 != 0
        rows.append((i, " ".join(x + "$$$" for x in w) if odd else " ".join(w), "en",
                     "small" if small else "large", 0))
    for i in range(20):  # a language too small for an estimate of its own
        w = [r.choice(vocab) for _ in range(60)]
        rows.append((1000 + i, " ".join(x + "$$$" for x in w) if i % 2 else " ".join(w), "fr", "few", 0))
    kept, group = outliers(spark, rows)
    assert {group[i][0] for i in range(1000, 1020)} == {2}
    assert sum(not kept[i] for i in range(340, 400, 2)) >= 15
    assert [kept[1000 + i] for i in range(20)] == [i % 2 == 0 for i in range(20)]


def test_null_groups_are_groups_of_their_own(spark):
    r = random.Random(17)
    vocab = vocabulary(r)
    groups = [(None, None), (None, "s"), ("en", None), ("en", "s"), (None, "t")]
    rows = []
    for i in range(330):
        w = [r.choice(vocab)[:9 - i % 5] for _ in range(int(r.lognormvariate(4 + i % 5 / 4, 0.5)) + 12)]
        lang, source = groups[i % 5] if i < 300 else (None, f"u{i}")
        rows.append((i, " ".join(w), lang, source, 0))
    _, group = outliers(spark, rows)
    assert {g for g in group.values()} == {(0, g) for g in groups} | {(1, (None,))}


def test_a_table_too_small_for_an_estimate(spark):
    rows = [(i, " ".join(f"word{i}x{k}" for k in range(5 + i)), "en", "s", 0) for i in range(30)]
    kept, group = outliers(spark, rows)
    assert set(group.values()) == {None} and sum(kept.values()) == 25


def test_chi_squared_values():
    # published 0.95 and 0.999 quantiles for 5 degrees of freedom
    assert abs(quality.chi2_quantile(0.95, 5) - 11.0705) < 1e-3
    assert abs(quality.chi2_quantile(0.999, 5) - 20.515) < 1e-3


def test_filters_of_empty_tables(spark):
    none = cases.empty(spark)
    assert quality.quality(none).count() == 0
    assert substring.dedup_substrings(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0
