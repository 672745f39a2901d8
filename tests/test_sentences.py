import math
import random
from collections import Counter

from pyspark.sql import functions as F

from catspark.functions import text as T
from catspark.operators import index as I
from catspark.operators import sentences as S


def corpus(spark, n=120):
    r = random.Random(5)
    names, verbs = ["Smith", "Jones", "Brown", "Miller"], ["walked", "slept", "talked", "waited"]
    places = [f"town{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        lines = [f"{r.choice(['The', 'Then', 'But'])} {r.choice(['Mr.', 'Dr.', 'mr.'])} "
                 f"{r.choice(names)} {r.choice(verbs)} past {r.choice(places)} to {r.choice(places)}."
                 for _ in range(5)]
        rows.append((str(i), " ".join(lines)))
    rows += [("end", "He met the Dr."), ("none", None), ("empty", "")]
    return spark.createDataFrame(rows, "title string, text string"), rows


def test_abbreviations_keep_their_period(spark):
    df, rows = corpus(spark)
    found = S.words(df)
    abbrs = {r["type"] for r in S.abbreviations(found).collect()}
    assert {"mr", "dr"} <= abbrs and not any(a.startswith("town") for a in abbrs)
    assert {r["type"] for r in S.sentence_starters(found, S.abbreviations(found)).collect()} == {
        "the", "then", "but"}
    got = Counter((r["title"], r["token"]) for r in S.sentence_tokens(df).collect())
    words = Counter(t for _, t in got.elements())
    assert words["mr"] == 0 and words["mr."] > 100
    assert words["dr"] == 1 and got["end", "dr"] == 1      # the text ends there
    assert sum(n for w, n in words.items() if w.startswith("town")) == 1200
    # letters-only tokens: those of the plain tokeniser without the abbreviations
    plain = Counter((r["title"], r["token"]) for r in I.tokens(df).collect())
    plain = Counter({k: n for k, n in plain.items() if k[1] not in ("mr", "dr")})
    kept = Counter({k: n for k, n in got.items() if k[1] not in ("mr.", "dr.", "dr")})
    assert kept == plain


def test_scores_equal_the_published_formulas(spark):
    df, rows = corpus(spark)
    total, with_, without = 0, Counter(), Counter()
    for _, text in rows:
        for w in (text or "").split():
            bare = w.lower().rstrip(".")
            total += 1
            (with_ if w.endswith(".") else without)[bare] += 1
    p = sum(with_.values()) / total
    for r in S.abbreviations(S.words(df)).collect():
        a, b = with_[r["type"]], without[r["type"]]
        assert (r["n_with"], r["n_without"]) == (a, b)
        ratio = -2 * (a * math.log(p) + b * math.log(1 - p)
                      - a * math.log(0.99) - b * math.log(0.01))
        n = len(r["type"])
        assert abs(r["score"] - ratio * math.exp(-n) * n ** -b) < 1e-9


def test_words_split_alone_give_the_same_tokens(spark):
    texts = ["It's (really) 3,000 \"quoted\" words: a,b c, d. e.f. end...", "can't won't I'll 'tis it's.",
             "x -- y...z (a.) [b.] {c}. \"d.\""]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "title string, text string")
    whole = Counter(tuple(r) for r in I.tokens(df).select("title", "token").collect())
    alone = (S.words(df).select("title", F.explode(T.token_array(F.col("raw"))).alias("token"))
             .where("token <> ''").select("title", F.explode(T.split_contractions(F.col("token")))))
    assert Counter(tuple(r) for r in alone.collect()) == whole


def test_counted_words_give_the_same_models_and_split_texts_once(spark):
    from pyspark.sql import functions as F

    from catspark.sources.tables import texts
    from conftest import SF0001
    found = S.words(texts(spark, SF0001).union(spark.createDataFrame(
        [("x", "Mr. Lee met Mr. Ode. The end. The sky. The"), (None, "Mr. A"), ("y", None)],
        "title string, text string")))
    counts = S.counted(found)
    assert counts.agg(F.sum("k")).first()[0] == found.where("type IS NOT NULL").count()
    rows = lambda df: sorted(map(tuple, df.collect()))
    abbrs = S.abbreviations(counts)
    assert rows(abbrs) == rows(S.abbreviations(found))
    starts = S.sentence_starters(counts, abbrs)
    assert rows(starts) == rows(S.sentence_starters(found, abbrs))
    assert not any("documents" in f for f in counts.inputFiles())  # read from the written counts


ODD = ["Mr. Smith's (cat) can't. It... is 'here'", "gonna cannot. Wanna, U.S. e.g. The.%%% ende.### q***", ". , ... --", "",
       "Élan Ñoño. ÄÖ. ßen, ΑΣ. Σ İstanbul. ﬁn.\xa0x\x85y z\x1cw", "a.b.c. 1,000 3.14. x-y. Dr.\n\nAnd Mr.,", "²x x² Ⅷ. ǅ. ª. ñ.&&& a..  .a. a.:b",
       "Dr. Dr. mr. The end", "K ſ 'ſ don't'S", "word." * 40, "A" * 80 + ". b", None]


def _token_rows(found, counts):
    """The tokens by columns: every word is worked out where it stands."""
    abbrs = S.abbreviations(counts)
    starts = S.sentence_starters(counts, abbrs)
    abbrs, starts = ({r["type"] for r in x.collect()} for x in (abbrs, starts))
    rows = found.select("*", T.split_token_array(F.col("raw")).alias("t")).collect()
    return Counter((r["title"], t) for r in rows for t in (
        [r["core"]] if r["period"] and r["type"] in abbrs and r["next_type"] is not None
        and not (r["next_type"] in starts and r["next_capital"]) else r["t"]) if t)


def test_words_read_in_tasks_equal_the_columns(spark, monkeypatch):
    df, rows = corpus(spark)
    texts = df.unionByName(spark.createDataFrame(
        [(None if i == 3 else f"odd{i}", t) for i, t in enumerate(ODD)] * 2, df.schema))
    found = S.words(texts)
    counts = S.counted(found)
    want = Counter(map(tuple, counts.collect()))
    small = S.make_word_parts, S.make_runs
    for cuts in (False, True):
        if cuts:  # long texts are read in parts, words are forgotten
            monkeypatch.setattr(S, "make_word_parts", lambda: small[0](max_kept=3))
            monkeypatch.setattr(S, "make_runs", lambda: small[1](most=4))
        assert Counter(map(tuple, S.counted_words(texts).select(*counts.columns).collect())) == want
        got = Counter((r["title"], r["token"]) for r in S.sentence_tokens(texts).collect())
        assert got == _token_rows(found, counts)
        assert got["odd7", "dr."] == 4


def test_words_are_not_taken_apart_by_the_plan(spark):
    """The texts are split in the tasks that read them; no pattern runs per row of a word."""
    plan = S.sentence_tokens(corpus(spark)[0])._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "RLIKE" not in plan
