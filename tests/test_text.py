import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catspark.functions import text as T
from catspark.functions.porter import IRREGULAR, make_stemmer, stem_words
from catspark.operators import index as I
from porter_reference import stem as ref_stem

PUBLISHED = dict(zip(
    "caresses flies dies mules denied died agreed owned humbled sized meeting stating "
    "siezing itemization sensational traditional reference colonizer plotted ponies "
    "hopping relational conditional generalizations oscillators happy sky dying".split(),
    "caress fli die mule deni die agre own humbl size meet state siez item sensat tradit "
    "refer colon plot poni hop relat condit gener oscil happi sky die".split()))


def _stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "word string")
    return {r.word: r.stem for r in stem_words(df).collect()}


def test_published_stems(spark):
    assert _stems(spark, list(PUBLISHED)) == PUBLISHED


def test_stems_match_reference_on_random_words(spark):
    rng = random.Random(7)
    alpha = "aeiouyybcdlmnrst"
    sufs = ["", "ies", "ied", "ing", "ed", "eed", "ational", "alli", "logi", "ement", "ion",
            "y", "yy", "ful", "ness", "e", "ll", "s"]
    words = sorted({"".join(rng.choice(alpha) for _ in range(rng.randint(1, 8)))
                    + rng.choice(sufs) for _ in range(3000)})
    got = _stems(spark, words)
    assert [w for w in words if got[w] != ref_stem(w)] == []


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="abcdeilmnorstuy", min_size=1, max_size=12),
                min_size=1, max_size=30))
def test_stems_property(spark, words):
    got = _stems(spark, sorted(set(words)))
    assert all(got[w] == ref_stem(w) for w in set(words))


def test_tokeniser_small_case(spark):
    text = ("don't x-ray a,b 1,000 U.S. it's well-known café end. \"Quoted\" word; "
            "(paren) 3d last.")
    df = spark.createDataFrame([("p", text)], "title string, text string")
    toks = [r.token for r in I.alpha_tokens(I.tokens(df)).collect()]
    assert toks == "do a b it end quoted word paren last".split()
    content = [r.token for r in I.content_tokens(I.tokens(df)).collect()]
    assert content == "b end quoted word paren last".split()


def test_norm_name(spark):
    df = spark.createDataFrame([("a  b\u001c\u0085 c　",)], "n string")
    assert df.select(T.norm_name(F.col("n"))).first()[0] == "a_b_c"


def test_markup_to_plain_text(spark):
    markup = ("Body '''bold''' [[link|shown]] [[Plain]] {{t|{{u}}|x}}<ref name=\"a\" />"
              "<ref>r\nq</ref>\n== Head ==\n[http://e.org site] [https://f.org] <b>in</b>"
              "<!-- c\nd --> {| a\n|} end")
    df = spark.createDataFrame([(markup,)], "m string")
    assert df.select(T.plain_text(F.col("m"))).first()[0] == \
        "Body bold shown Plain \nHead\nsite  in  end"


def test_markup_nested_to_any_depth(spark):
    deep = "a " + "{{x|" * 10 + "y" + "}}" * 10 + " b"
    cases = {deep: "a  b",
             "[[File:x|thumb|see [[Paris]] and [[Rome|the city]] here]] z":
                 "thumb|see Paris and the city here z",
             "{| a {| b |} c |} d": "d",
             "{{open [[Left": "{{open [[Left",
             "{{" * 300 + "z" + "}}" * 300: ""}
    df = spark.createDataFrame([(m, t) for m, t in cases.items()], "m string, want string")
    for r in df.select("want", T.plain_text(F.col("m")).alias("got")).collect():
        assert r["got"] == r["want"]


# Word and stem pairs as the algorithm's publication prints them, written out here so that a
# wrong rule list in the code cannot agree with itself.
PRINTED = """caresses caress, ponies poni, caress caress, cats cat, feed feed, agreed agre,
plastered plaster, bled bled, motoring motor, sing sing, conflated conflat, troubled troubl,
sized size, hopping hop, tanned tan, falling fall, hissing hiss, fizzed fizz, failing fail,
filing file, happy happi, relational relat, conditional condit, rational ration, valenci valenc,
digitizer digit, conformabli conform, radicalli radic, differentli differ, vileli vile,
analogousli analog, vietnamization vietnam, predication predic, operator oper, feudalism feudal,
decisiveness decis, hopefulness hope, callousness callous, formaliti formal, sensitiviti sensit,
sensibiliti sensibl, triplicate triplic, formative form, formalize formal, electriciti electr,
electrical electr, hopeful hope, goodness good, revival reviv, allowance allow, inference infer,
airliner airlin, adjustable adjust, defensible defens, irritant irrit, replacement replac,
adjustment adjust, dependent depend, adoption adopt, homologou homolog, communism commun,
activate activ, angulariti angular, homologous homolog, effective effect, bowdlerize bowdler,
probate probat, rate rate, cease ceas, controll control, roll roll"""


def test_stems_as_printed(spark):
    want = dict(x.split() for x in PRINTED.split(","))
    assert _stems(spark, list(want)) == want


def test_two_part_words(spark):
    df = spark.createDataFrame([("p", "I cannot go, Gonna wait; gimme that")],
                               "title string, text string")
    toks = [r.token for r in I.tokens(df).collect()]
    assert toks == "i can not go gon na wait gim me that".split()


def test_two_part_words_split_in_the_text_as_per_token(spark):
    r = random.Random(4)
    bits = ["cannot", "gonna", "Wanna", "CANNOT", "n't", "'s", "'", ",", ":", ".", "...", " ", "\n",
            "\x85", "\x1f", "x", "3", "(", "gimmes", "cannot's", "lemme", "gotta,", "\u0130"]
    rows = [(str(i), "".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(0, 9))))
            for i in range(2000)] + [("n", None), ("e", "")]
    texts = spark.createDataFrame(rows, "title string, text string")
    plain = F.split(F.lower(T.apply_rules(F.col("text"), T.TOKEN_RULES)), "(?d)" + T.TOKEN_SPLIT)
    want = (texts.where("text IS NOT NULL").select("title", F.explode(plain).alias("token"))
            .where("token <> ''").select("title", F.explode(T.split_contractions(F.col("token")))))
    got = I.tokens(texts)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_written_counts_hold_the_totals_of_documents(spark):
    texts = spark.createDataFrame([("a", "red reds blue"), ("a", "red green"), (None, "blue"),
                                   (None, "sky"), ("c", None)], "title string, text string")
    idx = I.Index(texts)
    plan = idx.postings._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    got = sorted((r.title or "", r.word, round(r.tf, 6)) for r in idx.postings.collect())
    assert got == [("", "blue", 0.5), ("", "sky", 0.5), ("a", "blue", 0.2), ("a", "green", 0.2),
                   ("a", "red", 0.6)]
    assert idx.counts.columns == ["title", "word", "n"]


def test_counts_of_a_row_equal_the_token_rules(spark):
    """One pass over a row gives the words of the rules; rows of a title are added up."""
    odd = ["I cannot, don't! it's (gonna) ...a.b a... U.S. Mr. x,, y:z 1,000 n't 'S", "K K İ ſ 'ſ",
           "word.Word word. word, Word;\x1cword\x85word ​word", "", " , .", "a--b é. rock'n'roll'",
           "wanna. Lemme\ncannot's", None]
    df = spark.createDataFrame(list(enumerate(odd)), "title int, text string")
    want = (I.content_tokens(I.tokens(df)).groupBy("title", "token").agg(F.count(F.lit(1)).alias("n")))
    assert {tuple(r) for r in I.row_counts(df).collect()} == {tuple(r) for r in want.collect()}
    twice = df.withColumn("title", F.col("title") % 2).unionByName(df.withColumn(
        "title", F.lit(None).cast("int")))
    want = (I.content_tokens(I.tokens(twice)).groupBy("title", "token").agg(F.count(F.lit(1)).alias("n")))
    for got in (I.raw_counts(twice), I.Index(twice, stem=False).counts):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF(*got.columns).collect()))


def test_stems_of_a_task_equal_the_sql_steps(spark):
    r = random.Random(3)
    ends = ["", "s", "ies", "ied", "eed", "ed", "ing", "ational", "logi", "alli", "ion", "sion", "ement",
            "y", "ll", "e", "yed", "ness"]
    words = {"".join(r.choice("abcdelostyyz") for _ in range(r.randint(1, 6))) + r.choice(ends)
             for _ in range(3000)} | set(IRREGULAR)
    stem = make_stemmer(max_kept=50)
    assert {w: stem(w) for w in words} == _stems(spark, list(words))


def test_rows_of_a_title_apart_from_each_other_are_added_up(spark, monkeypatch):
    """Rows in sequence are one run; only titles of several runs are moved, nulls among them."""
    rows = [("a", "red reds cats"), ("a", "red"), ("b", "cat"), ("a", "blue"), (None, "sky"), ("c", None),
            (None, "sky skies"), ("b", "cat dog"), ("d", "sun")] * 2
    texts = spark.createDataFrame(rows, "title string, text string")
    want = Counter()
    for title, text in rows:
        for w in (text or "").split():
            want[title, {"reds": "red", "cats": "cat", "skies": "sky"}.get(w, w)] += 1
    for most in (200_000, 1):
        monkeypatch.setattr(I, "RUN_WORDS", most)
        for df, lines in ((texts.coalesce(1), True), (texts.repartition(4), False)):
            got = I.counts_with_totals(df, lines=lines).collect()
            assert {(r.title, r.word): r.n for r in got} == dict(want) and len(got) == len(want)
            for r in got:
                assert r.total == sum(n for (t, _), n in want.items() if t == r.title)


def test_counts_of_whole_documents_do_not_move(spark):
    texts = spark.createDataFrame([(f"t{i}", "cats run " * (i % 3)) for i in range(40)],
                                  "title string, text string")
    for counts in (I.term_counts(texts), I.Index(texts).counts):
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
