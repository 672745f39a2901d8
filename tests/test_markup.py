import random
import time

import pytest
from pyspark.sql import functions as F

from catspark.functions import text as T
from catspark.functions.markup import make_strip

STRIP = make_strip()


@pytest.mark.parametrize("markup,text", [
    ("{{a|{| t |}}} x", " x"), ("{{a|}} b", " b"), ("{| [[a|{{b}}]] |} z", " z"),
    ("[[File:x|{{t|[[a|b]]}}c]]", "c"), ("[[a [[b|c]] | d]]", " d"), ("[[x]] [[y|z]]", "x z"),
    ("a [[b {{c]] d}} e", "a b {{c d}} e"),        # the link closes over an open template
    ("a {{b [[c}} d]] e", "a  d]] e"),
    ("un {{ closed [[ x | y", "un {{ closed [[ x | y"), ("}} x ]] |}", "}} x ]] |}"),
    ("{{{p}}}", "{}"), ("a<ref name=x>{{</ref>b<ref/>c", "abc"), ("<!-- {{ --> t <!-- u", " t <!-- u"),
    ("a < b > c", "a  c"), ("a < b", "a < b"), ("<>", "<>"), ("", ""), (None, None),
    ("[http://x.org a label] [https://y.z] [http://q", "a label  [http://q"),
])
def test_marks(markup, text):
    assert STRIP(markup) == text


def test_nowiki_stays_as_written(spark):
    df = spark.createDataFrame([("<nowiki>{{x}} ''k'' [[l|m]]</nowiki> ''b''\n== h ==",), (None,)],
                               "m string")
    got = [r[0] for r in df.select(T.plain_text(F.col("m"))).collect()]
    assert got == ["{{x}} ''k'' [[l|m]] b\nh", None]


def nested(r, depth):
    """(markup, text) of properly nested marks."""
    word = r.choice(["one", "two ", " x", "", "é"])
    if not depth:
        return word, word
    inner, text = zip(*[nested(r, depth - 1) for _ in range(r.randint(1, 3))], strict=True)
    body, plain = "".join(inner), "".join(text)
    kind = r.randrange(5)
    if kind == 0:
        return "{{t|" + body + "}}", ""
    if kind == 1:
        return "{| " + body + " |}", ""
    if kind == 2:
        return "[[target|" + body + "]]", plain
    if kind == 3:
        return "<b>" + body + "</b>", plain
    return word + body, word + plain


def test_interleaved_nesting():
    r = random.Random(8)
    for _ in range(500):
        markup, text = nested(r, r.randint(0, 6))
        assert STRIP(markup) == text, markup


@pytest.mark.parametrize("mark", ["{{ ", "[[ ", "{| ", "[[a|", "<ref>", "<!-- ", "[http://a b ", "}} "])
def test_time_grows_with_the_length(mark):
    t0 = time.time()
    assert len(STRIP(mark * 100_000)) <= len(mark) * 100_000
    assert time.time() - t0 < 10


def test_batches_are_cut_into_slices_of_bounded_text(spark, monkeypatch):
    from catspark.functions import markup
    rows = [(i, None if i % 7 == 0 else "" if i % 5 == 0 else f"{{{{box}}}} [[a|b{i}]] <i>t</i>")
            for i in range(300)]
    df = spark.createDataFrame(rows, "i int, text string").coalesce(1)
    strip = markup.make_strip()
    monkeypatch.setattr(markup, "SLICE_BYTES", 100)  # far less than the batch
    got = dict(df.select("i", markup.strip_marks(F.col("text"))).collect())
    assert got == {i: strip(t) for i, t in rows}
