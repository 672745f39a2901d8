"""Porter (1980) stemmer, with the common public extensions, as SQL steps.

The stemmer is a list of projections over two working columns: ``w`` (the
word as stemmed so far) and ``cv`` (its consonant/vowel pattern, one ``c`` or
``v`` per letter; ``y`` is a vowel only after a consonant).  Each step is a
CASE expression of ``LIKE`` suffix tests and prefix slices, written in the SQL
subset that Spark SQL and DuckDB share, so the oracle runs the very same
steps.  Only the ``cv`` fold differs by dialect (lambda syntax).

It is meant to run on the distinct vocabulary, never per token occurrence.
``make_stemmer`` runs the same steps in a task that counts words, where a stem that is known is
looked up, so that counts need not move to meet their stems.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (published algorithm + the extension list)
# ---------------------------------------------------------------------------

# Irregular forms returned as is (form -> stem).
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Step 2 suffix rules (suffix, replacement); condition m > 0 on the stem.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
# Step 3 suffix rules; condition m > 0.
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
# Step 4 suffixes removed when m > 1 ("ion" also needs a stem ending s or t).
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


# ---------------------------------------------------------------------------
# SQL snippets over columns w / cv
# ---------------------------------------------------------------------------

_LETTERS = "abcdefghijklmnopqrstuvwxyzY"
_CV_MAP = "".join("v" if ch in "aeiouY" else "c" for ch in _LETTERS)


def _mark_expr(dialect: str, word: str) -> str:
    """The word with every vowel-y upper-cased (``Y``).  A y is a vowel only
    after a consonant; steps only cut suffixes and append y-free text, so a
    y's role never changes and this one fold serves every step."""
    body = ("concat(acc, CASE WHEN x = 'y' AND acc <> '' AND right(acc, 1) NOT IN "
            "('a','e','i','o','u','Y') THEN 'Y' ELSE x END)")
    if dialect == "spark":
        return f"aggregate(split({word}, ''), '', (acc, x) -> {body})"
    return f"list_reduce(string_split({word}, ''), lambda acc, x: {body}, '')"


def _cv_expr(dialect: str = "spark") -> str:
    return f"translate(w, '{_LETTERS}', '{_CV_MAP}')"


def _ends(suffix: str) -> str:
    return f"w LIKE '%{suffix}'"


def _cut(n: int) -> str:
    """The word without its last ``n`` letters."""
    return f"left(w, length(w) - {n})" if n else "w"


def _repl(n: int, repl: str) -> str:
    return f"concat({_cut(n)}, '{repl}')" if repl else _cut(n)


def _cvs(n: int) -> str:
    """cv pattern of the stem (word minus last ``n`` letters)."""
    return f"left(cv, length(w) - {n})" if n else "cv"


def _m_gt0(n: int) -> str:
    return f"{_cvs(n)} LIKE '%vc%'"


def _m_gt1(n: int) -> str:
    return f"{_cvs(n)} LIKE '%vc%vc%'"


def _m_eq1(n: int) -> str:
    return f"({_m_gt0(n)} AND NOT {_m_gt1(n)})"


def _has_vowel(n: int) -> str:
    return f"{_cvs(n)} LIKE '%v%'"


def _cvc(n: int) -> str:
    """*o: stem ends consonant-vowel-consonant, last not w/x/y (or is vc)."""
    last = f"substr(w, length(w) - {n}, 1)"
    return (f"((length(w) - {n} >= 3 AND right({_cvs(n)}, 3) = 'cvc' "
            f"AND {last} NOT IN ('w','x','y')) OR (length(w) - {n} = 2 AND {_cvs(n)} = 'vc'))")


def _double_consonant() -> str:
    return ("(length(w) >= 2 AND lower(right(w, 1)) = lower(left(right(w, 2), 1)) "
            "AND right(cv, 1) = 'c')")


def _rule_list(rules) -> str:
    """First matching suffix decides; a failed condition keeps the word."""
    whens = " ".join(
        f"WHEN {_ends(suf)} THEN (CASE WHEN {cond} THEN {_repl(len(suf), rep)} ELSE w END)"
        for suf, rep, cond in rules)
    return f"CASE {whens} ELSE w END"


def stem_steps() -> list[tuple[str, str]]:
    """Ordered (column, expression) assignments; ``cv`` is refreshed before each."""
    step1a = ("CASE WHEN w LIKE '%ies' AND length(w) = 4 THEN concat(left(w, 1), 'ie') "
              "WHEN w LIKE '%sses' THEN left(w, length(w) - 2) "
              "WHEN w LIKE '%ies' THEN left(w, length(w) - 2) "
              "WHEN w LIKE '%ss' THEN w "
              "WHEN w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END")
    # step 1b, first half: strip -ied/-eed/-ed/-ing; f marks ed/ing success
    step1b_f = (f"({_ends('ed')} AND NOT {_ends('eed')} AND NOT {_ends('ied')} "
                f"AND {_has_vowel(2)}) OR ({_ends('ing')} AND {_has_vowel(3)})")
    step1b = ("CASE WHEN w LIKE '%ied' THEN (CASE WHEN length(w) = 4 "
              "THEN concat(left(w, 1), 'ie') ELSE concat(left(w, length(w) - 3), 'i') END) "
              f"WHEN w LIKE '%eed' THEN (CASE WHEN {_m_gt0(3)} "
              "THEN left(w, length(w) - 1) ELSE w END) "
              f"WHEN w LIKE '%ed' AND {_has_vowel(2)} THEN left(w, length(w) - 2) "
              f"WHEN w LIKE '%ing' AND {_has_vowel(3)} THEN left(w, length(w) - 3) "
              "ELSE w END")
    step1b2 = ("CASE WHEN NOT f THEN w "
               "WHEN w LIKE '%at' OR w LIKE '%bl' OR w LIKE '%iz' THEN concat(w, 'e') "
               f"WHEN {_double_consonant()} THEN (CASE WHEN right(w, 1) NOT IN ('l','s','z') "
               "THEN left(w, length(w) - 1) ELSE w END) "
               f"WHEN {_m_eq1(0)} AND {_cvc(0)} THEN concat(w, 'e') ELSE w END")
    step1c = ("CASE WHEN lower(right(w, 1)) = 'y' AND length(w) > 2 "
              "AND substr(cv, length(w) - 1, 1) = 'c' "
              "THEN concat(left(w, length(w) - 1), 'i') ELSE w END")
    step2a = (f"CASE WHEN {_ends('alli')} AND {_m_gt0(4)} "
              "THEN concat(left(w, length(w) - 4), 'al') ELSE w END")
    # "logi" -> "log" tests the measure with the "l" kept in the stem.
    step2 = _rule_list([(s, r, _m_gt0(len(s))) for s, r in STEP2]
                       + [("logi", "log", _m_gt0(3))])
    step3 = _rule_list([(s, r, _m_gt0(len(s))) for s, r in STEP3])
    step4 = _rule_list([
        (s, "", (f"({_m_gt1(3)} AND substr(w, length(w) - 3, 1) IN ('s','t'))"
                 if s == "ion" else _m_gt1(len(s))))
        for s in STEP4])
    step5a = (f"CASE WHEN {_ends('e')} AND ({_m_gt1(1)} OR ({_m_eq1(1)} AND NOT {_cvc(1)})) "
              "THEN left(w, length(w) - 1) ELSE w END")
    step5b = (f"CASE WHEN {_ends('ll')} AND {_m_gt1(1)} "
              "THEN left(w, length(w) - 1) ELSE w END")
    return [("w", step1a), ("f", step1b_f), ("w", step1b), ("w", step1b2),
            ("w", step1c), ("w", step2a), ("w", step2), ("w", step3), ("w", step4),
            ("w", step5a), ("w", step5b)]


def _final(word: str) -> str:
    pool = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())
    return (f"CASE WHEN length({word}) <= 2 THEN {word} "
            f"ELSE coalesce(CASE {word} {pool} END, lower(w)) END")


def stem_words(words: DataFrame, word: str = "word", out: str = "stem") -> DataFrame:
    """Add ``out`` = Porter stem of ``word`` (lower-case letters only)."""
    df = words.withColumn("w", F.expr(_mark_expr("spark", word)))
    cv = F.expr(_cv_expr())
    for name, expr in stem_steps():
        df = df.withColumn("cv", cv).withColumn(name, F.expr(expr))
    return df.withColumn(out, F.expr(_final(word))).drop("w", "cv", "f")


def stem_words_sql(source_sql: str, word: str = "word", out: str = "stem") -> str:
    """DuckDB SQL adding ``out`` to the rows of ``source_sql``."""
    cv = _cv_expr()
    sql = (f"SELECT *, {_mark_expr('duckdb', word)} AS w, CAST(NULL AS BOOLEAN) AS f "
           f"FROM ({source_sql})")
    for name, expr in stem_steps():
        with_cv = f"SELECT *, {cv} AS cv FROM ({sql})"
        sql = f"SELECT * EXCLUDE (cv, {name}), {expr} AS {name} FROM ({with_cv})"
    return f"SELECT * EXCLUDE (w, f), {_final(word)} AS {out} FROM ({sql})"


# ---------------------------------------------------------------------------
# The same steps within a task
# ---------------------------------------------------------------------------

def make_stemmer(max_kept: int = 300_000):
    """Stem of a word of the letters a-z, as a function that carries all it needs."""
    irregular, step2, step3, step4 = dict(IRREGULAR), [*STEP2], [*STEP3], [*STEP4]
    pattern, kept = str.maketrans(_LETTERS, _CV_MAP), {}

    def marked(word: str) -> str:
        if "y" not in word[1:]:
            return word
        out = word[0]
        for x in word[1:]:
            out += "Y" if x == "y" and out[-1] not in "aeiouY" else x
        return out

    def m(w: str, cut: int = 0) -> int:
        return w[:len(w) - cut].translate(pattern).count("vc")

    def vowel(w: str, cut: int) -> bool:
        return "v" in w[:len(w) - cut].translate(pattern)

    def cvc(w: str, cut: int = 0) -> bool:
        w = w[:len(w) - cut]
        cv = w.translate(pattern)
        return cv == "vc" or (cv[-3:] == "cvc" and w[-1] not in "wxy")

    def first_rule(w: str, rules, least: int) -> str:
        for suffix, replacement in rules:
            if w.endswith(suffix):
                # "logi" tests the measure with the "l" kept in the stem
                cut = 3 if suffix == "logi" else len(suffix)
                held = m(w, cut) > least and (suffix != "ion" or w[-4:-3] in ("s", "t"))
                return w[:len(w) - len(suffix)] + replacement if held else w
        return w

    step2.append(("logi", "log"))
    step4 = [(suffix, "") for suffix in step4]

    def steps(word: str) -> str:
        if len(word) <= 2:
            return word
        if word in irregular:
            return irregular[word]
        w = marked(word)
        if w.endswith("ies") and len(w) == 4:
            w = w[0] + "ie"
        elif w.endswith(("sses", "ies")):
            w = w[:-2]
        elif w.endswith("s") and not w.endswith("ss"):
            w = w[:-1]
        if w.endswith("ied"):
            w = w[0] + "ie" if len(w) == 4 else w[:-3] + "i"
        elif w.endswith("eed"):
            w = w[:-1] if m(w, 3) > 0 else w
        else:
            cut = 2 if w.endswith("ed") and vowel(w, 2) else 3 if w.endswith("ing") and vowel(w, 3) else 0
            if cut:
                w = w[:-cut]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif (len(w) >= 2 and w[-1].lower() == w[-2].lower()
                      and w[-1].translate(pattern) == "c"):
                    w = w if w[-1] in "lsz" else w[:-1]
                elif m(w) == 1 and cvc(w):
                    w += "e"
        if len(w) > 2 and w[-1] in "yY" and w[-2].translate(pattern) == "c":
            w = w[:-1] + "i"
        if w.endswith("alli") and m(w, 4) > 0:
            w = w[:-2]
        w = first_rule(w, step2, 0)
        w = first_rule(w, step3, 0)
        w = first_rule(w, step4, 1)
        if w.endswith("e") and (m(w, 1) > 1 or (m(w, 1) == 1 and not cvc(w, 1))):
            w = w[:-1]
        if w.endswith("ll") and m(w, 1) > 1:
            w = w[:-1]
        return w.lower()

    def stem(word: str) -> str:
        found = kept.get(word)
        if found is None:
            if len(kept) >= max_kept:
                kept.clear()
            found = kept[word] = steps(word)
        return found

    return stem
