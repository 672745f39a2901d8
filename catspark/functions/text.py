"""Column-expression text functions: tokeniser, names, link patterns, markup.

Every rewrite is a list of ``(pattern, replacement)`` rules.  The same list is
rendered to Spark columns (Java regex, ``$1`` references) and to DuckDB SQL
text (RE2, ``\\1`` references) for the oracle, so both engines run identical
steps.  Patterns avoid look-around and back-references, which RE2 lacks.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markup import strip_marks, unguarded

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------

# English stopwords: the alphabetic members of the public 2018 English list
# (entries with an apostrophe can never pass the letters-only filter).
STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
mightn mustn needn shan shouldn wasn weren won wouldn
""".split())

# Words the Treebank rules split in two (after lower-casing).
CONTRACTION_SPLITS = {
    "cannot": ("can", "not"), "gimme": ("gim", "me"), "gonna": ("gon", "na"),
    "gotta": ("got", "ta"), "lemme": ("lem", "me"), "wanna": ("wan", "na"),
}

# Link markers in page text.
CATEGORY_MARKER = "[[Category:"
# Article -> category links: lazy name up to the first "|" or "]".
CATEGORY_LINK = r"\[\[Category:(.*?)[|\]]"
# Category page -> parent, exactly as the reference's negated class cuts it.
CATEGORY_LINK_TRUNCATED = r"\[\[Category:([^(.*?)\[|\]]+)"

# Whitespace as Python's str.split() sees it: ASCII whitespace, the
# separators U+001C..U+001F, U+0085 and every Unicode space separator.
WS = r"[\t\n\x0B\f\r \x1c-\x1f\x85\p{Z}]"

# Tokeniser rules (Treebank splits that survive the letters-only filter).
# (The punctuation class and "..."/"--" share one pass: both only turn
# punctuation into a space and neither can create or remove the other's
# matches or a digit after a comma.)
TOKEN_RULES = [
    (r"[«“‘„»”’\"`;@#$%&?!()\[\]{}<>]|\.\.\.|--", " "),
    (r"([,:])([^0-9])", " $2"),
    (r"[,:]\z", " "),
    (r"([^.])\.(" + WS + r"|$)", "$1 $2"),
    (r"(?i)'(s|m|d|ll|re|ve)(" + WS + r"|$)", " $2"),
    (r"(?i)n't(" + WS + r"|$)", " $1"),
    (r"'(" + WS + r"|$)", " $1"),
]
TOKEN_SPLIT = WS + "+"
WORD_PATTERN = r"^[a-z]+$"

class Nested:
    """Rules that rewrite the innermost pair only, repeated as often as marks open (SQL)."""

    def __init__(self, opening: str, closing: str, rules):
        self.opening, self.closing, self.rules = opening, closing, rules


# Markup -> plain text: the marks that nest are read by ``functions.markup``; the
# SQL twin rewrites them pair by pair, which gives the same text where marks nest
# properly.  (Table marks are two characters, so single control characters stand
# in for them meanwhile.)
MARK_RULES = [
    (r"[\x01\x02]", ""),
    (r"(?s)<!--.*?-->", ""),
    Nested("{{", "}}", [(r"\{\{[^{}]*\}\}", "")]),
    (r"\{\|", "\x01"), (r"\|\}", "\x02"),
    Nested("\x01", "\x02", [(r"\x01[^\x01\x02]*\x02", "")]),
    (r"\x01", "{|"), (r"\x02", "|}"),
    (r"(?s)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", ""),
    (r"<[^>]+>", ""),
    Nested("[[", "]]", [(r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"),
                        (r"\[\[([^\[\]|]*)\]\]", "$1")]),
    (r"\[https?://\S+ ([^\]]*)\]", "$1"),
    (r"\[https?://[^\]]*\]", ""),
]
LINE_RULES = [
    (r"'{2,}", ""),
    (r"(?m)^=+\s*(.*?)\s*=+\s*$", "$1"),
]
TRIM_RULE = ("^" + WS + "+|" + WS + r"+\z", "")
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "),
            ("&amp;", "&")]


# ---------------------------------------------------------------------------
# Rendering helpers
# ---------------------------------------------------------------------------

def _java(pattern: str) -> str:
    # Java's "." and "^"/"$" also stop at \r, U+0085, U+2028/9; UNIX_LINES
    # makes them stop at \n only, as in RE2.
    return "(?d)" + pattern


def sql_literal(s: str) -> str:
    """A DuckDB string literal (standard SQL: only quotes are escaped)."""
    return "'" + s.replace("'", "''") + "'"


def _duck_repl(repl: str) -> str:
    return re.sub(r"\$(\d)", r"\\\1", repl)


def apply_rules(col: Column, rules) -> Column:
    for pattern, repl in rules:
        col = F.regexp_replace(col, _java(pattern), repl)
    return col


def apply_rules_sql(expr: str, rules) -> str:
    for rule in rules:
        if isinstance(rule, Nested):
            # one pass per opening mark reaches the same fixed point
            mark = sql_literal(rule.opening)
            body = apply_rules_sql("t", rule.rules)
            n = f"(length(q) - length(replace(q, {mark}, ''))) // {len(rule.opening)}"
            expr = (f"list_transform([{expr}], lambda q: list_reduce(list_prepend(q, "
                    f"list_transform(range({n}), lambda i: '')), lambda t, x: {body}))[1]")
            continue
        pattern, repl = rule
        expr = (f"regexp_replace({expr}, {sql_literal(pattern)}, "
                f"{sql_literal(_duck_repl(repl))}, 'g')")
    return expr


# ---------------------------------------------------------------------------
# Tokeniser
# ---------------------------------------------------------------------------

def _separated(text: Column) -> Column:
    """Lower-cased text whose tokens are parted by white space.

    No rule adds a mark, so the last rules are left out of texts without theirs.
    """
    first, rest = TOKEN_RULES[:2] + [TOKEN_RULES[3]], TOKEN_RULES[2:]
    marks = F.contains(text, F.lit("'")) | F.endswith(text, F.lit(",")) | F.endswith(text, F.lit(":"))
    return F.lower(F.when(marks, apply_rules(text, TOKEN_RULES[:2] + rest))
                   .otherwise(apply_rules(text, first)))


def token_array(text: Column) -> Column:
    """Text -> array of lower-cased raw tokens."""
    return F.split(_separated(text), _java(TOKEN_SPLIT))


def split_token_array(text: Column) -> Column:
    """``token_array`` with the Treebank two-part words split, in the text instead of per token."""
    either = "|".join(f"({a})({b})" for a, b in CONTRACTION_SPLITS.values())
    n = range(1, 2 * len(CONTRACTION_SPLITS), 2)  # groups that did not match are empty
    parts = "".join(f"${i}" for i in n) + " " + "".join(f"${i + 1}" for i in n)
    space = WS[1:-1]
    whole = f"(?<![^{space}])(?:{either})(?![^{space}])"
    lower, separated = F.lower(text), _separated(text)
    held = reduce(or_, [F.contains(lower, F.lit(w)) for w in CONTRACTION_SPLITS])
    return F.split(F.when(held, F.regexp_replace(separated, _java(whole), parts))
                   .otherwise(separated), _java(TOKEN_SPLIT))


def token_array_sql(text_sql: str) -> str:
    return (f"regexp_split_to_array(lower({apply_rules_sql(text_sql, TOKEN_RULES)}), "
            f"{sql_literal(TOKEN_SPLIT)})")


def run_rules() -> list[tuple[re.Pattern, str]]:
    """The tokeniser rules for Python's ``re``."""
    space = WS[:-1].replace(r"\p{Z}", r"\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000") + "]"
    return [(re.compile(p.replace(WS, space).replace(r"\z", r"\Z").replace("(?i)", "(?ai)")),
             r.replace("$", "\\")) for p, r in TOKEN_RULES]


def make_word_counts(max_kept: int = 200_000):
    """Content words of a text with their counts, as a function that carries all it needs.

    Same words as ``is_content_word`` of ``split_token_array``.  No rule looks past the white space
    after a run of other characters, so a run of letters is a token, one mark after it goes, and
    only the other runs are rewritten; what they give is kept for the next text.
    """
    rules = run_rules()
    word = re.compile("[a-z]+")
    stop, parts, kept = frozenset(STOPWORDS), dict(CONTRACTION_SPLITS), {}

    def words_of(run: str) -> tuple[str, ...]:
        run += " "  # what follows a run is white space or the end
        for pattern, replacement in rules:
            run = pattern.sub(replacement, run)
        return tuple(w for t in run.lower().split() for w in parts.get(t, (t,))
                     if word.fullmatch(w) and w not in stop)

    def counts(text: str) -> dict[str, int]:
        found: dict[str, int] = {}
        for run, n in Counter(text.split()).items():
            letters = run if run.isalpha() else run[:-1] if run[-1] in ",.:;!?)" else ""
            if letters.isalpha():
                w = letters.lower()
                if w.isascii() and w not in stop:
                    for w in parts.get(w, (w,)):
                        if w not in stop:
                            found[w] = found.get(w, 0) + n
                continue
            words = kept.get(run)
            if words is None:
                words = words_of(run)
                if len(kept) >= max_kept:
                    kept.clear()
                if len(run) <= 64:
                    kept[run] = words
            for w in words:
                found[w] = found.get(w, 0) + n
        return found

    return counts


def split_contractions(token: Column) -> Column:
    """Token -> array of 1 or 2 tokens (the Treebank two-part words)."""
    out = F.array(token)
    for word, parts in CONTRACTION_SPLITS.items():
        out = F.when(token == word, F.array(*[F.lit(x) for x in parts])).otherwise(out)
    return out


def split_contractions_sql(tok: str) -> str:
    whens = " ".join(f"WHEN {sql_literal(w)} THEN [{', '.join(sql_literal(x) for x in parts)}]"
                     for w, parts in CONTRACTION_SPLITS.items())
    return f"CASE {tok} {whens} ELSE [{tok}] END"


def is_word(token: Column) -> Column:
    """Letters-only token."""
    return token.rlike(WORD_PATTERN)


def is_content_word(token: Column) -> Column:
    """Letters-only and not a stopword (T2 + T3)."""
    return is_word(token) & ~token.isin(*STOPWORDS)


def stopword_list_sql() -> str:
    return ", ".join(sql_literal(w) for w in STOPWORDS)


def content_word_sql(tok: str) -> str:
    return (f"regexp_matches({tok}, {sql_literal(WORD_PATTERN)}) "
            f"AND {tok} NOT IN ({stopword_list_sql()})")


# ---------------------------------------------------------------------------
# Names and links
# ---------------------------------------------------------------------------

def norm_name(name: Column) -> Column:
    """Collapse whitespace runs, trim, spaces -> "_" (P5)."""
    collapsed = F.regexp_replace(name, WS + "+", " ")
    return F.regexp_replace(F.regexp_replace(collapsed, "^ | $", ""), " ", "_")


def norm_name_sql(expr: str) -> str:
    collapsed = f"regexp_replace({expr}, {sql_literal(WS + '+')}, ' ', 'g')"
    return f"replace(regexp_replace({collapsed}, '^ | $', '', 'g'), ' ', '_')"


def category_links(text: Column, truncate: bool = False) -> Column:
    """All category names linked from ``text`` (raw, not normalised)."""
    pattern = CATEGORY_LINK_TRUNCATED if truncate else CATEGORY_LINK
    return F.regexp_extract_all(text, F.lit(_java(pattern)), 1)


def category_links_sql(expr: str, truncate: bool = False) -> str:
    pattern = CATEGORY_LINK_TRUNCATED if truncate else CATEGORY_LINK
    return f"regexp_extract_all({expr}, {sql_literal(pattern)}, 1)"


# ---------------------------------------------------------------------------
# Markup (P9)
# ---------------------------------------------------------------------------

def plain_text(markup: Column) -> Column:
    col = apply_rules(strip_marks(markup), LINE_RULES)
    for ent, ch in ENTITIES:
        col = F.replace(col, F.lit(ent), F.lit(ch))
    return apply_rules(unguarded(col), [TRIM_RULE])


def plain_text_sql(expr: str) -> str:
    expr = apply_rules_sql(expr, MARK_RULES + LINE_RULES)
    for ent, ch in ENTITIES:
        expr = f"replace({expr}, {sql_literal(ent)}, {sql_literal(ch)})"
    return apply_rules_sql(expr, [TRIM_RULE])
