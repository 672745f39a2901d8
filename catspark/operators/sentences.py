"""Abbreviations and sentence starters learnt from the corpus (T1 with sentences).

A word with a period at its end is an abbreviation if periods follow it much
more often than words in general: the log-likelihood ratio of Kiss and Strunk
(2006, "Unsupervised multilingual sentence boundary detection"), weighed by
its length, its inner periods and how often it comes without a period.  A word
starts sentences if it follows other periods far more often than chance has
it.  Both models are aggregates over all texts, applied by joins on the word.
``words`` says it in columns; ``sentence_tokens`` reads words within tasks, which look up
a word that they have seen.

Abbreviations keep their period inside a sentence, so ``Mr.`` is no letters-only
token and leaves the counts, while the last word of a sentence stays in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from ..functions import text as T
from ..session import materialise
from .index import spread

#: fixed values of the published method
ABBREVIATION, STARTER, P_ABBREVIATION = 0.3, 30.0, 0.99

EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}.]+\z"
ENDS_SENTENCE = r"[^.]\.\z"
TYPE = r"^\p{L}[\p{L}\p{N}.\-]*\z"
CAPITAL = r"^[^\p{L}\p{N}]*\p{Lu}"


def _core(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), EDGES, "")


def _type(core: Column) -> Column:
    """The word without its last period; null where it is no word."""
    bare = F.regexp_replace(core, r"\.+\z", "")
    return F.when(bare.rlike(TYPE), bare)


def words(texts: DataFrame) -> DataFrame:
    """(title, raw, core, type, period, next_type, next_capital): every word and what follows it."""
    split = F.filter(F.split(F.col("text"), T.WS + "+"), lambda w: w != "")
    pairs = F.transform(F.col("w"), lambda w, i: F.struct(
        w.alias("raw"), F.get(F.col("w"), i + 1).alias("next")))
    rows = (texts.where(F.col("text").isNotNull()).select("title", split.alias("w"))
            .select("title", F.explode(pairs).alias("p")).select("title", "p.raw", "p.next"))
    core = rows.withColumn("core", _core(F.col("raw"))).withColumn("_n", _core(F.col("next")))
    return core.select("title", "raw", "core", _type(F.col("core")).alias("type"),
                       F.col("core").rlike(ENDS_SENTENCE).alias("period"),
                       _type(F.col("_n")).alias("next_type"),
                       F.coalesce(F.col("next").rlike(CAPITAL), F.lit(False)).alias("next_capital"))


def counted(found: DataFrame) -> DataFrame:
    """(type, period, next_type, k), written: how often each word comes, by what follows its period.

    Both models read this table in place of ``words``, so the texts are split once."""
    follows = F.when(F.col("period"), F.col("next_type")).alias("next_type")
    rows = found.where("type IS NOT NULL").groupBy("type", "period", follows)
    return materialise(rows.agg(F.count(F.lit(1)).alias("k")), "counted_words")


def make_word_parts(max_kept: int = 200_000):
    """What ``words`` says of a single word, as a function that carries all it needs.

    The result looks up ``word -> (core, type, period, capital, tokens)``; tokens are those of
    ``token_array`` with the two-part words split.  Words that were seen are kept.
    """
    import re
    from unicodedata import category
    rules, parts = T.run_rules(), dict(T.CONTRACTION_SPLITS)
    kind_of = lambda x: category(x)[0]
    typed = re.compile(r"[a-z][a-z0-9.\-]*")
    plain = re.compile(r"([^\W\d_]+)(\.?)([;@#$%&?!()\[\]{}<>\"`]*|[,:])").fullmatch

    def known(word: str):
        # letters and marks behind them: what the steps below give
        simple = plain(word)
        if simple:
            letters, period, _ = simple.groups()
            core = letters.lower()
            if letters.isalpha() and core.isalpha():
                return core + period, core, period == ".", category(letters[0]) == "Lu", parts.get(core, (core,))
        core, end = word.lower(), len(word.lower())
        start = next((i for i, x in enumerate(core) if kind_of(x) in "LN"), end)
        while end > start and core[end - 1] != "." and kind_of(core[end - 1]) not in "LN":
            end -= 1
        core = core[start:end]
        bare = core.rstrip(".")
        if bare.isascii():
            is_type = typed.fullmatch(bare) is not None
        else:
            is_type = kind_of(bare[0]) == "L" and all(x in ".-" or kind_of(x) in "LN" for x in bare)
        first = next((x for x in word if kind_of(x) in "LN"), None)
        run = word
        for pattern, replacement in rules:
            run = pattern.sub(replacement, run)
        tokens = tuple(x for t in run.lower().split() for x in parts.get(t, (t,)))
        return (core, bare if is_type else None, core.endswith(".") and core[-2:-1] not in ("", "."),
                first is not None and category(first) == "Lu", tokens)

    class Words(dict):
        """Kept words; those of the time before are forgotten unless they come again."""
        before: dict = {}

        def __missing__(self, word):
            found = self.before.get(word) or known(word)
            if len(self) >= max_kept:
                self.before = dict(self)
                self.clear()
            if len(word) <= 64:
                self[word] = found
            return found

    return Words()


def make_runs(most: int = 1_000_000):
    """Lists of the words of a text, about ``most`` characters a list, the next word with each list."""
    import re
    space = re.compile(r"\s")

    def runs(text: str):
        held, at = [], 0
        while at < len(text):
            cut = space.search(text, at + most) if at + most < len(text) else None
            end = cut.start() if cut else len(text)
            held += text[at:end].split()
            at = end
            if len(held) > 1 and at < len(text):
                yield held[:-1], held[-1]
                held = held[-1:]
        if held:
            yield held, None

    return runs


def _texts(texts: DataFrame) -> DataFrame:
    return spread(texts.where(F.col("text").isNotNull()).select("title", F.col("text").cast("string").alias("text")))


def counted_words(texts: DataFrame) -> DataFrame:
    """The same as ``counted`` of ``words``: a task counts its words where it reads them."""
    parts, runs_of, most = make_word_parts(), make_runs(), 200_000

    # the functions are sent to the tasks by value, without this package
    def count(batches):
        from collections import Counter
        import pyarrow as pa
        plain, ended = Counter(), Counter()  # by type; by type and the type that follows

        def counts():
            plain.pop(None, None)
            types = [*plain, *(k[0] for k in ended)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(types, pa.string()), pa.array([False] * len(plain) + [True] * len(ended), pa.bool_()),
                 pa.array([None] * len(plain) + [k[1] for k in ended], pa.string()),
                 pa.array([*plain.values(), *ended.values()], pa.int64())],
                ["type", "period", "next_type", "k"])
            plain.clear()
            ended.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                for runs, after in runs_of(text.as_py()):
                    known = [parts[w] for w in runs]
                    plain.update([x[1] for x in known if not x[2]])
                    follow = known[1:] + [parts[after] if after is not None else None]
                    ended.update([(x[1], y and y[1]) for x, y in zip(known, follow, strict=True)
                                  if x[2] and x[1] is not None])
                if len(plain) + len(ended) >= most:
                    yield counts()
        yield counts()

    rows = _texts(texts).mapInArrow(count, "type string, period boolean, next_type string, k long")
    return materialise(rows.groupBy("type", "period", "next_type").agg(F.sum("k").alias("k")), "counted_words")


def _plain_tokens(texts: DataFrame) -> DataFrame:
    """(title, token) of the words that cannot be abbreviations: without a period or no words."""
    parts, runs_of = make_word_parts(), make_runs()

    def tokens(batches):
        import pyarrow as pa
        for batch in batches:
            titles, texts = batch.column("title"), batch.column("text")
            rows, found = [], []
            for i in range(batch.num_rows):
                for runs, _ in runs_of(texts[i].as_py()):
                    n = len(found)
                    found += [t for w in runs for x in (parts[w],) if not x[2] or x[1] is None for t in x[4]]
                    rows += [i] * (len(found) - n)
                    if len(found) >= 200_000:
                        yield pa.RecordBatch.from_arrays(
                            [titles.take(pa.array(rows, pa.int64())), pa.array(found, pa.string())],
                            ["title", "token"])
                        rows, found = [], []
            yield pa.RecordBatch.from_arrays(
                [titles.take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], ["title", "token"])

    texts = _texts(texts)
    return texts.mapInArrow(tokens, StructType([texts.schema["title"], StructField("token", StringType())]))


def _words_with_period(texts: DataFrame) -> DataFrame:
    """(title, core, type, next_type, next_capital, tokens) of the words that may be abbreviations."""
    parts, runs_of = make_word_parts(), make_runs()
    kinds = {"core": StringType(), "type": StringType(), "next_type": StringType(),
             "next_capital": BooleanType(), "tokens": ArrayType(StringType())}
    names = ["title", *kinds]

    def marked(batches):
        import pyarrow as pa
        for batch in batches:
            titles, texts = batch.column("title"), batch.column("text")
            rows, found = [], []

            def out():
                columns = [*zip(*found, strict=True)] or [()] * 5
                arrays = [pa.array(c, k) for c, k in zip(columns, [
                    pa.string(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string())], strict=True)]
                made = pa.RecordBatch.from_arrays([titles.take(pa.array(rows, pa.int64())), *arrays], names)
                rows.clear()
                found.clear()
                return made

            for i in range(batch.num_rows):
                for runs, after in runs_of(texts[i].as_py()):
                    n, last = len(found), len(runs) - 1
                    for j in [j for j, w in enumerate(runs) if "." in w]:
                        x = parts[runs[j]]
                        if x[2] and x[1] is not None:
                            y = runs[j + 1] if j < last else after
                            y = parts[y] if y is not None else (None, None, None, False)
                            found.append((x[0], x[1], y[1], y[3], x[4]))
                    rows += [i] * (len(found) - n)
                    if len(found) >= 50_000:
                        yield out()
            yield out()

    texts = _texts(texts)
    return texts.mapInArrow(marked, StructType(
        [texts.schema["title"], *[StructField(n, k) for n, k in kinds.items()]]))


def _times(found: DataFrame) -> Column:
    """How many words a row of ``words`` or ``counted`` stands for."""
    return F.col("k") if "k" in found.columns else F.lit(1).cast("long")


def _times_log(n: Column, p: Column) -> Column:
    return F.when(n == 0, F.lit(0.0)).otherwise(n * F.log(p))


def abbreviation_score(with_: Column, without: Column, type_: Column, periods: Column,
                       total: Column) -> Column:
    """Weighed log-likelihood ratio of a type that comes ``with_`` and ``without`` a period."""
    p = periods / total
    chance = _times_log(with_, p) + _times_log(without, 1 - p)
    model = with_ * F.log(F.lit(P_ABBREVIATION)) + without * F.log(F.lit(1 - P_ABBREVIATION))
    inner = F.length(type_) - F.length(F.replace(type_, F.lit("."), F.lit("")))
    letters = F.length(type_) - inner
    return (-2.0 * (chance - model) * F.exp(-letters.cast("double")) * (inner + 1)
            * F.pow(letters.cast("double"), -without.cast("double")))


def abbreviations(found: DataFrame) -> DataFrame:
    """(type, n_with, n_without, score) of the abbreviations in ``words`` (or ``counted``)."""
    none, k = F.lit(0).cast("long"), _times(found)
    counts = materialise(found.where("type IS NOT NULL").groupBy("type").agg(
        F.sum(F.when(F.col("period"), k).otherwise(none)).alias("n_with"),
        F.sum(F.when(F.col("period"), none).otherwise(k)).alias("n_without")), "types")
    periods = counts.agg(F.sum("n_with")).scalar()
    total = counts.agg(F.sum(F.col("n_with") + F.col("n_without"))).scalar()
    score = abbreviation_score(F.col("n_with"), F.col("n_without"), F.col("type"), periods, total)
    return (counts.where("n_with > 0").withColumn("score", score)
            .where(F.col("score") >= ABBREVIATION).select("type", "n_with", "n_without", "score"))


def collocation_ratio(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Log-likelihood ratio of two events seen a and b times in n, ab times together."""
    def likelihood(k, m, q):
        return _times_log(k, q) + _times_log(m - k, 1 - q)

    p, p1, p2 = b / n, ab / a, (b - ab) / (n - a)
    apart = likelihood(ab, a, p) + likelihood(b - ab, n - a, p)
    first = F.when(a == ab, F.lit(0.0)).otherwise(likelihood(ab, a, p1))
    second = F.when(b == ab, F.lit(0.0)).otherwise(likelihood(b - ab, n - a, p2))
    return -2.0 * (apart - first - second)


def sentence_starters(found: DataFrame, abbrs: DataFrame) -> DataFrame:
    """(type, n, n_first, ratio) of the words that start sentences more often than by chance."""
    ends = (found.where("period AND type IS NOT NULL AND next_type IS NOT NULL")
            .groupBy("type", F.col("next_type")).agg(F.sum(_times(found)).alias("k"))
            .join(abbrs.select("type"), "type", "left_anti"))
    first = ends.groupBy(F.col("next_type").alias("type")).agg(F.sum("k").alias("n_first"))
    counts = materialise(found.where("type IS NOT NULL").groupBy("type").agg(
        F.sum(_times(found)).alias("n")).join(first, "type", "left"), "first_words")
    total, ends_ = counts.agg(F.sum("n")).scalar(), counts.agg(F.sum("n_first")).scalar()
    ratio = collocation_ratio(ends_, F.col("n"), F.col("n_first"), total)
    return (counts.where("n_first > 0").withColumn("ratio", ratio)
            .where((F.col("ratio") >= STARTER)
                   & (total * F.col("n_first") > F.col("n") * ends_))
            .select("type", "n", "n_first", "ratio"))


def sentence_tokens(texts: DataFrame) -> DataFrame:
    """(title, token) where abbreviations inside a sentence keep their period.

    An abbreviation ends a sentence where the text ends or a capitalised
    sentence starter follows; every other word is split as in ``tokens``.  Only words with a
    period meet the models; the others become tokens where they are read.
    """
    counts = counted_words(texts)
    abbrs = materialise(abbreviations(counts), "abbreviations")
    starts = materialise(sentence_starters(counts, abbrs), "starters")
    marked = (_words_with_period(texts)
              .join(abbrs.select("type", F.lit(True).alias("_abbr")), "type", "left")
              .join(starts.select(F.col("type").alias("next_type"), F.lit(True).alias("_start")),
                    "next_type", "left"))
    whole = F.col("_abbr").isNotNull() & F.col("next_type").isNotNull() & ~(
        F.col("_start").isNotNull() & F.col("next_capital"))
    kept = marked.select("title", F.explode(F.when(whole, F.array("core")).otherwise(
        F.col("tokens"))).alias("token"))
    return _plain_tokens(texts).unionByName(kept)


# ---------------------------------------------------------------------------
# The same as DuckDB SQL (oracle side)
# ---------------------------------------------------------------------------

def _core_sql(w: str) -> str:
    return f"regexp_replace(lower({w}), {T.sql_literal(EDGES)}, '', 'g')"


def _type_sql(core: str) -> str:
    bare = f"regexp_replace({core}, '\\.+\\z', '')"
    return f"CASE WHEN regexp_matches({bare}, {T.sql_literal(TYPE)}) THEN {bare} END"


def _log_sql(n: str, p: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 0.0 ELSE ({n}) * ln({p}) END"


def sentence_ctes(texts: str = "texts") -> list[tuple[str, str]]:
    """words, types, abbrs, starts, stoks over the texts of a CTE."""
    inner = "(length(type) - length(replace(type, '.', '')))"
    letters = f"(length(type) - {inner})"
    p = "(tp / tn::DOUBLE)"
    score = (f"-2.0 * (({_log_sql('n_with', p)}) + ({_log_sql('n_without', f'1 - {p}')}) - "
             f"(n_with * ln({P_ABBREVIATION}) + n_without * ln({1 - P_ABBREVIATION}))) "
             f"* exp(-{letters}) * ({inner} + 1) * pow({letters}, -n_without::DOUBLE)")
    q, q1, q2 = "(n / tn::DOUBLE)", "(n_first / ts::DOUBLE)", "((n - n_first) / (tn - ts)::DOUBLE)"
    both = lambda k, m, x: f"({_log_sql(k, x)}) + ({_log_sql(f'({m}) - ({k})', f'1 - {x}')})"
    ratio = (f"-2.0 * ({both('n_first', 'ts', q)} + {both('(n - n_first)', 'tn - ts', q)} - "
             f"(CASE WHEN ts = n_first THEN 0.0 ELSE {both('n_first', 'ts', q1)} END) - "
             f"(CASE WHEN n = n_first THEN 0.0 ELSE {both('(n - n_first)', 'tn - ts', q2)} END))")
    return [
        ("s_raw", f"SELECT title, w[i] AS raw, w[i + 1] AS nxt FROM (SELECT title, list_filter("
                  f"regexp_split_to_array(text, {T.sql_literal(T.WS + '+')}), lambda x: x <> '') AS w "
                  f"FROM {texts} WHERE text IS NOT NULL), unnest(range(1, len(w) + 1)) r(i)"),
        ("s_core", f"SELECT title, raw, nxt, {_core_sql('raw')} AS core, {_core_sql('nxt')} AS ncore "
                   "FROM s_raw"),
        ("s_words", f"SELECT title, raw, core, {_type_sql('core')} AS type, "
                    f"regexp_matches(core, {T.sql_literal(ENDS_SENTENCE)}) AS period, "
                    f"{_type_sql('ncore')} AS next_type, "
                    f"coalesce(regexp_matches(nxt, {T.sql_literal(CAPITAL)}), false) AS next_capital "
                    "FROM s_core"),
        ("s_types", "SELECT type, count(*) FILTER (WHERE period) AS n_with, count(*) FILTER "
                    "(WHERE NOT period) AS n_without FROM s_words WHERE type IS NOT NULL GROUP BY type"),
        ("s_total", "SELECT sum(n_with)::BIGINT AS tp, sum(n_with + n_without)::BIGINT AS tn FROM s_types"),
        ("abbrs", f"SELECT * FROM (SELECT type, n_with, n_without, {score} AS score FROM s_types, "
                  f"s_total WHERE n_with > 0) WHERE score >= {ABBREVIATION}"),
        ("s_first", "SELECT next_type AS type, count(*) AS n_first FROM s_words WHERE period AND type "
                    "IS NOT NULL AND next_type IS NOT NULL AND type NOT IN (SELECT type FROM abbrs) "
                    "GROUP BY next_type"),
        ("s_both", "SELECT type, n_with + n_without AS n, n_first, (SELECT sum(n_first)::BIGINT FROM "
                   "s_first) AS ts, tn FROM s_types JOIN s_first USING (type), s_total"),
        ("starts", f"SELECT * FROM (SELECT type, n, n_first, {ratio} AS ratio, tn, ts FROM s_both) "
                   f"WHERE ratio >= {STARTER} AND tn * n_first > n * ts"),
        ("s_kept", "SELECT title, CASE WHEN period AND type IN (SELECT type FROM abbrs) AND next_type "
                   "IS NOT NULL AND NOT (next_capital AND next_type IN (SELECT type FROM starts)) "
                   f"THEN [core] ELSE {T.token_array_sql('raw')} END AS t FROM s_words"),
        ("s_toks", f"SELECT title, unnest({T.split_contractions_sql('token')}) AS token FROM "
                   "(SELECT title, unnest(t) AS token FROM s_kept) WHERE token <> ''"),
    ]
