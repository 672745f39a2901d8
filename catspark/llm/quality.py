"""Quality rules (operator 5): base rules, then robust multivariate outliers.

Statistics of a text are transformed into a vector; per language and source a
minimum-covariance-determinant estimate gives a centre and a scatter that
outliers cannot pull, and texts too far from it by Mahalanobis distance are
rejected.  Only DataFrame expressions are used.

Concentration steps run from three starts: medians and quartiles, mean and
covariance of all rows, and those of the half nearest to the medians.  In each
step the ``support`` share of a group's rows with the smallest distances gives the
next mean and covariance, as long as the determinant falls; of the three ends
the one with the least determinant is the estimate.  Vectors
are whole numbers (steps of 1/SCALE), so all sums are exact and do not depend
on the order of rows; the share is found from counts per distance bin, so no
group is ever sorted or gathered in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import let, words

#: steps per unit of a transformed statistic; bins per unit of log distance
SCALE, DISTANCE_BINS = 200, 200
#: transformed statistics and the least standard deviation taken for each: many
#: groups have no symbols, repeats or repeated lines at all
FLOORS = {"log_words": 0.75, "log_word_length": 0.15, "symbol_share": 0.3,
          "log_dup_lines": 0.7, "repeat_share": 0.1}
RUN = 5
#: name of the group of all texts
ALL = "all"


def group_name(kind: str, *columns: str) -> Column:
    """Text that names a group: its kind and its values, nulls included."""
    values = F.to_json(F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(columns)]),
                       {"ignoreNullFields": "false"})
    return F.concat(F.lit(f"{kind} "), values)


def base_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Null text has no words, characters or lines.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = F.lit(" \t\n\x0b\x0c\r")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, blank) != "")
    held = df.withColumn("_w", words(F.col(text_col))).withColumn("_l", lines)
    out = held.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_w")).cast("long")}).drop("_w", "_l")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def repeat_words(w: Column) -> Column:
    """Words within runs of five words that occur twice or more in ``w``."""
    def covered(runs: Column) -> Column:
        placed = F.array_sort(F.transform(runs, lambda r, i: F.struct(r.alias("r"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            return F.array_sort(F.transform(F.filter(s, lambda e, i: (
                e["r"].eqNullSafe(F.get(s, i - 1)["r"]) | e["r"].eqNullSafe(F.get(s, i + 1)["r"]))),
                lambda e: e["i"]))

        zero = F.struct(F.lit(0).alias("n"), F.lit(-RUN).alias("last"))
        total = F.aggregate(let(placed, repeated), zero, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(RUN), p - a["last"])).alias("n"), p.alias("last")))
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), 0).otherwise(total["n"])

    def runs(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - RUN),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(RUN)]))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(F.size(w) <= RUN, 0).otherwise(
        let(hashes, lambda h: let(runs(h), covered)))


def vector() -> dict[str, Column]:
    """Transformed statistics, rounded to whole steps of 1/SCALE."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    raw = {"log_words": F.log1p("n_words"),
           "log_word_length": F.log(chars / n),
           "symbol_share": F.log1p(100 * F.col("n_symbols") / chars),
           "log_dup_lines": F.log1p("n_dup_lines"),
           "repeat_share": F.col("n_repeat_words") / n}
    return {k: F.round(v * SCALE).cast("long") for k, v in raw.items()}


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            groups: tuple[str, ...] = ("lang", "source"), support: float = 0.75,
            tail: float = 1e-6, min_group: int = 50) -> DataFrame:
    """One row per row of ``df``: _id, _h (see ``row_key``), the statistics, base_failed,
    distance2 (squared robust distance, null without an estimate) and kept.

    ``support`` is the share of a group that the estimate rests on; a text is
    rejected when its distance would be met by a share of ``tail`` of normal
    vectors.  A group with fewer than ``min_group`` texts past the base rules
    takes the estimate of its first group column (language), which rests on all
    texts of the language past the base rules; if those are too few as well, it
    takes the estimate of all texts past the base rules.  A table with fewer
    than ``min_group`` such texts has no estimate: the base rules decide alone.
    Null group values are a group of their own.  Null, empty and one-word texts
    fail the base rules.  Very long texts are counted whole.  Repeated rows get
    equal results.  Empty table: no rows.  Other columns are ignored.
    """
    names = list(FLOORS)
    held = df.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text_col).alias("_h"),
                     F.col(text_col).alias("_text"),
                     group_name("source", *groups).alias("fine"),
                     group_name("language", groups[0]).alias("coarse"))
    rows = materialise(base_statistics(held, "_text").drop("_text").withColumns(vector()), "stats")
    passing = rows.where(~F.col("base_failed"))
    counts = passing.groupBy("fine", "coarse").agg(F.count(F.lit(1)).alias("n"))
    coarse = counts.groupBy("coarse").agg(F.sum("n").alias("n_coarse"))
    key = (F.when(F.col("n") >= min_group, F.col("fine"))
           .when(F.col("n_coarse") >= min_group, F.col("coarse")).otherwise(F.lit(ALL)))
    sized = materialise(counts.join(coarse, "coarse").select("fine", "coarse", key.alias("key")),
                        "groups")  # a row per source and language
    keys = sized.select("fine", "key")
    # an estimate of a language, or of all, rests on its large groups too
    needed = sized.select(F.col("key").alias("k")).distinct()
    fits = materialise(reduce(DataFrame.union, [
        sized.join(needed, F.col("k") == of, "left_semi").select("fine", of.alias("key"))
        for of in (F.col("fine"), F.col("coarse"), F.lit(ALL))]), "fits")
    keyed = materialise(passing.join(fits, "fine").select("key", *names), "vectors")
    estimates = mcd(keyed, names, support, min_group)
    cut = chi2_quantile(1 - tail, len(names)) * consistency(support, len(names))
    scored = (rows.join(keys, "fine", "left").join(estimates, "key", "left")
              .withColumn("distance2", F.when(~F.col("base_failed"), mahalanobis2(names))))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cut, F.lit(True))
    return scored.select("_id", "_h", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "distance2", kept.alias("kept"))


def mcd(rows: DataFrame, names: list[str], support: float, min_group: int) -> DataFrame:
    """Per key: mean (m_i) and Cholesky factor (l_i_j) of the scatter, by concentration steps."""
    quartiles = materialise(_start(rows, names, min_group), "mcd_start")
    sizes = quartiles.select("key", "size")
    whole = _factor(_moments(rows.join(sizes, "key").groupBy("key", "size"), names), names)
    half = _concentrate(rows, quartiles, names, 0.5)
    state = ["key", "size", *[c for c in quartiles.columns if c[:2] in ("m_", "l_")]]
    starts = [df.select(F.lit(i).alias("start"), *state)
              for i, df in enumerate((quartiles, whole, half))]
    best = materialise(reduce(DataFrame.unionByName, starts).withColumns({
        "active": F.lit(True), "steps": F.lit(0), "log_det": F.lit(0.0)}), "mcd")
    while best.where("active").limit(1).count():
        step = _concentrate(rows, best.where("active"), names, support)
        old = best.select("key", "start", F.col("log_det").alias("old"), F.col("steps").alias("done"))
        step = (step.join(old, ["key", "start"]).withColumn("steps", F.col("done") + 1)
                .withColumn("active", (F.col("done") == 0)
                            | (F.col("log_det") < F.col("old") - 1e-3)))
        # a start whose determinant no longer falls keeps what it had
        falling = step.where("active").select(best.columns)
        rest = (best.join(falling.select("key", "start"), ["key", "start"], "left_anti")
                .withColumn("active", F.lit(False)))
        best = materialise(rest.unionByName(falling), "mcd")
    least = F.min(F.struct(F.round("log_det", 9).alias("d"), "start")).alias("least")
    chosen = best.groupBy("key").agg(least).select("key", F.col("least.start").alias("start"))
    return materialise(best.join(chosen, ["key", "start"]), "mcd").drop("start")


def _concentrate(rows: DataFrame, estimate: DataFrame, names: list[str], share: float) -> DataFrame:
    """Mean and factor of the ``share`` of each key's rows that are nearest by ``estimate``."""
    by = [c for c in ("key", "start", "size") if c in estimate.columns]
    placed = (rows.join(estimate, "key")
              .withColumn("bin", F.floor(F.log1p(mahalanobis2(names)) * DISTANCE_BINS)))
    bins = placed.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    # bounded: the distance bins of a key
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))
    limits = materialise(bins.withColumn("upto", upto)
                         .where(F.col("upto") >= F.ceil(F.col("size") * share))
                         .groupBy(*by).agg(F.min("bin").alias("limit")), "limits")
    inner = placed.join(limits, by).where(F.col("bin") <= F.col("limit"))
    return _factor(_moments(inner.groupBy(*by), names, by), names)


def _start(rows: DataFrame, names: list[str], min_group: int) -> DataFrame:
    """Medians and quartile spreads per key, from exact counts per whole-number value."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.where(F.col("size") >= min_group)
    long = rows.select("key", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(n).alias("v")) for i, n in enumerate(names)]))
        .alias("e")).select("key", "e.*")
    counts = long.groupBy("key", "i", "v").agg(F.count(F.lit(1)).alias("n")).join(sizes, "key")
    upto = F.sum("n").over(Window.partitionBy("key", "i").orderBy("v"))  # bounded: values
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("size") * q, F.col("v")))
    marks = (counts.withColumn("upto", upto).groupBy("key", "size", "i")
             .agg(at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("b")))
    wide = marks.groupBy("key", "size").agg(*[
        F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}_{i}")
        for i in range(len(names)) for c in "amb"])
    cols = {f"m_{i}": F.col(f"m_{i}").cast("double") for i in range(len(names))}
    for i, n in enumerate(names):
        floor = FLOORS[n] * SCALE
        for j in range(i + 1):
            cols[f"l_{i}_{j}"] = (F.greatest((F.col(f"b_{i}") - F.col(f"a_{i}")) / 1.349,
                                             F.lit(floor)) if i == j else F.lit(0.0))
    return wide.select("key", "size", *[c.alias(k) for k, c in cols.items()])


def _moments(grouped, names: list[str], by: tuple[str, ...] = ("key", "size")) -> DataFrame:
    """Means m_i and covariances c_i_j (with the squared floors on the diagonal)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(names):
        aggs.append(F.sum(a).alias(f"s_{i}"))
        aggs += [F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for j, b in enumerate(names[:i + 1])]
    sums = grouped.agg(*aggs)
    cols = {f"m_{i}": F.col(f"s_{i}") / F.col("n") for i in range(len(names))}
    for i, a in enumerate(names):
        for j in range(i + 1):
            cov = (F.col(f"p_{i}_{j}") / F.col("n")
                   - (F.col(f"s_{i}") / F.col("n")) * (F.col(f"s_{j}") / F.col("n")))
            cols[f"c_{i}_{j}"] = cov + (FLOORS[a] * SCALE) ** 2 if i == j else cov
    return sums.select(*by, *[c.alias(k) for k, c in cols.items()])


def _factor(df: DataFrame, names: list[str]) -> DataFrame:
    """Cholesky factor l_i_j and log determinant of the covariances c_i_j."""
    det = F.lit(0.0)
    for i in range(len(names)):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            df = df.withColumn(f"l_{i}_{j}",
                               F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
        det = det + 2 * F.log(F.col(f"l_{i}_{i}"))
    return df.withColumn("log_det", det)


def mahalanobis2(names: list[str]) -> Column:
    """Squared distance of a row's vector from m_i under the factor l_i_j."""
    z: list[Column] = []
    for i, n in enumerate(names):
        rest = F.col(n) - F.col(f"m_{i}")
        for j, zj in enumerate(z):
            rest = rest - F.col(f"l_{i}_{j}") * zj
        z.append(rest / F.col(f"l_{i}_{i}"))
    total = z[0] * z[0]
    for zi in z[1:]:
        total = total + zi * zi
    return total


def chi2_cdf(x: float, p: int) -> float:
    """Share of a chi-squared variable with ``p`` degrees of freedom below ``x``."""
    a, y = p / 2, x / 2
    term = total = 1 / a
    k = a
    while term > 1e-17 * total:
        k += 1
        term *= y / k
        total += term
    return total * math.exp(a * math.log(y) - y - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(q: float, p: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, p) < q else (lo, mid)
    return lo


def consistency(support: float, p: int) -> float:
    """What the scatter of the inner ``support`` share is to be multiplied by for normal data."""
    return support / chi2_cdf(chi2_quantile(support, p), p + 2)
