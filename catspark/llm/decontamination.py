"""Benchmark decontamination (operator 2): winnowed fingerprints, then exact windows.

Of the hashes of ``GRAM``-word runs within each window of words, the minimum is
the window's fingerprint.  Equal windows have equal fingerprints, so every
shared window is found; neighbouring windows mostly share theirs, so only runs
of windows are joined with the benchmark's fingerprints.  Runs that hit are
extended to their windows, which are compared word for word.  Only DataFrame
expressions are used.

Nothing is broadcast by request: Spark does so with fingerprints and windows
whose size is below its threshold, and joins by shuffle (splitting skewed
partitions) beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import NON_WORD, let, lower_ascii, words

GRAM = 4


def text_words(col: str) -> Column:
    return words(lower_ascii(F.col(col)), NON_WORD)


def fingerprint_runs(w: Column, length: int) -> Column:
    """[(at, n, fp)]: windows at .. at + n - 1 of ``length`` words share the fingerprint fp."""
    gram = min(GRAM, length)
    span = length - gram + 1

    def grams(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - gram),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(gram)]))

    def minima(g: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(g) - span + 1),
                           lambda i: F.array_min(F.slice(g, i, span)))

    def runs(m: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1),
                          lambda i: ~F.get(m, i).eqNullSafe(F.get(m, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda i, j: F.struct(
            i.alias("at"), (F.coalesce(F.get(s, j + 1), F.size(m)) - i).alias("n"),
            F.get(m, i).alias("fp"))))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    found = let(hashes, lambda h: let(grams(h), lambda g: let(minima(g), runs)))
    return F.when(F.size(w) >= length, found).otherwise(
        F.array().cast("array<struct<at:int,n:int,fp:bigint>>"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  window: int = 13, min_share: tuple[int, int] = (1, 20)) -> DataFrame:
    """One row per row of ``docs``: _id, _h (see ``row_key``), n_words, n_hit, items
    (ids of items with occurring windows, as sorted strings), spans, contaminated.

    A window is ``window`` consecutive words of an item; an item of fewer words
    is one window.  ``spans`` are the (at, n) of the document's matched windows.
    Contaminated: hit words are at least ``min_share`` of the document's.

    Null or empty texts have no words and are hit by nothing; items without
    words have no windows.  Items with a null id hit words but are not listed.
    Repeated rows of either table get equal results, and change none.  Empty
    tables: no rows, or no hits.  Other columns are ignored.
    """
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text)
                         .alias("_t")).distinct().withColumn("w", text_words("_t"))
    bench = materialise(bench.where(F.size("w") > 0).select(
        "item", "w", F.least(F.size("w"), F.lit(window)).alias("length")), "items")
    lengths = sorted(r[0] for r in bench.select("length").distinct().collect())  # at most `window`
    key = lambda at: F.concat_ws(" ", F.slice("w", at + 1, F.col("length")))
    windows = materialise(bench.select("item", "length", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - F.col("length")), key)).alias("key")).distinct(),
        "windows")

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text_col).alias("_h"),
                       F.col(text_col).alias("_t"))
    hits = None
    for length in lengths:
        known = materialise(bench.where(F.col("length") == length).select(
            F.explode(fingerprint_runs(F.col("w"), length))).select("col.fp").distinct(), "prints")
        runs = (rows.select("_id", "_h", text_words("_t").alias("w"))
                .select("_id", "_h", F.explode(fingerprint_runs(F.col("w"), length)).alias("run"))
                .select("_id", "_h", "run.*").join(known, "fp")
                .select("_id", "_h", F.lit(length).alias("length"), "at", "n"))
        hits = runs if hits is None else hits.union(runs)
    if hits is None:  # no items
        hits = rows.select("_id", "_h", F.lit(0).alias("length"), F.lit(0).alias("at"),
                           F.lit(0).alias("n")).limit(0)
    hits = materialise(hits.distinct().groupBy("_id", "_h").agg(
        F.collect_list(F.struct("length", "at", "n")).alias("runs")), "runs")

    # extend: the windows of each run that hits, word for word
    held = (rows.join(hits.withColumnsRenamed({"_id": "_i2", "_h": "_h2"}),
                      F.col("_id").eqNullSafe(F.col("_i2")) & (F.col("_h") == F.col("_h2")), "left")
            .select("_id", "_h", "runs", text_words("_t").alias("w")))
    tried = lambda w: F.flatten(F.transform("runs", lambda r: F.transform(
        F.sequence(r["at"], r["at"] + r["n"] - 1), lambda at: F.struct(
            r["length"].alias("length"), at.alias("at"),
            F.concat_ws(" ", F.slice(w, at + 1, r["length"])).alias("key")))))
    held = materialise(held.select("_id", "_h", F.size("w").cast("long").alias("n_words"),
                                   F.when(F.col("runs").isNotNull(), let(F.col("w"), tried))
                                   .alias("tried")), "tried")
    unique = held.where("tried is not null").select("_id", "_h", "tried").dropDuplicates(
        ["_id", "_h"])
    found = (unique.select("_id", "_h", F.explode("tried").alias("t")).select("_id", "_h", "t.*")
             .join(windows, ["length", "key"])
             .groupBy("_id", "_h").agg(
                 F.array_sort(F.collect_set(F.struct("at", F.col("length").alias("n"))))
                 .alias("spans"),
                 F.array_sort(F.collect_set("item")).alias("items")))
    out = held.drop("tried").join(
        materialise(found, "found").withColumnsRenamed({"_id": "_i2", "_h": "_h2"}),
        F.col("_id").eqNullSafe(F.col("_i2")) & (F.col("_h") == F.col("_h2")), "left")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(a["end"], s["at"]))).alias("n"),
        F.greatest(a["end"], s["at"] + s["n"]).alias("end")))["n"]
    out = out.withColumn("n_hit", F.coalesce(covered, F.lit(0)).cast("long"))
    num, den = min_share
    return out.select("_id", "_h", "n_words", "n_hit",
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
                      ((F.col("n_hit") > 0) & (den * F.col("n_hit") >= num * F.col("n_words")))
                      .alias("contaminated"))
