"""Text -> counts -> TF-IDF index -> page vectors.

Long, relational forms throughout: ``term_counts(title, word, n)``,
``postings(word, title, tf)``, ``vocab(word, df, idf)`` and
``page_vectors(title, word, weight)``; the word itself is the coordinate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import text as T
from ..functions.porter import make_stemmer, stem_words
from ..session import materialise


# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------

def tokens(texts: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(title, token) for every raw lower-cased token."""
    return (texts.where(F.col(text).isNotNull())
            .select(F.col(title).alias("title"),
                    F.explode(T.split_token_array(F.col(text))).alias("token"))
            .where(F.col("token") != ""))


def alpha_tokens(toks: DataFrame) -> DataFrame:
    """Keep tokens made only of the letters a-z."""
    return toks.where(T.is_word(F.col("token")))


def content_tokens(toks: DataFrame) -> DataFrame:
    """Letters-only tokens that are not stopwords (tested before stemming)."""
    return toks.where(T.is_content_word(F.col("token")))


def stems(words: DataFrame, word: str = "token") -> DataFrame:
    """T4: (token, word) = Porter stem of each distinct token."""
    distinct = words.select(F.col(word).alias("token")).distinct()
    stemmed = stem_words(distinct, "token", "word")
    # Aggregate barrier: predicates on the stem (e.g. a join's inferred
    # isnotnull) stay above it instead of being substituted through the
    # step projections.  Input is already partitioned by token: no shuffle.
    return stemmed.groupBy("token").agg(F.max("word").alias("word"))


# ---------------------------------------------------------------------------
# counts
# ---------------------------------------------------------------------------

def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """``df`` over the cluster, round-robin or by ``key``, when it is read by fewer tasks than
    there are cores (small input; a file may be one row group), so per-row text
    work is not stuck in a few tasks.  Only the plan is looked at; larger
    tables, and streams, are untouched."""
    if df.isStreaming:
        return df
    parts = df.rdd.getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *[c for c in [key] if c]) if 0 < parts < cores else df


#: distinct words of rows in sequence after which a new run begins
RUN_WORDS = 200_000


def run_counts(texts: DataFrame, stem: bool = True, title: str = "title", text: str = "text",
               lines: bool = False) -> DataFrame:
    """(title, word, n, total, run) kept tokens (T1-T4) of each run: rows of one title that a task
    reads in sequence, numbered within the task.  Null texts have none.  ``lines``: a document is many rows.
    """
    texts = spread(texts.select(F.col(title).alias("title"), F.col(text).cast("string").alias("text"))
                   .where("text is not null"), "title" if lines else None)
    count_words, stem_of, most = T.make_word_counts(), make_stemmer() if stem else None, RUN_WORDS

    # the function is sent to the tasks by value, without this package
    def count(batches):
        import pyarrow as pa
        now, found, run, chars, kind = None, {}, 0, 0, None
        titles, rows, words, ns, totals, runs = [], [], [], [], [], []

        def close():
            nonlocal run
            if stem_of is None:
                counts = found
            else:
                counts = {}
                for token, n in found.items():
                    word = stem_of(token)
                    counts[word] = counts.get(word, 0) + n
            if counts:
                rows.extend([len(titles)] * len(counts))
                titles.append(now)
                words.extend(counts)
                ns.extend(counts.values())
                totals.extend([sum(counts.values())] * len(counts))
                runs.extend([run] * len(counts))
                run += 1

        def closed():
            out = pa.RecordBatch.from_arrays(
                [pa.array(titles, kind).take(pa.array(rows, pa.int64())), pa.array(words, pa.string()),
                 pa.array(ns, pa.int64()), pa.array(totals, pa.int64()), pa.array(runs, pa.int64())],
                ["title", "word", "n", "total", "run"])
            for x in (titles, rows, words, ns, totals, runs):
                x.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("title").type
            for name, value in zip(batch.column("title"), batch.column("text"), strict=True):
                name, value = name.as_py(), value.as_py()
                if name != now or len(found) >= most:
                    close()
                    now, found = name, {}
                more = count_words(value)
                if found:
                    for token, n in more.items():
                        found[token] = found.get(token, 0) + n
                else:
                    found = more
                chars += len(value)
                if chars >= 1_000_000:
                    yield closed()
                    chars = 0
        if kind is not None:
            close()
            yield closed()

    return texts.mapInArrow(count, StructType([
        texts.schema["title"], StructField("word", StringType()), StructField("n", LongType()),
        StructField("total", LongType()), StructField("run", LongType())]))


def row_counts(texts: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(title, token, n) kept tokens (T1-T3) of each run of rows before stemming."""
    return run_counts(texts, False, title, text).select("title", F.col("word").alias("token"), "n")


def add_up(rows: DataFrame, key: str, runs: list[str]) -> DataFrame:
    """``rows(key, word, n)``, and ``total`` if they have it, with one row per key and word.

    Words are unique per key and ``runs``, so only the rows of keys that come in several runs
    are moved and added up.
    """
    several = materialise(rows.select(key, *runs).distinct().groupBy(key)
                          .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                          .select(F.col(key).alias("_key")), "several_runs")
    rows = rows.drop(*runs)
    if several.limit(1).count() == 0:
        return rows
    same = F.col(key).eqNullSafe(F.col("_key"))
    joint = (rows.join(several, same, "left_semi").repartition(key)
             .groupBy(key, "word").agg(F.sum("n").alias("n")))
    if "total" in rows.columns:
        joint = joint.withColumn("total", F.sum("n").over(Window.partitionBy(key)))
    return materialise(rows.join(several, same, "left_anti").unionByName(joint), "added_up")


def raw_counts(texts: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(title, token, n) kept tokens per document before stemming, the rows of
    a title added up with a map-side partial aggregate on the skew-free (title, token) key."""
    return row_counts(texts, title, text).groupBy("title", "token").agg(F.sum("n").alias("n"))


def stem_counts(raw: DataFrame) -> DataFrame:
    """(title, word, n) of counts that are not stemmed: stem the distinct vocabulary once, join it back.

    The stem map has one row per distinct token; AQE broadcasts it only when
    its runtime size is under the broadcast threshold and otherwise keeps a
    sort-merge join whose hot-token partitions it splits.
    """
    return (raw.join(stems(raw), "token").select("title", "word", "n")
            .groupBy("title", "word").agg(F.sum("n").alias("n")))


def counts_with_totals(texts: DataFrame, stem: bool = True, title: str = "title",
                       text: str = "text", lines: bool = False) -> DataFrame:
    """(title, word, n, total), written: ``term_counts`` and the kept tokens of the document."""
    runs = run_counts(texts, stem, title, text, lines).withColumn("task", F.spark_partition_id())
    return add_up(materialise(runs, "term_counts"), "title", ["task", "run"])


def term_counts(texts: DataFrame, stem: bool = True, title: str = "title",
                text: str = "text", lines: bool = False) -> DataFrame:
    """T5: (title, word, n) kept-token (stemmed) frequencies per document, written.

    A word is stemmed in the task that counts it; only the rows of titles that come in several
    runs of rows (``lines``: a document is many) are moved."""
    return counts_with_totals(texts, stem, title, text, lines).select("title", "word", "n")


def freq_dist(counts: DataFrame) -> DataFrame:
    """One row per document with its frequencies as a map."""
    return (counts.groupBy("title")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "n"))))
                 .alias("freq")))


def dedupe_documents(texts: DataFrame, key: str = "title", order: str = "doc_id") -> DataFrame:
    """Last text for a title wins (highest ``order`` value; of rows that agree
    in it, the highest by the other columns in their order).

    The maximum is combined map-side, so a title repeated in a third of all
    rows never gathers those rows in one task.
    """
    others = [c for c in texts.columns if c != key]
    ranked = [order, *[c for c in others if c != order]]
    return (texts.groupBy(key)
            .agg(F.max(F.struct(*ranked)).alias("_last"))
            .select(key, *[F.col("_last").getField(c).alias(c) for c in others]))


def file_word_count(lines: DataFrame, stem: bool = True) -> DataFrame:
    """((word, file), count) over a line-wise text scan (file, line)."""
    counts = term_counts(lines.select(F.col("file").alias("title"),
                                      F.col("line").alias("text")), stem=stem, lines=True)
    return counts.select(F.col("word"), F.col("title").alias("file"), "n")


def file_word_lists(word_counts: DataFrame) -> DataFrame:
    """(file, [(word, n)]) regrouped per file, words sorted."""
    return (word_counts.groupBy("file")
            .agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("words")))


# ---------------------------------------------------------------------------
# Inverted index
# ---------------------------------------------------------------------------

def postings(counts: DataFrame) -> DataFrame:
    """(word, title, tf) with tf = n / kept tokens of the document (``total``
    where the counts have it, else their sum)."""
    total = F.col("total") if "total" in counts.columns else F.sum("n").over(
        Window.partitionBy("title"))
    return counts.select("word", "title", (F.col("n") / total).alias("tf"))


def document_count(texts: DataFrame, title: str = "title"):
    """N: every stored document counts, also those without kept tokens."""
    return texts.agg(F.count_distinct(title)).scalar()


def vocab(posts: DataFrame, n_docs) -> DataFrame:
    """I2 + I3: (word, df, idf) with the unsmoothed idf = ln(N / df)."""
    return (posts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
            .withColumn("idf", F.log(n_docs / F.col("df"))))


def inverted_index(posts: DataFrame, voc: DataFrame) -> DataFrame:
    """I4 (long form): (word, idf, title, tf)."""
    return posts.join(voc.select("word", "idf"), "word")


def inverted_index_nested(posts: DataFrame, voc: DataFrame,
                          max_entries: int = 10000) -> DataFrame:
    """I4 (nested view): word -> (idf, map title -> tf), in chunks.

    A frequent word's postings are split into ceil(df / max_entries) chunks
    by the md5 of the title, one row each, so no row (and no task) collects all
    documents of a word.  Rows: (word, chunk, idf, docs); docs in title order.
    """
    chunks = F.greatest(F.lit(1), F.ceil(F.col("df") / F.lit(max_entries))).cast("int")
    keyed = (posts.join(voc.select("word", "idf", chunks.alias("_c")), "word")
             .withColumn("chunk", F.pmod(
                 F.conv(F.substring(F.md5("title"), 1, 8), 16, 10).cast("long"),
                 F.col("_c")).cast("int")))
    return (keyed.groupBy("word", "chunk")
            .agg(F.first("idf").alias("idf"),
                 F.map_from_entries(F.array_sort(F.collect_list(F.struct("title", "tf"))))
                 .alias("docs")))


class Index:
    """Counts, postings and vocabulary of a text table.

    ``term_counts`` is written once as a table under the shared checkpoint
    folder (the persisted document artefact): postings and vocabulary both
    read it, so the text is tokenised and stemmed once, and a lost executor
    does not send the job back to the raw text.
    """

    def __init__(self, texts: DataFrame, stem: bool = True, persist: bool = True):
        self.texts = texts
        if persist:
            counts = counts_with_totals(texts, stem)
        else:
            counts = term_counts(texts, stem=stem)
        self.counts = counts.select("title", "word", "n")
        self.postings = postings(counts)
        self.n_docs = document_count(texts)
        self.vocab = vocab(self.postings, self.n_docs)

    def page_vectors(self) -> DataFrame:
        return page_vectors(self.postings, self.vocab)


# ---------------------------------------------------------------------------
# V1-V4: vectors
# ---------------------------------------------------------------------------

def page_vectors(posts: DataFrame, voc: DataFrame) -> DataFrame:
    """V1: (title, word, weight = tf * idf); zero weights kept."""
    return (posts.join(voc.select("word", "idf"), "word")
            .select("title", "word", (F.col("tf") * F.col("idf")).alias("weight")))


def term_ids(voc: DataFrame) -> DataFrame:
    """V2: dense integer id per word (word order), for exports only."""
    from ..plans.ranking import global_rank
    return global_rank(voc.select("word"), ["word"], "term_id")


def vector_of_page(vectors: DataFrame, titles: DataFrame, title: str = "title") -> DataFrame:
    """V3: vectors of known pages, looked up by normalised title."""
    wanted = titles.select(T.norm_name(F.col(title)).alias("title")).distinct()
    return vectors.join(wanted, "title", "left_semi")


def vector_of_text(texts: DataFrame, voc: DataFrame, stem: bool = True) -> DataFrame:
    """V4: vectors of new texts: raw count x corpus idf, unknown words dropped.
    The texts are tokenised once (``term_counts`` writes their counts)."""
    counts = term_counts(texts, stem=stem)
    return (counts.join(voc.select("word", "idf"), "word")
            .select("title", "word", (F.col("n") * F.col("idf")).alias("weight")))
