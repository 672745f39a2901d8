"""A document store whose documents may be sent again (T7 with I2/I3).

Every batch of texts is written as signed differences: the counts of its new
texts are added, the counts of the texts they replace are taken away.  Counts,
document frequencies and the number of documents are sums over all batches, so
a later text retracts an earlier one wherever it was counted.  A batch has
folders of its own and looks at earlier batches only: running it again after a
crash writes the same rows to the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from .index import dedupe_documents, term_counts

COUNTS = "title string, word string, n long, docs long"
TITLES = "title string, docs long"


@dataclass(frozen=True)
class DocumentStore:
    """Signed counts under ``path``: counts/batch=i (title, word, n, docs), titles/batch=i."""

    spark: SparkSession
    path: str
    stem: bool = True

    def _rows(self, kind: str, schema: str, before: int | None) -> DataFrame:
        try:
            rows = self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/{kind}")
        except AnalysisException:  # no batch yet
            return self.spark.createDataFrame([], schema)
        rows = rows if before is None else rows.where(F.col("batch") < before)
        return rows.drop("batch")

    def counts(self, before: int | None = None) -> DataFrame:
        """(title, word, n) of the documents as they are now (or were before a batch)."""
        return (self._rows("counts", COUNTS, before).groupBy("title", "word")
                .agg(F.sum("n").alias("n")).where(F.col("n") > 0))

    def titles(self, before: int | None = None) -> DataFrame:
        """(title) of every stored document, also those without counted words."""
        return (self._rows("titles", TITLES, before).groupBy("title")
                .agg(F.sum("docs").alias("docs")).where("docs > 0").select("title"))

    def n_docs(self):
        """Number of documents, from the signed rows alone."""
        return self._rows("titles", TITLES, None).agg(F.sum("docs")).scalar()

    def vocab(self) -> DataFrame:
        """(word, df, idf) from the signed document frequencies: no look at the counts of titles."""
        df = (self._rows("counts", COUNTS, None).groupBy("word").agg(F.sum("docs").alias("df"))
              .where(F.col("df") > 0))
        return df.withColumn("idf", F.log(self.n_docs() / F.col("df")))

    def put(self, texts: DataFrame, batch: int, order: str | None = None) -> None:
        """Store ``texts(title, text)`` as batch number ``batch``.

        The last text of a title wins: by ``order`` within the batch (without it
        titles must not repeat in a batch), and any text of this batch over those
        of earlier ones.  A null text is a document without words; rows with a
        null title are left out.
        """
        texts = texts.where(F.col("title").isNotNull())
        if order is not None:
            texts = dedupe_documents(texts.select("title", order, "text"), "title", order)
        texts = materialise(texts.select("title", "text"), "store_batch")
        sent = texts.select("title")
        new = term_counts(texts, stem=self.stem).select(
            "title", "word", "n", F.lit(1).cast("long").alias("docs"))
        old = self.counts(batch).join(sent, "title", "left_semi").select(
            "title", "word", (-F.col("n")).alias("n"), F.lit(-1).cast("long").alias("docs"))
        change = (new.unionByName(old).groupBy("title", "word")
                  .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
                  .where("n <> 0 OR docs <> 0"))
        added = sent.join(self.titles(batch), "title", "left_anti").select(
            "title", F.lit(1).cast("long").alias("docs"))
        # the title rows come last: a batch without them was not finished
        for kind, rows in (("counts", change), ("titles", added)):
            rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch}")

    def compact(self, path: str) -> DocumentStore:
        """The present documents as batch 0 of a new store at ``path``."""
        one = F.lit(1).cast("long").alias("docs")
        self.counts().select("title", "word", "n", one).write.mode("overwrite").parquet(
            f"{path}/counts/batch=0")
        self.titles().select("title", one).write.mode("overwrite").parquet(f"{path}/titles/batch=0")
        return DocumentStore(self.spark, path, self.stem)
