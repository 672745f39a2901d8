"""Corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of their input.  Decisions are tables of (id, content
hash) and join back by both, so repeated ids and null ids are safe, and the
joins are shuffles that Spark may split or turn into a broadcast by size.  Texts
of any length are read whole, extra columns are carried through all stages but
the last, whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catspark.llm import decontamination, neardup, packing, quality, queries, substring
from catspark.session import materialise


def _same_row(docs: DataFrame, keys: DataFrame) -> Column:
    """Whether a row of ``docs`` is the one that _id and _h of ``keys`` name."""
    return docs["doc_id"].eqNullSafe(keys["_id"]) & (
        F.xxhash64(docs["doc_id"], docs["text"]) == keys["_h"])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts fail them; repeated rows stay or go together;
    null languages and sources are groups of their own.
    """
    kept = quality.quality(docs).where("kept").select("_id", "_h")
    return docs.join(kept, _same_row(docs, kept), "left_semi")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id.

    Of rows that share that id the one whose text has the smallest hash stays,
    once.  Texts without words, null ones too, are in no class and stay.
    """
    firsts = neardup.near_duplicates(docs).where("node = class_id")
    rows = firsts.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("_h").alias("_least"))
    firsts = materialise(firsts.select("_id", "_h", "node").distinct().join(rows, "node")
                         .where("_h = _least").drop("_least"), "firsts")
    single = firsts.where("n = 1")
    one = docs.join(single, _same_row(docs, single), "left_semi")
    # rows that share an id: one of them stays
    shared = firsts.where("n > 1").select("_id", "_h", F.col("node").alias("_shared_node"))
    many = (docs.join(shared, _same_row(docs, shared))
            .select(*[docs[c] for c in docs.columns], "_shared_node")
            .dropDuplicates(["_shared_node"]).drop("_shared_node"))
    return one.unionByName(many)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that start earlier elsewhere.

    Null and empty texts stay as they are; a text that loses all its words stays
    as an empty one.  Rows that agree in id and text are one document, so
    repeated rows keep the same words.
    """
    out = substring.dedup_substrings(docs, carry=True)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)) \
            .otherwise(F.col("row")["n_chars"])
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates.

    Null and empty texts, and all texts if there are no items, are clean;
    repeated rows stay or go together.
    """
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontamination.decontaminate(docs, bench).where("contaminated").select("_id", "_h")
    return docs.join(bad, _same_row(docs, bad), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 token ids, with their ids.

    A null or empty text is the end id alone; repeated rows are pieces of their
    own; very long texts are cut into full sequences and a rest.
    """
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage),
          ("substring_dedup", substring_stage), ("decontamination", decontamination_stage),
          ("packing", packing_stage)]
#: the outlier estimates and the packing order have no SQL twin
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
