"""End-to-end plans over one corpus directory.

``Pipeline`` wires the bound tables, the index, the hold-out split, the
centroids and the recommendations together as lazy DataFrames.  Nothing is
collected; heavy shared intermediates can be persisted with ``persist()``
(a written table under the shared checkpoint folder, so lost executors do
not force a recomputation from the text).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import classify as K
from ..operators import evaluate as E
from ..operators.index import Index
from ..operators.topn import best_categories
from ..session import materialise
from ..sources.tables import Catalogue


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (results compared across engines)."""
    cols = [F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, stem: bool = True,
                 min_pages: int = 5, fraction: float = 0.2, persist: bool = True):
        self.spark = spark
        # the bound catalogue tables are written once, like stored tables, when first read
        self.cat = Catalogue(spark, sf_dir, materialise) if persist else Catalogue(spark, sf_dir)
        self.stem = stem
        self.min_pages = min_pages
        self.fraction = fraction
        self.persist = persist

    @cached_property
    def index(self) -> Index:
        return Index(self.cat.texts, stem=self.stem)

    @cached_property
    def vectors(self) -> DataFrame:
        v = self.index.page_vectors()
        return materialise(v, "page_vectors") if self.persist else v

    @cached_property
    def holdout(self) -> DataFrame:
        h = E.holdout_split(self.cat.pages, self.fraction)
        return materialise(h, "holdout") if self.persist else h

    @cached_property
    def cent_cats(self) -> DataFrame:
        return K.centroid_categories(self.cat.catpage, self.min_pages)

    @cached_property
    def centroids(self) -> DataFrame:
        c = K.centroids(self.vectors, self.cat.catpage, self.min_pages, self.holdout)
        return materialise(c, "centroids") if self.persist else c

    @cached_property
    def recommended(self):
        """(recommendations, counts) for the hold-out pages, written once:
        both are small (n rows per page) and every measure reads them."""
        counts = K.suggestion_counts(self.holdout, self.cat.catpage, self.cent_cats)
        counts = materialise(counts, "counts") if self.persist else counts
        page_vecs = self.vectors.join(self.holdout, "title", "left_semi")
        scores = best_categories(page_vecs, self.centroids, counts, self.cent_cats)
        recs = K.recommendations(scores, counts, self.cent_cats)
        return (materialise(recs, "recommendations") if self.persist else recs), counts

    @property
    def recs(self) -> DataFrame:
        return self.recommended[0]

    @property
    def counts(self) -> DataFrame:
        return self.recommended[1]

    @cached_property
    def measures(self) -> DataFrame:
        return K.measures(self.recs, self.cat.catpage, self.cat.catsub, self.counts)

    def summary(self) -> DataFrame:
        m = self.measures
        return m.agg(
            F.count(F.lit(1)).alias("n_pages"),
            F.sum("boolean").alias("n_success"),
            F.avg("boolean").alias("mean_boolean"),
            F.avg("fractional").alias("mean_fractional"),
            F.avg("hierarchical").alias("mean_hierarchical"),
            F.avg("hierarchical_as_written").alias("mean_hierarchical_as_written"),
            F.stddev_pop("fractional").alias("std_fractional"))
