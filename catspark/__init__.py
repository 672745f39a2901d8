"""Spark-native text categorisation: catalogue, TF-IDF index, centroids,
recommendation, evaluation and similarity, all as DataFrame -> DataFrame
functions."""

__version__ = "0.1.0"
