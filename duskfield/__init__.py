"""Spark-native analytics over detection catalogues: joins by radius, clustering, light curves, scoring."""

__version__ = "0.1.0"
