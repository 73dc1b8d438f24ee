"""Spark-native campaign analytics: cost metrics, encoders, splits, kNN models,
two-stage scoring and configuration recommendation, all as DataFrame -> DataFrame
functions."""

__version__ = "0.1.0"
