"""DataFrame -> DataFrame operators of the three domains."""

from tallyspark.operators import graph, sketch, wordcount

__all__ = ["graph", "sketch", "wordcount"]
