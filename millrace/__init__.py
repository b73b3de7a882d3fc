"""Spark-native text corpus pipeline: DataFrame operators from stored pages to packed tokens."""
