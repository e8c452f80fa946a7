"""Spark-native analytics jobs: data quality, marts, series, experiments, models, text, segments."""
