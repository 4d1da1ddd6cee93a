"""Spark-native match analytics: readers, cleansing, identity resolution, statistics and incremental ingest."""
