"""Spark-native engine for web corpora, task datasets and their queues."""
