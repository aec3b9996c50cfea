"""Spark-native scoring of perception output against ground truth."""
