"""Spark-native tables of sensor events, ready for training."""
