"""Spark-native sequence, interval and vector analytics, as lazy DataFrame transformations."""
