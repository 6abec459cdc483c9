"""Spark-native analytics over dated snapshots of public registries."""
