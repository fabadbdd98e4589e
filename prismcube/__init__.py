"""Spark-native analytics over hyperspectral cubes and, in a subpackage of its own, training text."""
