"""dailylake: a Spark-native daily lakehouse for per-location observations."""

__version__ = "0.1.0"
