"""lavra: Spark-native extraction analytics over trees of heterogeneous documents."""

__version__ = "0.1.0"
