"""lexarium: Spark-native analytics for large corpora of long, clause-structured documents."""

__version__ = "0.1.0"
