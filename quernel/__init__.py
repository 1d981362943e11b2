"""quernel: a Spark-first engine for turning repositories into analysis-ready tables."""

__version__ = "0.1.0"
