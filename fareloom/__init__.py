"""fareloom: DataFrame-first analytics for fleet, trip and text data on Spark."""

__version__ = "0.1.0"
