"""The named tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A pick-up outside this range is a placeholder.
USABLE_FROM, USABLE_TO = "2025-02-01 00:00:00", "2025-06-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. Columns and filters of the query reach this scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
