"""Aggregations beyond a plain group by."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio_pivot(df: DataFrame, by: list[str], column: str, names: list[str], top: Column, bottom: Column) -> DataFrame:
    """Per group one column per name: sum of ``top`` over sum of ``bottom``; null where the bottom is 0 or absent. The names are given, so no pass looks for them."""
    aggs = []
    for n in names:
        own = F.col(column) == n
        aggs.append(F.try_divide(F.sum(F.when(own, top)), F.nullif(F.sum(F.when(own, bottom)), F.lit(0))).alias(n.lower().replace(" ", "_")))
    return df.groupBy(*by).agg(*aggs)


def top_and_other(df: DataFrame, column: str, top: int, by: list[str] | None = None) -> DataFrame:
    """``*by, label, n``: the ``top`` most frequent values (ties by value) and one row ``other`` for the rest, with the number of values in ``members``."""
    by = by or []
    counted = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("string").alias("_v")).agg(F.count("*").alias("_n"))
    ranked = counted.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_n"), "_v"))) if by else _ranked_globally(counted, top)
    label = F.when(F.col("_r") <= top, F.col("_v")).otherwise(F.lit("other"))
    return ranked.groupBy(*by, (F.col("_r") <= top).alias("_in"), label.alias("label")).agg(F.sum("_n").alias("n"), F.count("*").alias("members")).drop("_in")


def _ranked_globally(counted: DataFrame, top: int) -> DataFrame:
    """Without groups the leaders come from a distributed top-k, not from one task that sorts all values."""
    leaders = counted.orderBy(F.desc("_n"), "_v").limit(top).select("_v", F.lit(1).alias("_r"))
    return counted.join(F.broadcast(leaders), "_v", "left").withColumn("_r", F.coalesce("_r", F.lit(top + 1)))


def histogram(df: DataFrame, value: Column, low: float, width: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """``*by, bin, n``: rows per bin of equal width; values below and above fall into the first and last bin, unusable ones into none."""
    by = by or []
    known = value.isNotNull() & ~F.isnan(value)
    bin_ = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((value - low) / width))).cast("int")
    return df.where(known).groupBy(*by, bin_.alias("bin")).agg(F.count("*").alias("n"))


def largest_remainder(df: DataFrame, label: str, weight: str, total: int) -> DataFrame:
    """``label, weight, units``: ``total`` whole units shared in proportion to weights; what is left goes to the largest remainders, ties by label.

    The labels are those of a fixed dimension (their sum and rank need one task).
    """
    whole = Window.partitionBy()
    exact = F.col(weight) * F.lit(total) / F.sum(weight).over(whole)
    cut = df.select(label, weight, F.floor(exact).alias("_u"), F.round(exact - F.floor(exact), 9).alias("_rest"))
    left = F.lit(total) - F.sum("_u").over(whole)
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("_rest"), label))
    return cut.withColumns({"_left": left, "_rank": rank}).select(label, weight, (F.col("_u") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0)).cast("bigint").alias("units"))


def expand_units(df: DataFrame, label: str, units: str) -> DataFrame:
    """``label, unit_id``: one row per unit, numbered ``label#00000``; no row for 0 units."""
    return df.where(F.col(units) > 0).select(label, F.explode(F.sequence(F.lit(0), F.col(units).cast("int") - 1)).alias("_i")).select(label, F.concat(F.col(label), F.lit("#"), F.lpad(F.col("_i").cast("string"), 5, "0")).alias("unit_id"))


def one_or_mixed(c: Column) -> Column:
    """Aggregate: the only value of a group, ``MIXED`` if there are several, null if none."""
    return F.when(F.count_distinct(c) > 1, F.lit("MIXED")).otherwise(F.min(c))


def best_block(weights: Column, size: int) -> Column:
    """Start (from 0) of the run of ``size`` neighbours with the greatest sum in an array; of equal ones the first."""
    sums = F.transform(F.sequence(F.lit(1), F.size(weights) - size + 1), lambda i: F.aggregate(F.slice(weights, i, size), F.lit(0).cast("bigint"), lambda a, x: a + x))
    return F.array_position(sums, F.array_max(sums)) - 1


def occurrence(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Adds ``occurrence``, 1, 2, ... within rows of an equal key (nulls are equal)."""
    return df.withColumn("occurrence", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def latest(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """Rows of the greatest version of each key. The version list is aggregated first, so a hot key isn't collected into one window."""
    top = df.groupBy(*key).agg(F.max(version).alias("_top"))
    return df.join(top, key).where(F.col(version) == F.col("_top")).drop("_top")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, by name."""
    return reduce(DataFrame.unionByName, frames)


def top_shares(df: DataFrame, key: list[str], category: str, share: float) -> DataFrame:
    """``*key, category, n, share`` of the categories that hold at least ``share`` of a key's rows. Null categories count for the whole but are none."""
    counted = df.groupBy(*key, category).agg(F.count("*").alias("n"))
    whole = counted.groupBy(*key).agg(F.sum("n").alias("_all"))
    return counted.join(whole, key).where(F.col(category).isNotNull() & (F.col("n") >= F.col("_all") * F.lit(Decimal(str(share))))).select(*key, category, "n", (F.col("n") / F.col("_all")).alias("share"))
