"""Per-key results where a few keys hold most rows.

Rows are grouped by key *and value* before they are grouped by key: a hot key
is spread over the shuffle by its values and arrives as (value, count) pairs,
as many as it has different values, not as many as it has rows. Distinct
counts, modes, totals and percentiles are exact and come from these weighted values.
Percentiles don't sort a key in one task: its values fall into bins that are in
the order of the values; the bins' counts locate the bin of each rank, which is cut into finer bins between its own least and
greatest value, and only the finer bin that holds the rank is ordered.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_frequencies(df: DataFrame, keys: list[str], value: Column | str) -> DataFrame:
    """``key_column, key_value, value, n``: how often each value stands beside each key.

    Every column of ``keys`` counts for itself; keys are given as text, exactly as stored, null keys are left out.
    Null values are kept as a value, so that ``n`` adds up to the rows of the key. NaN is one value, -0.0 is 0.0.
    """
    v = F.col(value) if isinstance(value, str) else value
    each = F.array(*(F.struct(F.lit(k).alias("key_column"), F.col(k).cast("string").alias("key_value")) for k in keys))
    rows = df.select(F.inline(each), v.alias("value"))
    return rows.where("key_value is not null").groupBy("key_column", "key_value", "value").agg(F.count("*").alias("n"))


def key_totals(freq: DataFrame) -> DataFrame:
    """``rows, known, distinct_values, total`` per key. ``total`` adds value times count over finite values."""
    v, n = F.col("value"), F.col("n")
    kind = dict(freq.dtypes)["value"]
    numeric = kind in ("double", "float") or kind in ("bigint", "int", "smallint", "tinyint") or kind.startswith("decimal")
    usable = v.isNotNull()
    if kind in ("double", "float"):
        usable = usable & ~F.isnan(v) & (F.abs(v) != float("inf"))
    aggs = [F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(usable, n)), F.lit(0)).alias("known"), F.count(F.when(usable, 1)).alias("distinct_values")]
    if numeric:
        aggs.append(F.sum(F.when(usable, v * n)).alias("total"))
    return freq.groupBy("key_column", "key_value").agg(*aggs)


def key_modes(freq: DataFrame) -> DataFrame:
    """``mode, mode_rows`` per key; of values equally frequent the smallest. A key whose values are all null has none. It combines before the shuffle: no task sees all values of a key."""
    known = freq.where("value is not null").groupBy("key_column", "key_value")
    return known.agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("mode"), F.max("n").alias("mode_rows"))


def heavy_keys(freq: DataFrame, all_rows: DataFrame, share: float) -> DataFrame:
    """``key_column, key_value, rows, share`` of keys that hold at least ``share`` of all rows.

    ``all_rows`` is the table the frequencies were taken from; its count, one number, is the denominator and includes rows with null keys.
    """
    count = all_rows.agg(F.count("*").alias("_all"))
    totals = freq.groupBy("key_column", "key_value").agg(F.sum("n").alias("rows"))
    return totals.crossJoin(F.broadcast(count)).where(F.col("rows") >= F.col("_all") * F.lit(Decimal(str(share)))).select("key_column", "key_value", "rows", (F.col("rows") / F.col("_all")).alias("share"))


def _bin(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: 32 bins for each doubling, either side of zero."""
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * 32)).cast("bigint")


def _located(usable: DataFrame, at: list[str], bin_: str, targets: DataFrame | None, wanted: Column | None) -> DataFrame:
    """``*at, bin_, before, t, low, high``: the bins that hold a wanted rank, the count before each, the ranks, and the ends of the bin."""
    bins = usable.groupBy(*at, bin_).agg(F.sum("n").alias("_in"), F.min("v").alias("low"), F.max("v").alias("high"))
    ahead = Window.partitionBy(*at).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_ahead", F.coalesce(F.sum("_in").over(ahead), F.lit(0)))
    if targets is None:
        bins = bins.withColumns({"before": F.col("_ahead"), "all": F.sum("_in").over(Window.partitionBy(*at))}).withColumn("t", wanted)
    else:
        bins = bins.join(targets.select(*at, F.col("before").alias("_start"), "t"), at).withColumn("before", F.col("_start") + F.col("_ahead"))
    held = F.filter("t", lambda t: (t["rank"] > F.col("before")) & (t["rank"] <= F.col("before") + F.col("_in")))
    return bins.withColumn("t", held).where(F.size("t") > 0).select(*at, bin_, "before", "t", "low", "high")


#: Finer bins of the bin that holds a rank.
FINER = 4096


def key_percentiles(freq: DataFrame, percents: list[int]) -> DataFrame:
    """``key_column, key_value, percent, value``: exact percentiles per key (the smallest value whose rank reaches percent of the count).

    Only finite values count; a key without any has no rows here. ``value`` must be a number.
    """
    v = F.col("value").cast("double")
    usable = freq.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))).withColumns({"v": v, "bin": _bin(v)})
    key = ["key_column", "key_value"]
    wanted = F.array(*(F.struct(F.lit(p).alias("percent"), F.greatest(F.lit(1), F.ceil(F.col("all") * F.lit(p) / 100)).cast("bigint").alias("rank")) for p in percents))
    coarse = _located(usable, key, "bin", None, wanted)
    part = F.when(F.col("high") > F.col("low"), F.floor((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * FINER)).otherwise(0).cast("int")
    near = usable.join(coarse.select(*key, "bin", "low", "high"), [*key, "bin"]).withColumn("finer", part).drop("low", "high")
    fine = _located(near, [*key, "bin"], "finer", coarse, None)
    order = Window.partitionBy(*key, "bin", "finer").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    last = near.join(fine.select(*key, "bin", "finer", "before", "t"), [*key, "bin", "finer"]).withColumn("upto", F.col("before") + F.sum("n").over(order))
    hit = F.filter("t", lambda t: (t["rank"] <= F.col("upto")) & (t["rank"] > F.col("upto") - F.col("n")))
    return last.select(*key, F.col("value"), F.explode(hit).alias("h")).select(*key, F.col("h.percent").alias("percent"), "value")
