"""Daily and monthly series: calendars, interpolation, recursion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``day`` from first to last, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))


def month_days(month: Column) -> Column:
    """All days of a month ``yyyy-MM`` as an array."""
    first = F.to_date(F.concat(month, F.lit("-01")))
    return F.sequence(first, F.last_day(first))


def interpolate(points: DataFrame, grid: DataFrame, at: str, value: str, key: list[str] | None = None) -> DataFrame:
    """``*key, at, value, kind`` for every row of ``grid``: linear between the neighbouring observations, constant beyond the first and last.

    ``kind`` is ``observed``, ``interpolated`` or ``extended``. ``at`` is a whole number in both (days or months since some day); ``points`` has one row per key and place.
    Null values are no observations; a key without any gets nulls. Neighbours are carried by two running windows, not by range joins.
    """
    key = key or []
    both = grid.select(*key, at).distinct().join(points.where(F.col(value).isNotNull()).select(*key, at, F.col(value).alias("_v")), [*key, at], "full")
    placed = F.when(F.col("_v").isNotNull(), F.struct(F.col(at).alias("x"), F.col("_v").alias("y")))
    order = Window.partitionBy(*key).orderBy(at) if key else Window.partitionBy(F.lit(0)).orderBy(at)
    before = F.last(placed, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(placed, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    filled = both.withColumns({"_b": before, "_a": after})
    b, a = F.col("_b"), F.col("_a")
    between = b["y"] + (a["y"] - b["y"]) * (F.col(at) - b["x"]) / (a["x"] - b["x"])
    result = F.when(F.col("_v").isNotNull(), F.col("_v")).when(b.isNull(), a["y"]).when(a.isNull(), b["y"]).otherwise(between)
    kind = F.when(F.col("_v").isNotNull(), "observed").when(b.isNull() & a.isNull(), None).when(b.isNull() | a.isNull(), "extended").otherwise("interpolated")
    wanted = grid.select(*key, at).distinct()
    return filled.select(*key, at, result.alias(value), kind.alias("kind")).join(wanted, [*key, at], "left_semi")


def decayed(values: DataFrame, key: list[str], at: str, value: str, factor: float) -> DataFrame:
    """``*key, at, state`` of the recursion state = factor * previous + value along ``at``; null values count as 0.

    By doubling: the state over the last 2 n values is that over the last n, plus factor^n times the state n values ago. A series of n values takes log2(n) steps, all over
    one partitioning and order, and no row holds a series.
    """
    base = values.select(*key, F.col(at).cast("int").alias(at), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("state"))
    longest = base.groupBy(*key).count().agg(F.max("count")).first()[0] or 1
    order = Window.partitionBy(*key).orderBy(at)
    n = 1
    while n < longest:
        base = base.withColumn("state", F.col("state") + F.lit(factor**n) * F.coalesce(F.lag("state", n).over(order), F.lit(0.0)))
        n *= 2
    return base


def clipped(c: Column, low: Column | float, high: Column | float) -> Column:
    """The value moved into the bounds."""
    bound = lambda b: b if isinstance(b, Column) else F.lit(b)
    return F.least(F.greatest(c, bound(low)), bound(high))


def staleness(df: DataFrame, key: list[str], at: str, as_of: str, allowed_days: int) -> DataFrame:
    """``*key, last, days, stale``: days between a key's last date not after ``as_of`` and ``as_of``; a key with later dates only is stale."""
    last = F.max(F.when(F.col(at) <= F.lit(as_of).cast("date"), F.col(at)))
    days = F.datediff(F.lit(as_of).cast("date"), F.col("last"))
    return df.groupBy(*key).agg(last.alias("last")).withColumn("days", days).withColumn("stale", F.coalesce(days > allowed_days, F.lit(True)))


def in_month(c: Column, month: Column | str) -> Column:
    """Whether a date or time lies in a month ``yyyy-MM``: a filter, not an assertion; null for null."""
    return F.date_format(c, "yyyy-MM") == (F.lit(month) if isinstance(month, str) else month)


def watermark(df: DataFrame, key: list[str], period: str, at: str, as_of: str, allowed_days: int) -> DataFrame:
    """``*key, period, last, days, stale``: the newest period of a key with the time it last succeeded; success of an older period doesn't advance it."""
    newest = df.groupBy(*key).agg(F.max(F.struct(F.col(period).alias("p"), F.col(at).alias("t"))).alias("_m"))
    days = F.datediff(F.lit(as_of).cast("date"), F.col("last"))
    return newest.select(*key, F.col("_m.p").alias(period), F.to_date("_m.t").alias("last")).withColumn("days", days).withColumn("stale", F.coalesce(F.col("days") > allowed_days, F.lit(True)))


def spread_months(monthly: DataFrame, month: str, columns: list[str], key: list[str] | None = None) -> DataFrame:
    """``*key, day, columns...``: the values of a month on each of its days."""
    return monthly.select(*(key or []), F.explode(month_days(F.col(month))).alias("day"), *columns)


def daily_status(df: DataFrame, days: DataFrame, day: str, value: str, low: float, high: float) -> DataFrame:
    """``day, n, status`` of every day of ``days``: ``missing``, ``repeated``, ``unusable`` (null, NaN, or not strictly between the bounds) or ``ok``."""
    good = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & (F.col(value) > low) & (F.col(value) < high)
    per = df.groupBy(day).agg(F.count("*").alias("n"), F.count_if(F.coalesce(good, F.lit(False))).alias("_good"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(F.col("_good") == 0, "unusable").otherwise("ok")
    return days.join(per, day, "left").select(day, F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))


def merge_daily(a: DataFrame, b: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Every day of ``days`` with the columns of both series and ``complete``."""
    return days.join(a.withColumn("_a", F.lit(True)), day, "left").join(b.withColumn("_b", F.lit(True)), day, "left").withColumn("complete", F.col("_a").isNotNull() & F.col("_b").isNotNull()).drop("_a", "_b")


def forward_fill(df: DataFrame, key: list[str], at: str, columns: list[str]) -> DataFrame:
    """Nulls take the last value before them in the order of ``at``; leading nulls stay."""
    order = Window.partitionBy(*key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(order) for c in columns})
