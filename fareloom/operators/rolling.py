"""Totals over trailing periods by binary doubling.

``S1`` of a day is its own total, ``S2`` that of two days, ``S4``, ``S8`` and
``S16`` of 4, 8 and 16, each from two blocks of the size before. A window of
any length is a sum of disjoint blocks (7 = 4 + 2 + 1, 30 = 16 + 8 + 4 + 2):
a handful of additions a day, however long the window.

Rows are first added up per entity and day, which combines before the shuffle,
so an entity's share of the rows doesn't matter: it has one row a day. All
blocks use the same partitioning and order, so there is one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def every_day(daily: DataFrame, key: str, day: str, measures: list[str]) -> DataFrame:
    """One row per entity and day from its first to its last day; days without a row have zeros.

    ``daily`` has one row per entity and day. Each row fills the days up to the next one, so no calendar is joined.
    """
    order = Window.partitionBy(key).orderBy(day)
    following = F.coalesce(F.date_sub(F.lead(day).over(order), 1), F.col(day))
    spread = daily.withColumn("_until", following).select(key, F.col(day).alias("_at"), *measures, F.explode(F.sequence(F.col(day), F.col("_until"))).alias(day))
    own = F.col("_at") == F.col(day)
    return spread.select(key, day, *(F.when(own, F.col(m)).otherwise(F.lit(0)).alias(m) for m in measures))


def rolling_totals(daily: DataFrame, key: str, day: str, measures: list[str], windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """``key, day, <measure>_<window>...`` for each entity and day from its first to its last.

    ``daily``: rows per entity and day, ``measures`` whole numbers or doubles; several rows of one day add up, null measures count as zero.
    Rows with a null key or day are left out. All days between become rows, so days that are only placeholders should be left out before. Days before an entity's first count as zero. Each total
    holds the day itself. An empty table gives an empty result; further columns are not read.
    """
    if not windows or min(windows) < 1:
        raise ValueError("windows must be whole numbers of days from 1")
    # Where the rows come grouped by entity and day already, this adds no shuffle.
    base = daily.where(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, day).agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures))
    dense = every_day(base, key, day, measures)
    order = Window.partitionBy(key).orderBy(day)
    top = max(windows).bit_length() - 1

    def block(m: str, p: int) -> str:
        return f"_{m}_{1 << p}"

    def back(c: str, by: int) -> Column:
        return F.coalesce(F.lag(c, by).over(order), F.lit(0)) if by else F.col(c)

    out = dense.withColumnsRenamed({m: block(m, 0) for m in measures})
    for p in range(1, top + 1):
        out = out.withColumns({block(m, p): F.col(block(m, p - 1)) + back(block(m, p - 1), 1 << (p - 1)) for m in measures})
    totals = {}
    for m in measures:
        for w in windows:
            done, total = 0, None
            for p in range(top, -1, -1):
                if w >> p & 1:
                    part = back(block(m, p), done)
                    total = part if total is None else total + part
                    done += 1 << p
            totals[f"{m}_{w}"] = total
    return out.select(key, day, *(c.alias(n) for n, c in totals.items()))
