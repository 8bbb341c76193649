"""Column profiles per load, exact, by one range sort.

Columns are unpivoted to (column, value), counted per load (which combines
before the shuffle: a value with a third of all rows is one row), and range-sorted
by column and value. Per range the counts of each load are summed and turned into
prefix counts; with these a range knows the exact rank of each of its values. So
every range, by itself, gives the quantiles that fall into it, its share of the
distinct values, and the largest distance of the loads' cumulative curves from the
pooled curve and from each other; a last small aggregation puts the ranges together.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import written


@dataclass(frozen=True)
class NumberColumn:
    """A number column with the range its values are expected in; NaN counts as null."""

    name: str
    low: float
    high: float


@dataclass(frozen=True)
class TextColumn:
    """A text column with the exact spellings expected in it."""

    name: str
    names: tuple[str, ...]


#: Counted values that one range holds, about, and ranges at least.
RANGE_ROWS, LEAST_RANGES = 250_000, 8
_STRUCT = "struct<column_name:string,num:double,txt:string>"


def load_frequencies(df: DataFrame, load: str, columns: list[NumberColumn | TextColumn]) -> DataFrame:
    """``load_id, column_name, num, txt, n``: how often each value of each column occurs in each load."""
    parts = []
    for c in columns:
        if isinstance(c, NumberColumn):
            v = F.col(c.name).cast("double")
            # -0.0 becomes 0.0, NaN null
            num, txt = F.when(~F.isnan(v), v + F.lit(0.0)), F.lit(None).cast("string")
        else:
            num, txt = F.lit(None).cast("double"), F.col(c.name).cast("string")
        parts.append(F.struct(F.lit(c.name).alias("column_name"), num.alias("num"), txt.alias("txt")).cast(_STRUCT))
    return df.select(F.col(load).cast("string").alias("load_id"), F.inline(F.array(*parts))).groupBy("load_id", "column_name", "num", "txt").agg(F.count("*").alias("n"))


def _judged(freq: DataFrame, columns: list[NumberColumn | TextColumn]) -> DataFrame:
    """Adds ``known`` (not null) and ``fits`` (in the range, or one of the names)."""
    fits: Column = F.lit(False)
    for c in columns:
        own = F.col("column_name") == c.name
        good = F.col("num").between(c.low, c.high) if isinstance(c, NumberColumn) else F.col("txt").isin(*c.names)
        fits = F.when(own, F.coalesce(good, F.lit(False))).otherwise(fits)
    return freq.withColumns({"known": F.col("num").isNotNull() | F.col("txt").isNotNull(), "fits": fits})


def _column_stats(part: pd.DataFrame, off: pd.DataFrame, percents: tuple[float, ...]) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """``(stat, loads, values)`` of one column in one range. Work is in proportion to the range's rows and the number of loads, not to their product."""
    numeric = part.num.notna().any()
    codes, _ = pd.factorize(part.num if numeric else part.txt, sort=True)
    size = int(codes.max()) + 1
    off = off.sort_values("load", kind="stable")
    names = off.load.to_numpy()
    before, total, fitting, below = (off[c].to_numpy(dtype=np.float64) for c in ("before", "total", "fitting", "below"))
    load = pd.Index(names).get_indexer(part.load_id)
    order = np.lexsort((codes, load))
    load, code, n = load[order], codes[order].astype(np.int64), part.n.to_numpy(dtype=np.float64)[order]
    value = part.num.to_numpy(dtype=np.float64)[order] if numeric else None
    first, last = np.searchsorted(load, np.arange(len(names))), np.searchsorted(load, np.arange(len(names)), side="right")
    upto = np.concatenate([[0.0], np.cumsum(n)])
    inside = upto[last] - upto[first]
    here = np.flatnonzero(last > first)
    pool_all = total.sum()
    pool = (np.bincount(code, weights=n, minlength=size).cumsum() + before.sum()) / pool_all
    start = before.sum() / pool_all
    with np.errstate(divide="ignore", invalid="ignore"):
        reached = (before[load] + upto[1:] - upto[first[load]]) / total[load]
        missed = reached - n / total[load]
        # A load's curve stands still between its own values while the pool's rises: the farthest points are at a value of its own, just before one, and at the ends.
        far = np.maximum(np.abs(reached - pool[code]), np.abs(missed - np.where(code > 0, pool[code - 1], start)))
        ends = (before + inside) / total
        ks = np.maximum(np.abs(before / total - start), np.abs(ends - pool[-1]))
        ks[here] = np.maximum(ks[here], np.maximum.reduceat(far, first[here])) if len(here) else ks[here]

        # Two loads' curves differ most at a value of either, or at the ends.
        def against(step: int) -> np.ndarray:
            """Per load the greatest distance, at its own values, from the curve of the load ``step`` places on."""
            out = np.full(len(names), -np.inf)
            other = load + step
            known = (other >= 0) & (other < len(names))
            o = other[known]
            at = np.searchsorted(load * size + code, o * size + code[known], side="right")
            theirs = (before[o] + upto[at] - upto[first[o]]) / total[o]
            np.maximum.at(out, load[known], np.abs(reached[known] - theirs))
            return out

        prior = np.full(len(names), np.nan)
        if len(names) > 1:
            edges = np.maximum(np.abs(before[1:] / total[1:] - before[:-1] / total[:-1]), np.abs(ends[1:] - ends[:-1]))
            prior[1:] = np.maximum(edges, np.maximum(against(-1)[1:], against(1)[:-1]))
    out = [("ks", names, ks), ("ks_prior", names, prior), ("distinct", names, (last - first).astype(np.float64))]
    if numeric:
        out += [("min", names[here], value[first[here]]), ("max", names[here], value[last[here] - 1])]
        for p in percents:
            # Both middle ranks, so that a quantile between two values is their mean, among the values that fit.
            at = (fitting - 1) * p
            for side, rank in (("low", np.floor(at) + below), ("high", np.ceil(at) + below)):
                own = np.flatnonzero((fitting > 0) & (before <= rank) & (rank < before + inside))
                place = np.searchsorted(upto[1:], upto[first[own]] + rank[own] - before[own], side="right")
                out.append((f"q{p:g}_{side}", names[own], value[place]))
    return out


def _range_stats(percents: tuple[float, ...]):
    """One range: its sorted frequencies and, per load, the counts before it and in all."""

    def stats(values: pa.Table, before: pa.Table) -> pa.Table:
        v, o = values.to_pandas(), before.to_pandas()
        parts = dict(list(v.groupby("column_name", sort=False)))
        found = [(column, *x) for column, off in o.groupby("column", sort=False) if column in parts for x in _column_stats(parts[column], off, percents)]
        sizes = [len(x[2]) for x in found]
        return pa.table({
            "column_name": pa.array(np.repeat(np.array([x[0] for x in found], dtype=object), sizes), pa.string()),
            "load_id": pa.array(np.concatenate([x[2] for x in found]) if found else [], pa.string()),
            "stat": pa.array(np.repeat(np.array([x[1] for x in found], dtype=object), sizes), pa.string()),
            "value": pa.array(np.concatenate([x[3] for x in found]) if found else [], pa.float64(), from_pandas=True),
        })

    return stats


def column_profile(df: DataFrame, load: str, columns: list[NumberColumn | TextColumn], percents: tuple[float, ...] = (0.25, 0.5, 0.75), range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per load and column: ``load_id, column_name, rows, nulls, fitting, misfits, distinct_values, min_value, max_value, q25.., top_share, zeros, ks, ks_prior``.

    ``fitting`` values lie in the expected range or are spelled exactly as expected, ``misfits`` are the other known ones (infinite numbers too).
    Quantiles are of the fitting values (linear between ranks), as is ``top_share`` of the first expected name and ``zeros``;
    ``distinct_values``, ``min_value``, ``max_value`` and ``ks`` (largest distance of the cumulative curve from that of all loads together) are of all known ones, and so is
    ``ks_prior``, the distance from the load before in the order of their names (null for the first).
    Repeated rows count; a null load is a load of its own; an empty table gives no rows. A column with no known value in a load has null figures.
    """
    freq = written(_judged(load_frequencies(df, load, columns), columns).withColumn("load_id", F.coalesce("load_id", F.lit("\u0000null"))), "freq")
    zero, first = F.lit(False), F.lit(False)
    low: Column = F.lit(None).cast("double")
    for c in columns:
        own = F.col("column_name") == c.name
        if isinstance(c, NumberColumn):
            low = F.when(own, F.lit(float(c.low))).otherwise(low)
        else:
            first = F.when(own, F.col("txt") == c.names[0]).otherwise(first)
    zero = F.col("num") == 0
    n = F.col("n")
    counted = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    summary = freq.groupBy("load_id", "column_name").agg(
        F.sum("n").alias("rows"),
        counted(~F.col("known")).alias("nulls"),
        counted(F.col("fits")).alias("fitting"),
        counted(F.col("known") & ~F.col("fits")).alias("misfits"),
        counted(F.col("fits") & zero).alias("zeros"),
        counted(F.col("fits") & first).alias("first_name"),
        counted(F.col("known") & (F.col("num") < low)).alias("below"),
    )
    # The number of ranges follows the data, so that each fits in one task.
    ranges = max(LEAST_RANGES, -(-freq.count() // range_rows))
    known = freq.where("known").select("load_id", "column_name", "num", "txt", "n")
    # Written once, so that the ranges stay the same whatever is recomputed.
    sort = ["column_name", "num", "txt"]
    ordered = written(known.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort).withColumn("range", F.spark_partition_id()), "ordered")
    spans = ordered.groupBy("range", "column_name", "load_id").agg(F.sum("n").alias("inside"))
    # Each load needs a row for each range of its column, also where it has no value.
    grid = spans.select("range", "column_name").distinct().join(summary.select("column_name", "load_id", "rows", "nulls", "fitting", "below"), "column_name")
    prefix = Window.partitionBy("column_name", "load_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = grid.join(spans, ["range", "column_name", "load_id"], "left").select(
        # New names: both sides of the cogroup come from one table.
        F.col("range").alias("at"), F.col("column_name").alias("column"), F.col("load_id").alias("load"),
        F.coalesce(F.sum("inside").over(prefix), F.lit(0)).alias("before"),
        (F.col("rows") - F.col("nulls")).alias("total"), "fitting", "below",
    )
    found = ordered.groupBy("range").cogroup(before.groupBy("at")).applyInArrow(_range_stats(percents), "column_name string, load_id string, stat string, value double")
    pick = lambda stat, how: how(F.when(F.col("stat") == stat, F.col("value")))
    aggs = [pick("ks", F.max).alias("ks"), pick("ks_prior", F.max).alias("ks_prior"), pick("distinct", F.sum).cast("bigint").alias("distinct_values"), pick("min", F.min).alias("min_value"), pick("max", F.max).alias("max_value")]
    for p in percents:
        lo, hi = pick(f"q{p:g}_low", F.max), pick(f"q{p:g}_high", F.max)
        part = F.max("fitting_").cast("double")
        at = (part - 1) * p
        aggs.append((lo + (hi - lo) * (at - F.floor(at))).alias(f"q{round(p * 100)}"))
    sized = summary.select("load_id", "column_name", F.col("fitting").alias("fitting_"))
    stats = found.join(sized, ["load_id", "column_name"]).groupBy("load_id", "column_name").agg(*aggs)
    share = F.try_divide(F.col("first_name"), F.col("fitting"))
    return (
        summary.join(stats, ["load_id", "column_name"], "left")
        .withColumn("top_share", share)
        .withColumn("load_id", F.when(F.col("load_id") != "\u0000null", F.col("load_id")))
        .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
        .drop("below", "first_name")
    )


def deviating_loads(
    profile: DataFrame, columns: list[NumberColumn | TextColumn], null_share: float = 0.08, range_share: float = 0.03, pattern_share: float = 0.05, ratio: float = 1.5, difference: float = 0.2, by_median: tuple[str, ...] = ()
) -> DataFrame:
    """``load_id, column_name, finding``: the loads that differ from the rest.

    ``nulls``, ``range`` (numbers) and ``pattern`` (texts) are shares beyond their bound; ``shift`` compares one figure of a load with the median
    of it over all loads: the median of columns in ``by_median`` by ``ratio``, the share of zeros of other numbers and of the first name of texts by ``difference``.
    A load without a fitting value has no figure and no shift.
    """
    texts = [c.name for c in columns if isinstance(c, TextColumn)]
    known = F.col("rows") - F.col("nulls")
    text = F.col("column_name").isin(*texts) if texts else F.lit(False)
    median = F.col("column_name").isin(*by_median) if by_median else F.lit(False)
    figure = F.when(median, F.col("q50")).when(text, F.col("top_share")).otherwise(F.try_divide(F.col("zeros"), F.col("fitting")))
    p = profile.withColumn("figure", figure)
    # One row per load: a column's loads fit in one task.
    p = p.withColumn("usual", F.percentile("figure", 0.5).over(Window.partitionBy("column_name")))
    off = F.when(median, (F.col("figure") > F.col("usual") * ratio) | (F.col("figure") < F.col("usual") / ratio)).otherwise(F.abs(F.col("figure") - F.col("usual")) > difference)
    # Decimals, so that a share exactly on its bound isn't beyond it.
    exact = lambda x: F.lit(Decimal(str(x)))
    bad = F.when(text, F.col("misfits") > known * exact(pattern_share)).otherwise(F.col("misfits") > known * exact(range_share))
    findings = F.array(
        F.when(F.col("nulls") > F.col("rows") * exact(null_share), "nulls"),
        F.when(bad & ~text, "range"),
        F.when(bad & text, "pattern"),
        F.when(off, "shift"),
    )
    return p.select("load_id", "column_name", F.explode(F.array_compact(findings)).alias("finding"))
