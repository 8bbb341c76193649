"""Row rules, gates, contracts and reconciliation. Every check is one aggregation over the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def failed_casts(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """Per field of the schema: true where a value is missing or cannot be read as the field's type."""
    have = set(df.columns)
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return {f.name: F.col(f.name).try_cast(f.dataType).isNull() for f in schema}


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the fields of the schema, in its order and types; what cannot be cast is null."""
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def flag(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``reasons``, the names of the rules a row breaks, in their order. A rule holds where it is true; null breaks it."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.withColumn("reasons", broken)


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with their reasons."""
    flagged = flag(df, rules)
    return flagged.where(F.size("reasons") == 0).drop("reasons"), flagged.where(F.size("reasons") > 0)


def rule_counts(df: DataFrame, rules: dict[str, Column], by: list[str]) -> DataFrame:
    """``*by, total, valid, invalid, <rule>...``: rows and, per rule, rows that break it. Reasons overlap, so they needn't add up."""
    kept = {name: F.coalesce(ok, F.lit(False)) for name, ok in rules.items()}
    every = reduce(lambda a, b: a & b, kept.values(), F.lit(True))
    return df.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(every).alias("valid"), F.count_if(~every).alias("invalid"), *(F.count_if(~ok).alias(name) for name, ok in kept.items())
    )


def gate(counts: DataFrame, warn: float, fail: float, inclusive: bool = True) -> DataFrame:
    """Adds ``ratio`` of ``invalid`` to ``total`` and ``verdict``: ``fail`` from the second bound on, ``warn`` from the first.

    No rows at all fail. With ``inclusive`` a ratio on a bound reaches it, else it must exceed it. A ratio of 0 never warns.
    """
    if not 0 <= warn < fail <= 1:
        raise ValueError("bounds must be 0 <= warn < fail <= 1")
    ratio = F.try_divide(F.col("invalid"), F.col("total"))
    reached = (lambda b: ratio >= b) if inclusive else (lambda b: ratio > b)
    verdict = F.when((F.col("total") == 0) | reached(fail), "fail").when((F.col("invalid") > 0) & reached(warn), "warn").otherwise("pass")
    return counts.withColumns({"ratio": ratio, "verdict": verdict})


def key_counts(df: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """``rows, keys, null_keys``: whether a key is unique and present, from one aggregation by key and one over keys."""
    by = by or []
    absent = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    per = df.groupBy(*by, *(k for k in key if k not in by)).agg(F.count("*").alias("_n"), F.max(absent).alias("_absent"))
    return per.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(~F.col("_absent")).alias("keys"), F.coalesce(F.sum(F.when(F.col("_absent"), F.col("_n"))), F.lit(0)).alias("null_keys"))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with ``count``."""
    return df.groupBy(*key).count().where("count > 1")


def null_contract(df: DataFrame, required: list[str]) -> DataFrame:
    """One row: ``rows``, ``broken`` (rows with a null in a required column) and the nulls of each."""
    any_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in required))
    return df.agg(F.count("*").alias("rows"), F.count_if(any_null).alias("broken"), *(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in required))


def unmatched(left: DataFrame, right: DataFrame, on: list[str], samples: int | None = None) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` doesn't have (null keys match nothing); with ``samples`` the first few in order."""
    missing = left.select(*on).distinct().join(right.select(*on).distinct(), on, "left_anti")
    return missing.orderBy(*on).limit(samples) if samples else missing


def control_totals(parts: dict[str, DataFrame], sums: dict[str, Column]) -> DataFrame:
    """``part, rows, <sum>...`` of each frame: what must stay the same between steps."""
    frames = [df.agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items())).select(F.lit(name).alias("part"), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, frames)


def same_within(a: Column, b: Column, relative: float = 1e-9, absolute: float = 1e-6) -> Column:
    """Equality of two totals within tolerances."""
    return F.abs(a - b) <= F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))


def schema_difference(have: T.StructType, want: T.StructType) -> dict[str, list[str]]:
    """Names that are missing, extra, or of another type. Nullability and order don't count."""
    a, b = {f.name: f.dataType for f in have}, {f.name: f.dataType for f in want}
    return {"missing": sorted(b.keys() - a.keys()), "extra": sorted(a.keys() - b.keys()), "mismatched": sorted(n for n in a.keys() & b.keys() if a[n] != b[n])}


def require_columns(df: DataFrame, columns: list[str], non_empty: bool = True) -> None:
    """Fails where columns are missing, or where there is no row."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if non_empty and df.isEmpty():
        raise ValueError("no rows")


def empty_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, rows, nulls, blanks, nans`` of each column, from one pass. Blanks are texts without anything but blanks, NaN occurs in doubles and floats."""
    kinds = dict(df.dtypes)
    aggs = []
    for c in columns:
        blank = F.trim(F.col(c)) == "" if kinds[c] == "string" else F.lit(False)
        nan = F.isnan(F.col(c)) if kinds[c] in ("double", "float") else F.lit(False)
        aggs.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_if(F.coalesce(blank, F.lit(False))).alias("blanks"), F.count_if(F.coalesce(nan, F.lit(False))).alias("nans")).alias(f"_{len(aggs)}"))
    return df.agg(*aggs).select(F.inline(F.array(*(f"_{i}" for i in range(len(columns))))))


def suite(df: DataFrame, checks: dict[str, tuple[Column, float]], by: list[str] | None = None) -> DataFrame:
    """``*by, check, total, failed, passed``: each check is a condition and the share of rows for which it must hold at least (1 for all).

    A null doesn't hold. No rows pass nothing. All checks come from one aggregation.
    """
    by = by or []
    counts = df.groupBy(*by).agg(F.count("*").alias("total"), *(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, (c, _) in checks.items()))
    each = F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("failed"), ((F.col("total") > 0) & (F.col("total") - F.col(n) >= F.col("total") * F.lit(share))).alias("passed")) for n, (_, share) in checks.items()))
    return counts.select(*by, "total", F.inline(each)).select(*by, "check", "total", "failed", "passed")


def errors(df: DataFrame, rules: dict[str, Column], key: list[str]) -> DataFrame:
    """``*key, reason``: every broken rule of every row, so that all are known before anything fails."""
    return flag(df, rules).select(*key, F.explode("reasons").alias("reason"))


def fail_on(found: DataFrame, what: str, shown: int = 5) -> None:
    """Fails with a few of the rows, if there are any."""
    some = found.limit(shown).collect()
    if some:
        raise ValueError(f"{what}: {[tuple(r) for r in some]}")


def reconciled(source: DataFrame, parts: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """``*by, total, <part>..., balanced``: rows of the source against those of its parts, each counted for itself."""
    out = source.groupBy(*by).agg(F.count("*").alias("total"))
    for name, df in parts.items():
        out = out.join(df.groupBy(*by).agg(F.count("*").alias(name)), by, "full")
    zero = lambda c: F.coalesce(c, F.lit(0))
    counted = out.select(*by, zero("total").alias("total"), *(zero(n).alias(n) for n in parts))
    return counted.withColumn("balanced", F.col("total") == reduce(lambda a, b: a + b, (F.col(n) for n in parts)))


def key_collisions(df: DataFrame, key: list[str], most: float) -> DataFrame:
    """One row: ``rows, keys, collisions, ratio, verdict``: rows beyond the first of their key, and ``fail`` from the share ``most`` on. Equal nulls are one key; no rows fail."""
    per = df.groupBy(*key).agg(F.count("*").alias("_n"))
    one = per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("*").alias("keys")).withColumn("collisions", F.col("rows") - F.col("keys"))
    ratio = F.try_divide(F.col("collisions"), F.col("rows"))
    return one.withColumns({"ratio": ratio, "verdict": F.when((F.col("rows") == 0) | (ratio >= most), "fail").otherwise("pass")})


def same_signature(have: T.StructType, want: T.StructType) -> bool:
    """Names and types agree; whether a timestamp has a zone counts, its precision and nullability don't."""
    return [(f.name, f.dataType.simpleString()) for f in have] == [(f.name, f.dataType.simpleString()) for f in want]
