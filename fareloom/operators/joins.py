"""Joins with more to them than an equality.

The small side is broadcast only where it is bounded by what it is (a fixed dimension table);
elsewhere Spark decides from the sizes it measures.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.columns import bucket_of
from fareloom.session import written


def null_safe_join(left: DataFrame, right: DataFrame, key: list[str], null_safe: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``key`` columns and on ``null_safe`` columns that are equal or both null. The right copies of both are dropped."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in [*key, *null_safe]})
    conditions = [F.col(c) == F.col(f"_r_{c}") for c in key] + [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in null_safe]
    return left.join(other, reduce(lambda a, b: a & b, conditions), how).drop(*(f"_r_{c}" for c in [*key, *null_safe]))


def dimension_roles(fact: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str], columns: list[str]) -> DataFrame:
    """Left-joins one dimension once per role: ``roles`` maps a fact column to a prefix for the dimension's columns.

    Whether the dimension is broadcast is left to Spark's measured sizes: a small one is, a large one isn't.
    """
    for column, prefix in roles.items():
        part = dimension.select(F.col(key).alias(f"_{prefix}"), *(F.col(c).alias(f"{prefix}_{c}") for c in columns))
        fact = fact.join(part, F.col(column) == F.col(f"_{prefix}"), "left").drop(f"_{prefix}")
    return fact


def valid_at(day: Column, start: Column, end: Column) -> Column:
    """Half-open validity: from ``start`` up to but not including ``end``, which may be open (null)."""
    return (start <= day) & (end.isNull() | (day < end))


def temporal_join(facts: DataFrame, states: DataFrame, on: str, day: str, start: str, end: str, how: str = "left") -> DataFrame:
    """Each fact with the states of the same ``on`` that are valid on its day: an equality and a range in one hash or sort-merge join."""
    s = states.withColumnRenamed(on, f"_s_{on}")
    return facts.join(s, (F.col(on) == F.col(f"_s_{on}")) & valid_at(F.col(day), F.col(start), F.col(end)), how).drop(f"_s_{on}")


def match_counts(facts: DataFrame, states: DataFrame, fact_id: list[str], on: str, day: str, start: str, end: str) -> DataFrame:
    """``*fact_id, matches``: how many valid states each fact has; exactly one is the contract."""
    joined = temporal_join(facts, states.withColumn("_hit", F.lit(1)), on, day, start, end)
    return joined.groupBy(*fact_id).agg(F.count("_hit").alias("matches"))


def asof_join(facts: DataFrame, states: DataFrame, key: list[str], fact_time: str, state_time: str, values: list[str], stretch_seconds: int = 86_400) -> DataFrame:
    """Each fact with ``values`` of the latest state of its key not after its time; nulls where there is none.

    Time is cut into stretches, so that a key with a third of all rows is many. Within a stretch facts and states are put into one ordered stream and the last state is carried
    forward; what a stretch begins with comes from the last states of those before it, one row a stretch. No range join.
    Of states at one time the greatest values count. Rows with a null key or time keep nulls and are neither shuffled nor sorted.
    """
    kinds = {f.name: f.dataType for f in facts.schema}
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in [*key, fact_time]))
    stretch = lambda t: F.floor(F.unix_seconds(F.col(t).cast("timestamp")) / stretch_seconds).cast("bigint")
    state = F.struct(*(F.col(v).alias(v) for v in values))
    right = states.where(F.col(state_time).isNotNull()).groupBy(*key, F.col(state_time).cast(kinds[fact_time]).alias("_t")).agg(F.max(state).alias("_state")).withColumn("_s", stretch("_t"))
    kind = right.schema["_state"].dataType
    left = facts.where(known).select(*key, F.col(fact_time).alias("_t"), stretch(fact_time).alias("_s"), F.struct(*(F.col(c) for c in facts.columns)).alias("_row"))
    # One row per key and stretch that has facts or states: the last state in it, and so the last one before it.
    per = left.select(*key, "_s").distinct().withColumns({"_t": F.lit(None).cast(kinds[fact_time]), "_state": F.lit(None).cast(kind)}).unionByName(right.select(*key, "_s", "_t", "_state"))
    per = per.groupBy(*key, "_s").agg(F.max_by("_state", "_t").alias("_own"))
    earlier = Window.partitionBy(*key).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.withColumn("_carried", F.last("_own", ignorenulls=True).over(earlier)).drop("_own")
    both = left.select(*key, "_s", "_t", F.lit(1).alias("_fact"), "_row", F.lit(None).cast(kind).alias("_state")).unionByName(right.select(*key, "_s", "_t", F.lit(0).alias("_fact"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), "_state"))
    order = Window.partitionBy(*key, "_s").orderBy("_t", "_fact").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_state", ignorenulls=True).over(order)).where("_fact = 1").join(carried, [*key, "_s"], "left")
    held = F.coalesce("_last", "_carried")
    rest = facts.where(~known).select("*", *(F.lit(None).cast(kind[v].dataType).alias(v) for v in values))
    return found.select("_row.*", *(held[v].alias(v) for v in values)).unionByName(rest)


def prefix_variants(names: DataFrame, group: str, name: str, ignorable: list[str]) -> DataFrame:
    """``group, base, variant``: names that are another one of the same group plus words of ``ignorable`` only.

    The first word joins the pairs, so that only names that can match meet.
    """
    words = names.select(group, F.split(name, " ").alias("w"), F.col(name).alias("n")).distinct()
    base, other = words.select(group, F.get("w", F.lit(0)).alias("first"), F.col("n").alias("base"), F.col("w").alias("bw")), words.select(group, F.get("w", F.lit(0)).alias("first"), F.col("n").alias("variant"), F.col("w").alias("vw"))
    rest = F.slice("vw", F.size("bw") + 1, F.size("vw"))
    longer = (F.size("vw") > F.size("bw")) & F.col("variant").startswith(F.concat("base", F.lit(" ")))
    return base.join(other, [group, "first"]).where(longer & (F.size(F.array_except(rest, F.array(*map(F.lit, ignorable)))) == 0)).select(group, "base", "variant")


def two_tier_match(names: DataFrame, specs: DataFrame, group: str, name: str, ignorable: list[str]) -> DataFrame:
    """Every row of ``names`` with the rows of ``specs`` (columns prefixed ``spec_``) of the same group and exactly that name, or, only where there is none, of
    names that are it plus ``ignorable`` words. ``tier`` is ``exact``, ``variant`` or null; a name without either stays, with nulls.
    """
    wanted = names.select(group, name).distinct()
    have = specs.select(group, name).distinct()
    exact = wanted.join(have, [group, name], "left_semi").select(group, name, F.col(name).alias("_spec"), F.lit("exact").alias("tier"))
    left = wanted.join(have, [group, name], "left_anti")
    both = left.withColumn("_base", F.lit(True)).unionByName(have.withColumn("_base", F.lit(False)))
    pairs = prefix_variants(both.select(group, name), group, name, ignorable)
    variant = left.join(pairs.select(group, F.col("base").alias(name), F.col("variant").alias("_spec")), [group, name]).join(have.select(group, F.col(name).alias("_spec")), [group, "_spec"], "left_semi")
    found = exact.unionByName(variant.select(group, name, "_spec", F.lit("variant").alias("tier")))
    renamed = specs.select(F.col(group).alias("_g"), F.col(name).alias("_spec"), *(F.col(c).alias(f"spec_{c}") for c in specs.columns if c != group))
    return names.join(found, [group, name], "left").join(renamed.withColumnRenamed("_g", group), [group, "_spec"], "left").drop("_spec")


def numbered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``number``, 0, 1, ... in the order of the unique ``key``, over all rows.

    No task orders all of them: ranges are ordered for themselves, and each begins where the ranges before it end. The ranges are written first, as they could differ when computed again.
    """
    rows = written(df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "numbered")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", before).drop("_n")  # one row a range
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return rows.withColumn("_place", place).join(F.broadcast(parts), "_part").withColumn("number", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def dealt(df: DataFrame, key: str, size: int) -> tuple[DataFrame, int]:
    """``df`` with a ``bucket``, and the number of buckets: rows are dealt in turn, in the order of the unique ``key``, to as many buckets as there are ``size`` rows.

    So each bucket has at least ``size`` rows (all rows, where there are fewer) and fewer than twice as many.
    """
    rows = numbered(df, key)
    buckets = max(1, rows.count() // size)
    return rows.withColumn("bucket", F.pmod(F.col("number"), F.lit(buckets).cast("bigint"))).drop("number"), buckets


def bucketed_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, size: int, seed: int = 0) -> DataFrame:
    """Many-to-many candidates: the right side is dealt to buckets of ``size`` rows or a few more, the left side gets a bucket by hash, and rows of one bucket meet.

    Pairs grow with the left side only. Every left row stays: if there are no right rows at all, with nulls.
    """
    right, buckets = dealt(right, right_key, size)
    return left.withColumn("bucket", bucket_of(F.col(left_key), buckets, seed)).join(right, "bucket", "left")
