"""Folding an event log into the present state of each entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_events(df: DataFrame, key: str, at: str, kind: str, value: str, opens: str, closes: str, changes: str, start: str | None = None) -> DataFrame:
    """``key, opened_at, closed_at, value, since``: the state after all events of a key.

    An ``opens`` event forgets everything before it and sets the value; ``changes`` sets the value of an entity that exists; ``closes`` notes the
    time and is not undone by a later change. At one time closing comes before opening and opening before changing. Entities never opened have no row;
    other kinds and rows without key or time are left out. Two aggregations, no per-entity loop: ``start`` only names an optional lowest time.
    """
    order = F.when(F.col(kind) == closes, 0).when(F.col(kind) == opens, 1).otherwise(2)
    rows = df.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(kind).isin(opens, closes, changes))
    if start:
        rows = rows.where(F.col(at) >= F.lit(start).cast("timestamp"))
    placed = rows.select(F.col(key).alias("_k"), F.col(kind).alias("_kind"), F.struct(F.col(at).alias("at"), order.alias("o"), F.col(value).alias("v")).alias("e"))
    opened = placed.where(F.col("_kind") == opens).groupBy("_k").agg(F.max("e").alias("opened"))
    since = placed.join(opened, "_k").where(F.struct("e.at", "e.o") >= F.struct("opened.at", "opened.o"))
    setting = F.when(F.col("_kind") != closes, F.col("e"))
    return since.groupBy("_k").agg(F.max("opened.at").alias("opened_at"), F.max(F.when(F.col("_kind") == closes, F.col("e.at"))).alias("closed_at"), F.max(setting).alias("s")).select(
        F.col("_k").alias(key), "opened_at", "closed_at", F.col("s.v").alias(value), F.col("s.at").alias("since")
    )


def state_to_events(df: DataFrame, key: str, value: str, opened: str, closed: str, changed: str) -> DataFrame:
    """``key, at, kind, value``: the log that folds into the given states: an opening, a later change of value, a closing."""
    at = lambda c: F.col(c).cast("timestamp")
    each = F.array(
        F.struct(at(opened).alias("at"), F.lit("open").alias("kind"), F.col(value).alias("value")),
        F.when(F.col(changed) > F.col(opened), F.struct(at(changed).alias("at"), F.lit("change").alias("kind"), F.col(value).alias("value"))),
        F.when(F.col(closed).isNotNull(), F.struct(at(closed).alias("at"), F.lit("close").alias("kind"), F.lit(None).cast("string").alias("value"))),
    )
    return df.select(key, F.inline(F.array_compact(each)))
