"""Random draws that depend on an entity's id alone, wherever and however often they are made.

Single uniform draws are column expressions that any engine with SHA-256 repeats (:func:`uniform`); draws from other distributions are made in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.columns import seed_of
from fareloom.operators.joins import numbered


def uniform(*parts: Column, base: int = 0) -> Column:
    """A number from 0 up to 1, in millionths, that depends on the parts alone."""
    return (seed_of(*parts, base=base) % 1_000_000) / 1_000_000


def rounded_at_random(c: Column, draw: Column) -> Column:
    """A whole number whose mean is ``c``: the next greater one where the draw is below the fraction."""
    return (F.floor(c) + F.when(draw < c - F.floor(c), 1).otherwise(0)).cast("bigint")


def evolved(df: DataFrame, key: str, period: Column, leave: float, change: float) -> DataFrame:
    """Adds ``fate`` for the next period to entities that are there: ``leaves``, ``changes`` or ``stays``, by one draw each from id and period."""
    u = uniform(F.col(key), period)
    return df.withColumn("fate", F.when(u < leave, "leaves").when(u < leave + change, "changes").otherwise("stays"))


def drawn_units(wanting: DataFrame, key: str, units: DataFrame, unit: str, period: str) -> DataFrame:
    """Each entity with a unit nobody else gets: both are shuffled by draws from id and period and paired by number. Whoever comes after the last unit gets none (null).

    Numbering orders ranges for themselves (:func:`fareloom.operators.joins.numbered`), so neither side is ordered in one task.
    """
    place = lambda df, c: numbered(df.where(F.col(c).isNotNull()).withColumn("_u", F.struct(seed_of(F.col(c), F.lit(period)).alias("u"), F.col(c).alias("id"))), "_u").drop("_u")
    return place(wanting, key).join(place(units.select(unit), unit), "number", "left").drop("number")


def seeded_traits(df: DataFrame, key: str, shares: int = 8, base: int = 0) -> DataFrame:
    """``key, activity, prefers, weights, days, noise, kind, parts``: a gamma, a beta, a Dirichlet draw (``shares`` weights that add up to 1), a binomial of 30 days, a normal, a
    choice of ``shares`` by these weights and a multinomial of 100 over them, per entity.

    Entities are drawn for in batches as they come, without a shuffle; a repeated key gets the same draws, a null key none.
    """

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for seed in batch["seed"]:
                g = np.random.default_rng(int(seed))
                activity, prefers, weights = g.gamma(2.0, 0.5), g.beta(2.0, 2.0), g.dirichlet(np.ones(shares))
                made.append((activity, prefers, weights.tolist(), int(g.binomial(30, prefers)), g.normal(0.0, 0.1), int(g.choice(shares, p=weights)), g.multinomial(100, weights).tolist()))
            yield pd.DataFrame(made, columns=["activity", "prefers", "weights", "days", "noise", "kind", "parts"]).assign(key=batch["key"].to_numpy())[["key", "activity", "prefers", "weights", "days", "noise", "kind", "parts"]]

    rows = df.select(F.col(key).cast("string").alias("key")).where("key is not null").withColumn("seed", seed_of(F.col("key"), base=base))
    return rows.mapInPandas(draw, "key string, activity double, prefers double, weights array<double>, days int, noise double, kind int, parts array<int>").withColumnRenamed("key", key)
