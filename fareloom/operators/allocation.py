"""Giving limited units to agents with preferences.

Requests are put in order once, by item and priority, as ranges over the whole cluster (``queued``). The number of a
range then is a coarse priority: to find the best k of any subset of an item's requests it is enough to count them per
range, and to order those of the one range in which the k-th lies. No task ever orders all requests of an item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import drop_written, written


def preference_ranks(candidates: DataFrame, agent: list[str], order: list[Column]) -> DataFrame:
    """Adds ``rank`` per agent by ``order``, which should end in something unique."""
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy(*agent).orderBy(*order)))


def _known(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in names))


def queued(requests: DataFrame, place: list[str], priority: list[Column]) -> DataFrame:
    """The requests with ``_range``: a number that never falls from a better to a worse priority for the same ``place``. Written, so that it stays what it is."""
    return written(requests.repartitionByRange(*place, *priority).withColumn("_range", F.spark_partition_id()), "queued")


def best_of(now: DataFrame, place: list[str], priority: list[Column], units: str) -> DataFrame:
    """Of the queued rows of each ``place`` the first ``units`` (a column, equal within a place) by ``priority``."""
    before = Window.partitionBy(*place).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = now.groupBy(*place, "_range").agg(F.count("*").alias("_n")).withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sized = now.join(spans, [*place, "_range"]).where(F.col("_ahead") < F.col(units))
    whole = sized.where(F.col("_ahead") + F.col("_n") <= F.col(units))
    # Only the range that holds the last unit is put in order.
    order = Window.partitionBy(*place, "_range").orderBy(*priority)
    cut = sized.where(F.col("_ahead") + F.col("_n") > F.col(units)).withColumn("_at", F.row_number().over(order)).where(F.col("_ahead") + F.col("_at") <= F.col(units))
    return whole.unionByName(cut.drop("_at")).drop("_n", "_ahead")


def _with_units(requests: DataFrame, stock: DataFrame, place: list[str]) -> DataFrame:
    on = [c for c in place if c in stock.columns]
    return requests.join(stock.where(F.col("free") > 0).groupBy(*on).agg(F.sum("free").cast("bigint").alias("_left")), on)


def _told(queue: DataFrame, agent: list[str], place: list[str]) -> DataFrame:
    """Adds to open requests what the next step needs: ``_safe`` (the item has a unit for every open request), ``_turn`` (the agent's next rank) and ``_round`` (the rank that can be decided
    at an item now, null where none can).

    The lowest rank at which an item is asked for can be decided as soon as all who ask for it then are at their turn; agents whose next choice is safe ask for nothing more.
    The lowest contested rank of all always can.
    """
    wanted = queue.groupBy(*place).agg(F.count("*").alias("_wanted"))
    # An agent's own list is short: the window holds one list at a time.
    turn = F.min(F.struct("rank", "_safe")).over(Window.partitionBy(*agent))
    told = queue.join(wanted, place).withColumn("_safe", F.col("_wanted") <= F.col("_left")).drop("_wanted").withColumn("_next", turn)
    told = told.withColumns({"_turn": F.col("_next.rank"), "_sure": F.col("_next._safe")}).drop("_next")
    lowest = told.where("not _safe and not _sure").groupBy(*place).agg(F.min(F.struct("rank", (F.col("rank") == F.col("_turn")).alias("ready"))).alias("_low"))
    rounds = lowest.select(*place, F.when(F.col("_low.ready"), F.col("_low.rank")).alias("_round"))
    return told.join(rounds, place, "left").drop("_sure")


def immediate_acceptance(ranked: DataFrame, agent: list[str], item: str, own: str, priority: list[Column], stock: DataFrame, group: list[str] | None = None) -> DataFrame:
    """One row per agent that gets something: immediate acceptance in rounds of preference.

    ``ranked`` has a row per agent and item with ``rank`` (1 is best) and the boolean ``own``. In round r every agent still without an item asks for
    its choice of rank r. An agent's own item is always granted; others go by ``priority`` while units are left, and what is granted is never taken back.
    ``stock``: item and ``free``, the units that may be given in each ``group``, or in one group if it names the group's columns too; items it lacks have none. ``agent`` includes the ``group`` columns.
    Rows with a null agent, item or rank ask for nothing; ``priority`` should end in something unique.

    An own item takes no unit and ends an agent's list, so it concerns nobody else: it is what an agent falls back on when all rounds are over. A choice
    whose item has no unit left can never be granted and leaves the open requests at once. And an item with as many units left as there are open requests
    for it, of whatever rank, refuses nobody: whoever asks for it first gets it, without waiting for the round. A contested item decides a rank when all who ask at it are at
    their turn, whatever rank other items are at. So steps are as many as decisions hang on one another, and each rewrites only requests that are still possible.
    """
    group = group or []
    place = [*group, item]
    asked = ranked.where(_known([*agent, item, "rank"]))
    mine = asked.where(F.col(own)).groupBy(*agent).agg(F.min("rank").alias("_own"))
    above = asked.where(~F.coalesce(F.col(own), F.lit(False))).join(mine, agent, "left").where(F.col("_own").isNull() | (F.col("rank") < F.col("_own"))).drop("_own")
    ordered = queued(_with_units(above, stock, place), place, priority)
    queue = written(_told(ordered, agent, place), "queue")
    drop_written(ordered)
    won: list[DataFrame] = []
    while True:
        asking = queue.where("rank = _turn")
        ruled = best_of(asking.where("not _safe and rank = _round"), place, priority, "_left")
        given = written(asking.where("_safe").unionByName(ruled).drop("_safe", "_turn", "_round"), "given")
        won.append(given)
        taken = given.groupBy(*place).agg(F.count("*").alias("_taken"))
        rest = queue.where("_safe or _round is null or rank > _round").drop("_safe", "_turn", "_round").join(given.select(*agent), agent, "left_anti").join(taken, place, "left")
        rest = rest.withColumn("_left", F.col("_left") - F.coalesce("_taken", F.lit(0))).where("_left > 0").drop("_taken")
        done, queue = queue, written(_told(rest, agent, place), "queue")
        drop_written(done)
        if queue.isEmpty():
            break
    granted = reduce(DataFrame.unionByName, won)
    kept = asked.where(F.col(own)).join(mine, agent).where(F.col("rank") == F.col("_own")).drop("_own").join(granted.select(*agent), agent, "left_anti")
    return granted.select(*ranked.columns).unionByName(kept.select(*ranked.columns))


def single_pass(ranked: DataFrame, agent: list[str], item: str, own: str, priority: list[Column], stock: DataFrame, group: list[str] | None = None) -> DataFrame:
    """One row per agent: its best choice among its own item and those items for which it is among the first ``free`` by priority.

    All requests for an item are ranked at once, without rounds; units of agents that choose something better stay unused. Nulls as in :func:`immediate_acceptance`.
    """
    place = [*(group or []), item]
    asked = ranked.where(_known([*agent, item, "rank"]))
    others = queued(_with_units(asked.where(~F.coalesce(F.col(own), F.lit(False))), stock, place), place, priority)
    feasible = best_of(others, place, priority, "_left").select(*ranked.columns).unionByName(asked.where(F.col(own)).select(*ranked.columns))
    # An agent's choices are as many as its list is long.
    return feasible.withColumn("_best", F.row_number().over(Window.partitionBy(*agent).orderBy("rank"))).where("_best = 1").drop("_best")
