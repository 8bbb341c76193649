"""Sessions by pointer doubling.

Each event is linked to a predecessor within the gap. Time is cut into blocks as
long as the gap, so all events of an entity in one block are within the gap of
one another and can be linked to the first of them at once: that link is an
aggregation, which combines before the shuffle and makes a hot entity small (at
most one row per block). The first event of a block is linked to the last one of
the block before if that is within the gap; an older block cannot be. Pointers
of these chains are then doubled by self-joins until all reach a root: a chain
of n blocks takes log2(n) rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import written


def link_blocks(df: DataFrame, key: str, at: str, gap: int) -> DataFrame:
    """``k, b, first, last, n, linked``: the events of an entity in each block of ``gap`` seconds, and whether the block before is within the gap.

    Every event also tells the block after its own how late it is, so that one aggregation gives both.
    """
    events = df.select(F.col(key).alias("k"), F.col(at).cast("bigint").alias("t")).where("k is not null and t is not null")
    block = F.floor(F.col("t") / F.lit(gap)).cast("bigint")
    told = F.array(
        F.struct(block.alias("b"), F.col("t").alias("own"), F.lit(None).cast("bigint").alias("prior")),
        F.struct((block + 1).alias("b"), F.lit(None).cast("bigint").alias("own"), F.col("t").alias("prior")),
    )
    blocks = events.select("k", F.inline(told)).groupBy("k", "b").agg(F.min("own").alias("first"), F.max("own").alias("last"), F.count("own").alias("n"), F.max("prior").alias("prior"))
    return blocks.where("n > 0").withColumn("linked", F.coalesce(F.col("first") - F.col("prior") <= gap, F.lit(False))).drop("prior")


def sessions(df: DataFrame, key: str, at: str, gap: int) -> DataFrame:
    """``key, start, end, duration, events`` of each session, times in whole seconds.

    An event belongs to the session of the preceding one of its entity when it is at most ``gap`` seconds later.
    Events with a null key or time are left out; repeated events count in ``events`` and change no borders; events
    at one time are one point. A single event is a session of duration 0. Other columns are not read.
    """
    if gap < 1:
        raise ValueError("gap must be a positive number of seconds")
    blocks = written(link_blocks(df, key, at, gap), "blocks")
    members = blocks.where("linked")
    # Pointers of the blocks that aren't roots; a block absent here is a root. Each round writes the pointers it moved, those that have reached a root stay where they are.
    open_ = members.select("k", "b", (F.col("b") - 1).alias("p"), F.lit(False).alias("done"))
    settled: list[DataFrame] = []
    while settled == [] or not open_.isEmpty():
        onward = reduce(DataFrame.unionByName, [*settled, open_]).select("k", F.col("b").alias("p"), F.col("p").alias("p2"), F.col("done").alias("done2"))
        doubled = open_.join(onward, ["k", "p"], "left").select("k", "b", F.coalesce("p2", "p").alias("p"), (F.col("p2").isNull() | F.col("done2")).alias("done"))
        moved = written(doubled, "pointers")
        settled.append(moved.where("done"))
        open_ = moved.where("not done")
    pointers = reduce(DataFrame.unionByName, settled)
    columns = ["k", "root", "first", "last", "n"]
    rooted = members.join(pointers.select("k", "b", F.col("p").alias("root")), ["k", "b"]).select(*columns).unionByName(blocks.where("not linked").withColumn("root", F.col("b")).select(*columns))
    return (
        rooted.groupBy("k", "root")
        .agg(F.min("first").alias("start"), F.max("last").alias("end"), F.sum("n").alias("events"))
        .select(F.col("k").alias(key), "start", "end", (F.col("end") - F.col("start")).alias("duration"), "events")
    )
