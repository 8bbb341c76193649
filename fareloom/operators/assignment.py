"""Greedy assignment of timed jobs to agents that move between places.

The decision for a job depends on all earlier ones of its group, so a group (a bucket and a day)
is walked through in order; groups are independent and bounded by how buckets are chosen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Minutes, where an agent has none of its own: one way between jobs, from the first start to the last end, and driving with ways."""

    way: float = 30.0
    span: float = 720.0
    work: float = 600.0


#: Why an agent can't take a job, in the order in which it is looked at.
REASONS = ["unknown_way", "far", "late", "span", "work", "vehicle"]
OUT = "job string, agent string, sequence int, way_minutes double, offers int, " + ", ".join(f"{r} int" for r in REASONS)
CANDIDATE = "struct<agent:string,vehicle:string,way:double,span:double,work:double>"


class Group:
    """The agents and vehicles of one group so far."""

    __slots__ = ("agents", "busy", "limits", "ways")

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.ways: dict[tuple[int, int], float] = {}
        self.agents: dict[str, tuple[int, int, int, float, int]] = {}  # first start, last end, last place, minutes, jobs
        self.busy: dict[str, int] = {}  # until when a vehicle is out

    def _refusal(self, c: dict, start: int, end: int, origin: int) -> tuple[str | None, float]:
        have, limits = self.agents.get(c["agent"]), self.limits
        own = lambda name: getattr(limits, name) if c[name] is None else c[name]
        way, used = 0.0, 0.0
        if have is not None:
            first, last, place, used, _ = have
            if place != origin:
                way = self.ways.get((place, origin))
                if way is None:
                    return "unknown_way", 0.0
                if way > own("way"):
                    return "far", way
            if last + way * 60 > start:
                return "late", way
            if (end - first) / 60 > own("span"):
                return "span", way
        if used + (end - start) / 60 + way > own("work"):
            return "work", way
        if c["vehicle"] is not None and self.busy.get(c["vehicle"], start) > start:
            return "vehicle", way
        return None, way

    def decide(self, job: str, start: int, end: int, origin: int, target: int, candidates: list[dict]) -> tuple:
        """The result of one job: its first feasible candidate takes it."""
        refused: Counter[str] = Counter()
        for n, c in enumerate(candidates, 1):
            why, way = self._refusal(c, start, end, origin)
            if why is None:
                first, _, _, used, jobs = self.agents.get(c["agent"], (start, 0, 0, 0.0, 0))
                self.agents[c["agent"]] = (first, end, target, used + (end - start) / 60 + way, jobs + 1)
                if c["vehicle"] is not None:
                    self.busy[c["vehicle"]] = max(end, self.busy.get(c["vehicle"], end))
                return (job, c["agent"], jobs + 1, way, n, *(refused[r] for r in REASONS))
            refused[why] += 1
        return (job, None, None, None, len(candidates), *(refused[r] for r in REASONS))


_TYPES = [pa.string(), pa.string(), pa.int32(), pa.float64(), *[pa.int32()] * (1 + len(REASONS))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=["job", "agent", "sequence", "way_minutes", "offers", *REASONS])


def _assign(limits: Limits, keys: int):
    """Rows sorted by group, the group's ways first, then its jobs in order; one group is in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, done = None, Group(limits), []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, start, job, end, origin, target, candidates, ways in zip(zip(*columns[:keys], strict=True), *columns[keys:], strict=True):
                if key != now:
                    now, group = key, Group(limits)
                if ways is not None:
                    group.ways.update(((target, w["to"]), w["minutes"]) for w in ways)
                else:
                    done.append(group.decide(job, start, end, origin, target, candidates or []))
            if len(done) > 10_000:
                yield _batch(done)
                done = []
        if done:
            yield _batch(done)

    return run


def _ways(jobs: DataFrame, travel: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group and place where a job of it ends the known ways to places where jobs of it begin: no more than the group has pairs of places, whatever its jobs."""
    places = jobs.groupBy(*keys).agg(F.collect_set("origin").alias("_origins"), F.collect_set("target").alias("_targets"))
    by_place = travel.where("origin is not null and target is not null and minutes is not null").groupBy(F.col("origin").cast("int").alias("target")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("target").cast("int"), F.col("minutes").cast("double")))).alias("_known")
    )
    ends = places.select(*keys, "_origins", F.explode("_targets").alias("target")).join(by_place, "target")
    found = F.filter(F.transform("_origins", lambda o: F.struct(o.alias("to"), F.try_element_at("_known", o).alias("minutes"))), lambda w: w["minutes"].isNotNull())
    return ends.select(*keys, "target", found.alias("ways")).where(F.size("ways") > 0)


def greedy_assignment(jobs: DataFrame, travel: DataFrame, group: list[str], limits: Limits = Limits()) -> DataFrame:
    """A row for every job: ``job, agent, sequence, way_minutes, offers`` and, for each reason, the candidates refused for it before one took the job (or none did).

    In each group jobs are taken by start (then job), and offered to their candidates in the order of the array; the first feasible one takes it. An agent that had a job before must know the way
    from its last place (none within a place), be near enough, arrive in time and stay within its span; all must stay within their minutes of work, and find their vehicle back.
    ``jobs``: the ``group`` columns, ``job, start, end`` (seconds), ``origin, target`` (places), ``candidates``: an array of structs with ``agent`` and, if they have them,
    ``vehicle`` and limits of their own in minutes, ``way``, ``span`` and ``work``. ``travel``: ``origin, target, minutes``, one row per pair of places that is known.
    Rows with a null job or time are left out; a job without candidates has 0 offers. Counts come from the rows, so a task that runs twice doesn't count twice.
    Groups are sorted by Spark and walked through in one pass, so many small groups cost no more than a few large ones; a group gets the ways between its own places along with its jobs.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    has = jobs.schema["candidates"].dataType.elementType.fieldNames()
    kinds = {"vehicle": "string", "way": "double", "span": "double", "work": "double"}
    slim = F.transform("candidates", lambda c: F.struct(c["agent"].cast("string").alias("agent"), *((c[k] if k in has else F.lit(None)).cast(t).alias(k) for k, t in kinds.items())))
    rows = jobs.where("job is not null and start is not null and end is not null").select(
        *(F.col(g).alias(k) for g, k in zip(group, keys, strict=True)), F.col("start").cast("bigint"), F.col("job").cast("string"), F.col("end").cast("bigint"), F.col("origin").cast("int"), F.col("target").cast("int"), slim.alias("candidates"),
    )
    none = F.lit(None)
    ways = _ways(rows, travel, keys).select(
        *keys, none.cast("bigint").alias("start"), none.cast("string").alias("job"), none.cast("bigint").alias("end"), none.cast("int").alias("origin"), "target", none.cast(f"array<{CANDIDATE}>").alias("candidates"), "ways"
    )
    every = rows.withColumn("ways", none.cast("array<struct<to:int,minutes:double>>")).unionByName(ways)
    # Ways have no start, and nulls come first.
    return every.repartition(*keys).sortWithinPartitions(*keys, "start", "job").mapInArrow(_assign(limits, len(keys)), OUT)


def assignment_contract(jobs: DataFrame, travel: DataFrame, group: list[str]) -> DataFrame:
    """``check, broken``: how many rows break each condition on the input of :func:`greedy_assignment`; all are 0 in a sound one."""
    absent = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in [*group, "job", "start", "end", "origin", "target"]))
    repeated = F.size("candidates") != F.size(F.array_distinct(F.transform("candidates", lambda c: c["agent"])))
    checks = {"missing": absent, "not_after_start": F.col("end") <= F.col("start"), "repeated_candidate": repeated, "nameless_candidate": F.exists("candidates", lambda c: c["agent"].isNull())}
    rows = jobs.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()), F.count("*").alias("_n"))
    keyed = jobs.groupBy("job").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated_job"))
    roads = travel.groupBy("origin", "target").agg(F.count("*").alias("n"), F.min("minutes").alias("least")).agg(F.count_if(F.col("n") > 1).alias("repeated_way"), F.count_if((F.col("least") < 0) | F.isnan("least")).alias("negative_way"))
    names = [*checks, "repeated_job", "repeated_way", "negative_way"]
    one = rows.crossJoin(keyed).crossJoin(roads)  # three single rows
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("broken")) for n in names))))


def require(contract: DataFrame) -> None:
    """Fails with all broken conditions in one error."""
    broken = {r.check: r.broken for r in contract.where("broken > 0").collect()}
    if broken:
        raise ValueError(f"input breaks its contract: {broken}")
