"""Which agents may take a job, and how well they suit it.

Agents are dealt to buckets of a few, jobs get a bucket by hash, and a job meets the agents of its bucket as one array: pairs are never rows.
Rules and scores are column expressions over the job's columns and the fields of an agent.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.columns import bucket_of, seed_of
from fareloom.operators.joins import dealt

Rule = Callable[[Column], Column]


def job_candidates(jobs: DataFrame, agents: DataFrame, job: str, agent: str, size: int, rules: dict[str, Rule], score: Rule, seed: int = 0) -> DataFrame:
    """``jobs`` with ``bucket``, ``offered`` (agents of the bucket), ``<rule>`` (how many of them it refuses) and ``candidates``.

    An agent is refused by the first rule, in their order, that isn't true for it (null isn't). ``candidates`` are the others, as structs of all columns of ``agents`` with
    ``score`` and ``tie`` (a number from the job's and agent's ids), best first: by score, then tie, then agent. Jobs with a null id, and agents with one, are left out; a job
    without agents has an empty array. ``agents`` has one row per agent; buckets hold from ``size`` to less than twice as many.
    """
    fields = [c for c in agents.columns if c != agent]
    numbered, buckets = dealt(agents.where(F.col(agent).isNotNull()), agent, size)
    # Bounded by twice the size.
    sets = numbered.groupBy("bucket").agg(F.collect_list(F.struct(F.col(agent).alias("agent"), *fields)).alias("_agents"))
    known = jobs.where(F.col(job).isNotNull()).withColumn("bucket", bucket_of(F.col(job), buckets, seed))
    met = known.join(sets, "bucket", "left").withColumn("_agents", F.coalesce("_agents", F.array().cast(sets.schema["_agents"].dataType)))

    def judged(a: Column) -> Column:
        return F.struct(reduce(lambda inner, r: F.when(~F.coalesce(r[1](a), F.lit(False)), F.lit(r[0])).otherwise(inner), reversed(rules.items()), F.lit(None).cast("string")).alias("why"), a.alias("as"))

    def scored(a: Column) -> Column:
        return F.struct(a["agent"].alias("agent"), score(a).alias("score"), seed_of(F.col(job), a["agent"], base=seed).alias("tie"), *(a[f].alias(f) for f in fields))

    each = met.withColumn("_each", F.transform("_agents", judged)).withColumn("offered", F.size("_agents"))
    better = lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["tie"] < b["tie"], -1).when(a["tie"] > b["tie"], 1).when(a["agent"] < b["agent"], -1).otherwise(1)
    taken = F.array_sort(F.transform(F.filter("_each", lambda x: x["why"].isNull()), lambda x: scored(x["as"])), better)
    counted = lambda name: F.size(F.filter("_each", lambda x: x["why"] == name))
    counts = {name: counted(name) for name in rules}
    return each.withColumns({**counts, "candidates": taken}).drop("_each", "_agents")
