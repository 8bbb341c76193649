from pyspark.sql import functions as F

from fareloom.operators.candidates import job_candidates

AGENTS = "agent string, level int, pref double"


def candidates(spark, jobs, agents, size=100):
    rules = {"level": lambda a: a["level"] >= F.col("need"), "even": lambda a: a["level"] % 2 == 0}
    return job_candidates(spark.createDataFrame(jobs, "job string, need int, agent int"), spark.createDataFrame(agents, AGENTS), "job", "agent", size, rules, lambda a: a["pref"] * F.col("need"))


def test_rules_in_order_and_best_first(spark):
    agents = [("a", 1, 0.1), ("b", 4, 0.5), ("c", 5, 0.9), ("d", 6, 0.9), ("e", 8, 0.9), ("f", None, 1.0), (None, 8, 1.0)]
    (r,) = candidates(spark, [("j", 3, 7)], agents).collect()
    assert (r.offered, r.level, r.even, r.agent) == (6, 2, 1, 7)
    assert [c.agent for c in r.candidates][2] == "b" and {c.agent for c in r.candidates[:2]} == {"d", "e"}
    tie = {c.agent: c.tie for c in r.candidates}
    assert (tie["d"] < tie["e"]) == (r.candidates[0].agent == "d") and r.candidates[0].score == 2.7 and r.candidates[2].level == 4


def test_jobs_without_agents_nulls_and_even_buckets(spark):
    agents = [(f"a{i:03}", 2, 0.5) for i in range(43)]
    rows = candidates(spark, [(f"j{i}", 1, 1) for i in range(200)] + [(None, 1, 1)], agents, 4).collect()
    assert len(rows) == 200 and {r.offered for r in rows} == {4, 5} and len({r.bucket for r in rows}) == 10
    (r,) = candidates(spark, [("j", 1, 1)], [], 4).collect()
    assert r.offered == 0 and r.candidates == []
    assert candidates(spark, [], agents).count() == 0
