import random

import pytest
from pyspark.sql import functions as F

from fareloom.operators.allocation import immediate_acceptance, preference_ranks, single_pass


def brute(rows, stock):
    """Rounds in plain Python: rows of (agent, item, own, wish, priority)."""
    wishes = {}
    for r in sorted(rows, key=lambda r: (r[0], -r[3], r[1])):
        wishes.setdefault(r[0], []).append(r)
    given, used = {}, {}
    for step in range(max(map(len, wishes.values()), default=0)):
        asking = {}
        for agent, list_ in wishes.items():
            if agent not in given and step < len(list_):
                r = list_[step]
                if r[2]:
                    given[agent] = (r[1], step + 1)
                else:
                    asking.setdefault(r[1], []).append(r)
        for item, some in asking.items():
            some.sort(key=lambda r: (-r[4], r[0]))
            left = stock.get(item, 0) - used.get(item, 0)
            for r in some[: max(0, left)]:
                given[r[0]] = (item, step + 1)
                used[item] = used.get(item, 0) + 1
    return given


@pytest.mark.parametrize("seed", range(3))
def test_rounds(spark, seed):
    rnd = random.Random(seed)
    items = [f"m{i}" for i in range(5)]
    rows = []
    for a in range(40):
        own = rnd.choice([*items, None])
        for m in rnd.sample(items, rnd.randint(1, 5)):
            rows.append((f"a{a:02}", m, m == own, rnd.randint(0, 3), rnd.randint(0, 4)))
    stock = {m: rnd.randint(0, 4) for m in items[:-1]}
    df = spark.createDataFrame(rows, "agent string, item string, own boolean, wish int, pri int")
    ranked = preference_ranks(df, ["agent"], [F.desc("wish"), F.asc("item")])
    free = spark.createDataFrame(list(stock.items()), "item string, free int")
    got = {r.agent: (r.item, r["rank"]) for r in immediate_acceptance(ranked, ["agent"], "item", "own", [F.desc("pri"), F.asc("agent")], free).collect()}
    assert got == brute(rows, stock)
    # Two groups at once are two independent runs.
    both = ranked.crossJoin(spark.createDataFrame([(1,), (2,)], "g int"))
    out = immediate_acceptance(both, ["agent", "g"], "item", "own", [F.desc("pri"), F.asc("agent")], free, ["g"]).collect()
    assert {(r.agent, r.g): (r.item, r["rank"]) for r in out} == {(a, g): v for a, v in got.items() for g in (1, 2)}


def test_empty_and_single_pass(spark):
    df = spark.createDataFrame([("a", "x", False, 1), ("a", "y", True, 2), ("b", "x", False, 1)], "agent string, item string, own boolean, rank int")
    free = spark.createDataFrame([("x", 1)], "item string, free int")
    assert immediate_acceptance(df.limit(0), ["agent"], "item", "own", [F.asc("agent")], free).count() == 0
    got = sorted((r.agent, r.item) for r in single_pass(df, ["agent"], "item", "own", [F.asc("agent")], free).collect())
    assert got == [("a", "x")]


def test_a_million_requests_with_a_hot_item(spark):
    """Immediate acceptance is told by this alone: whoever is refused comes, by round and priority, after the last one who got a unit of the item, and nothing is left of it."""
    agents = spark.range(200_000).withColumn("pri", F.pmod(F.xxhash64("id"), F.lit(1000)))
    wishes = agents.select("id", "pri", F.posexplode(F.expr("transform(sequence(0, 4), r -> if(r = id % 3, 0, 1 + pmod(xxhash64(id, r), 60)))")).alias("r", "item"))
    ranked = wishes.groupBy("id", "item").agg(F.min("r").alias("r"), F.first("pri").alias("pri"))
    ranked = preference_ranks(ranked, ["id"], [F.asc("r")]).select("id", F.col("item").cast("string").alias("item"), F.lit(False).alias("own"), "rank", "pri")
    stock = spark.range(61).selectExpr("cast(id as string) as item", "if(id = 0, 40000, 100 * id) as free")
    order = [F.desc("pri"), F.asc("id")]
    given = immediate_acceptance(ranked, ["id"], "item", "own", order, stock)
    assert ranked.count() > 900_000
    counts = {r.item: r["count"] for r in given.groupBy("item").count().collect()}
    free = {r.item: r.free for r in stock.collect()}
    assert all(n <= free[i] for i, n in counts.items()) and given.select("id").distinct().count() == sum(counts.values())
    last = given.groupBy("item").agg(F.max(F.struct("rank", (-F.col("pri")).alias("p"), "id")).alias("last"))
    got = given.select("id", F.col("rank").alias("given"))
    refused = ranked.join(got, "id", "left").where("given is null or rank < given").join(last, "item", "left")
    assert refused.where(F.struct("rank", (-F.col("pri")).alias("p"), "id") <= F.col("last")).count() == 0
    assert all(counts[r.item] == free[r.item] for r in refused.select("item").distinct().collect())
