import random

import pytest

from fareloom.operators.assignment import REASONS, Group, Limits, assignment_contract, greedy_assignment, require

H = 3600
TRAVEL = {(2, 3): 10.0, (5, 6): 45.0}
JOBS = "job string, start bigint, end bigint, origin int, target int, candidates array<struct<agent:string,vehicle:string,way:double,span:double,work:double>>, g int"


def cand(agent, vehicle=None, way=None, span=None, work=None):
    return {"agent": agent, "vehicle": vehicle, "way": way, "span": span, "work": work}


def walk(rows, limits=Limits(), travel=TRAVEL):
    """(agent, sequence, the reasons) of each job of one group."""
    group = Group(limits)
    group.ways.update(travel)
    out = {}
    for job, start, end, origin, target, who in sorted(rows, key=lambda r: (r[1], r[0])):
        r = group.decide(job, start, end, origin, target, [cand(x) if isinstance(x, str) else x for x in who])
        out[job] = (r[1], r[2], {n: v for n, v in zip(REASONS, r[5:], strict=True) if v})
    return out


def test_reasons():
    first = ("j1", 0, H, 1, 2, ["a"])
    assert walk([first, ("j2", 2 * H, 3 * H, 9, 1, ["a"])])["j2"] == (None, None, {"unknown_way": 1})
    assert walk([first, ("j2", H + 599, 3 * H, 3, 1, ["a"])])["j2"] == (None, None, {"late": 1})
    assert walk([first, ("j2", H + 600, 3 * H, 3, 1, ["a"])])["j2"] == ("a", 2, {})
    assert walk([first, ("j2", H, 2 * H, 2, 1, ["a"])])["j2"] == ("a", 2, {})
    assert walk([("j1", 0, H, 1, 5, ["a"]), ("j2", 3 * H, 4 * H, 6, 1, ["a"])])["j2"] == (None, None, {"far": 1})
    assert walk([first, ("j2", 11 * H, 13 * H, 2, 1, ["a"])])["j2"] == (None, None, {"span": 1})
    assert walk([("j1", 0, 11 * H, 1, 2, ["a"])])["j1"] == (None, None, {"work": 1})
    assert walk([first, ("j2", 2 * H, 3 * H, 2, 1, ["a"])], Limits(work=100))["j2"] == (None, None, {"work": 1})


def test_limits_of_an_agent_go_before_those_of_all():
    second = lambda **own: walk([("j1", 0, H, 1, 2, [cand("a", **own)]), ("j2", 2 * H, 3 * H, 3, 1, [cand("a", **own)])])["j2"]
    assert second() == ("a", 2, {})
    assert second(work=129.0) == (None, None, {"work": 1}) and second(work=130.0)[0] == "a"
    assert second(span=179.0) == (None, None, {"span": 1}) and second(span=180.0)[0] == "a"
    assert second(way=9.0) == (None, None, {"far": 1}) and second(way=10.0)[0] == "a"


def test_a_vehicle_is_out_until_it_is_back():
    both = [cand("a", "v"), cand("b", "v")]
    got = walk([("j1", 0, H, 1, 2, both[:1]), ("j2", 60, H + 60, 1, 2, both[1:]), ("j3", H, H + 60, 1, 2, both[1:])])
    assert got["j1"][0] == "a" and got["j2"] == (None, None, {"vehicle": 1}) and got["j3"] == ("b", 1, {})


def test_all_refusals_are_counted_until_one_takes_it():
    got = walk([("j1", 0, H, 1, 2, ["a", "b"]), ("j2", 0, H, 1, 2, ["a", "b"]), ("j3", 60, 90, 1, 1, ["a", "b", "c", "d"])])
    assert got["j1"][0] == "a" and got["j2"] == ("b", 1, {"unknown_way": 1}) and got["j3"] == ("c", 1, {"unknown_way": 2})


def test_many_groups_are_those_of_single_ones(spark):
    rnd = random.Random(8)
    rows = []
    for j in range(400):
        s = rnd.randrange(80_000)
        who = [cand(f"a{a}", f"v{a // 2}" if a % 3 else None, rnd.choice([None, 20.0]), None, rnd.choice([None, 300.0])) for a in rnd.sample(range(6), j % 5)]
        rows.append((f"j{j}", s, s + rnd.randrange(60, 4000), rnd.randrange(6), rnd.randrange(6), who, j % 37))
    travel = {(o, t): float(abs(o - t) * 9) for o in range(6) for t in range(6) if (o, t) != (1, 4)}
    df = spark.createDataFrame(rows, JOBS).repartition(6)
    roads = spark.createDataFrame([(o, t, m) for (o, t), m in travel.items()], "origin int, target int, minutes double")
    got = {r.job: (r.agent, r.sequence, {n: r[n] for n in REASONS if r[n]}) for r in greedy_assignment(df, roads, ["g"]).collect()}
    want = {}
    for g in range(37):
        want |= walk([r[:6] for r in rows if r[6] == g], travel=travel)
    assert got == want and len(got) == 400


def test_nulls_days_and_empty_tables(spark):
    rows = [("j1", 0, H, 1, 2, [cand("a")], 1), ("j2", 60, H, 1, 2, [], 1), ("j3", 60, H, 1, 2, None, 1), (None, 1, 2, 1, 1, [cand("a")], 1), ("j4", None, 2, 1, 1, [cand("a")], 1), ("j5", 0, H, 1, 2, [cand("a")], 2), ("j6", 0, H, 1, 2, [cand("a")], None)]
    df, roads = spark.createDataFrame(rows, JOBS), spark.createDataFrame([(2, 3, 10.0), (2, 5, None), (None, 1, 1.0)], "origin int, target int, minutes double")
    got = {r.job: (r.agent, r.sequence, r.offers) for r in greedy_assignment(df, roads, ["g"]).collect()}
    assert got == {"j1": ("a", 1, 1), "j2": (None, None, 0), "j3": (None, None, 0), "j5": ("a", 1, 1), "j6": ("a", 1, 1)}
    assert greedy_assignment(df.limit(0), roads, ["g"]).count() == 0
    assert greedy_assignment(df, roads.limit(0), ["g"]).count() == 5


def test_contract(spark):
    good = [("j1", 0, H, 1, 2, [cand("a"), cand("b")], 1)]
    roads = [(2, 1, 10.0)]
    check = lambda rows, ways: {r.check: r.broken for r in assignment_contract(spark.createDataFrame(rows, JOBS), spark.createDataFrame(ways, "origin int, target int, minutes double"), ["g"]).collect() if r.broken}
    assert check(good, roads) == {}
    require(assignment_contract(spark.createDataFrame(good, JOBS), spark.createDataFrame(roads, "origin int, target int, minutes double"), ["g"]))
    bad = [("j1", 0, H, 1, 2, [cand("a"), cand("a")], 1), ("j1", H, H, None, 2, [cand(None)], 1)]
    assert check(bad, [(2, 1, -1.0), (2, 1, 3.0)]) == {"missing": 1, "not_after_start": 1, "repeated_candidate": 1, "nameless_candidate": 1, "repeated_job": 1, "repeated_way": 1, "negative_way": 1}
    with pytest.raises(ValueError, match="repeated_job"):
        require(assignment_contract(spark.createDataFrame(bad, JOBS), spark.createDataFrame(roads, "origin int, target int, minutes double"), ["g"]))
