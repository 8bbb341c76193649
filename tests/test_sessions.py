import random

import pytest

from fareloom.operators.sessions import sessions


@pytest.mark.parametrize("seed,gap", [(1, 10), (2, 1), (3, 240), (4, 10_000)])
def test_same_as_walking(spark, seed, gap):
    rnd = random.Random(seed)
    rows = []
    for k in ["a", "b", "hot", "chain"]:
        t = rnd.randrange(-5000, 5000)
        for _ in range(600 if k == "hot" else 120):
            t += gap if k == "chain" else rnd.choice([0, 1, gap - 1, gap, gap + 1, 2 * gap, gap // 2])
            rows.append((k, t, "x"))
    rnd.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, 1, "x"), ("a", None, "x")], "k string, t bigint, start string").repartition(3)
    want = set()
    for k in {r[0] for r in rows}:
        times = sorted(t for x, t, _ in rows if x == k)
        first, last, n = times[0], times[0], 0
        for t in times:
            if t - last > gap:
                want.add((k, first, last, last - first, n))
                first, n = t, 0
            last, n = t, n + 1
        want.add((k, first, last, last - first, n))
    got = [tuple(r) for r in sessions(df, "k", "t", gap).collect()]
    assert len(got) == len(want) and set(got) == want


def test_empty_single_and_wrong_gap(spark):
    df = spark.createDataFrame([("a", 7), ("a", 7)], "k string, t int")
    assert [tuple(r) for r in sessions(df, "k", "t", 60).collect()] == [("a", 7, 7, 0, 2)]
    assert sessions(df.limit(0), "k", "t", 60).count() == 0
    with pytest.raises(ValueError):
        sessions(df, "k", "t", 0)
