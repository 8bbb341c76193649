import random

import pytest

from fareloom.operators.intervals import GapMap, periods_and_gaps


def brute(rows):
    """Periods and gaps of one entity by a plain sweep."""
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    found = [("period", a, b) for a, b in out]
    return found + [("gap", a[1], b[0]) for a, b in zip(out, out[1:], strict=False)]


def case(seed, span=2000, long=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        s = rnd.randrange(-span, span)
        rows.append(("hot" if i % 3 else f"d{i % 11}", s, s + rnd.choice([0, 1, 5, long, long * 20 if i % 97 == 0 else 3])))
    return rows


@pytest.mark.parametrize("seed,bucket", [(1, 50), (2, 1), (3, 86_400), (4, 777)])
def test_same_as_a_sweep(spark, seed, bucket):
    rows = case(seed)
    noise = [(None, 1, 2), ("n", None, 5), ("n", 5, None), ("reversed", 9, 3)]
    df = spark.createDataFrame([(k, s, e, "x", 1) for k, s, e in rows * 2 + noise], "key string, s bigint, e bigint, kind string, bucket int").repartition(5)
    got = {}
    for r in periods_and_gaps(df, "key", "s", "e", bucket).collect():
        got.setdefault(r.key, []).append((r.kind, r.start, r.end))
    want = {k: sorted(brute([(s, e) for x, s, e in rows if x == k])) for k in {x for x, _, _ in rows}}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_touching_intervals_are_one_and_single_ones_have_no_gap(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 21, 30), ("b", 5, 5)], "k string, s int, e int")
    got = sorted(tuple(r) for r in periods_and_gaps(df, "k", "s", "e").collect())
    assert got == [("a", "gap", 20, 21), ("a", "period", 0, 20), ("a", "period", 21, 30), ("b", "period", 5, 5)]
    assert periods_and_gaps(df.limit(0), "k", "s", "e").count() == 0


def test_the_map_stays_disjoint():
    rnd = random.Random(4)
    for _ in range(200):
        m, seen = GapMap(), set()
        for _ in range(rnd.randint(1, 40)):
            s = rnd.randrange(100)
            e = s + rnd.randrange(10)
            m.insert(s, e)
            seen.update(range(2 * s, 2 * e + 1))
        assert m.gaps == list(zip(m.ends, m.starts[1:], strict=False)) and all(a < b for a, b in m.gaps)
        assert {x for s, e in zip(m.starts, m.ends, strict=True) for x in range(2 * s, 2 * e + 1)} == seen
