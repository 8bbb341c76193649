import datetime as dt
import random

import pytest

from fareloom.operators.rolling import rolling_totals

D0 = dt.date(2025, 2, 1)


@pytest.mark.parametrize("windows", [(7, 30), (1,), (2, 3, 5, 16, 31, 33)])
def test_same_as_direct_sums(spark, windows):
    rnd = random.Random(1)
    data = {(k, rnd.randrange(120)): (rnd.randrange(-50, 100), rnd.randrange(5)) for k in "abc" for _ in range(25)}
    rows = [(k, D0 + dt.timedelta(d), v, n, "x") for (k, d), (v, n) in data.items()] + [(None, D0, 1, 1, "x"), ("a", None, 1, 1, "x"), ("only", D0, None, 2, "x")]
    df = spark.createDataFrame(rows, "k string, day date, v bigint, n bigint, v_7 string")
    got = {(r.k, (r.day - D0).days): r for r in rolling_totals(df, "k", "day", ["v", "n"], windows).collect()}
    data[("only", 0)] = (0, 2)
    want = {(k, d) for k in {x for x, _ in data} for d in range(min(x for q, x in data if q == k), max(x for q, x in data if q == k) + 1)}
    assert set(got) == want
    for (k, d), r in got.items():
        for w in windows:
            inside = [data[k, x] for x in range(d - w + 1, d + 1) if (k, x) in data]
            assert (r[f"v_{w}"], r[f"n_{w}"]) == (sum(v for v, _ in inside), sum(n for _, n in inside))


def test_rows_of_one_day_add_up(spark):
    df = spark.createDataFrame([("a", D0, 2), ("a", D0, 3), ("a", D0 + dt.timedelta(1), 4)], "k string, day date, v bigint")
    assert sorted(r.v_7 for r in rolling_totals(df, "k", "day", ["v"], (7,)).collect()) == [5, 9]


def test_empty_and_wrong_windows(spark):
    df = spark.createDataFrame([], "k string, day date, v bigint")
    assert rolling_totals(df, "k", "day", ["v"]).count() == 0
    with pytest.raises(ValueError):
        rolling_totals(df, "k", "day", ["v"], (0,))
