import math
import random
from collections import Counter

from fareloom.operators.skew import heavy_keys, key_modes, key_percentiles, key_totals, value_frequencies

NAN, INF = float("nan"), float("inf")


def rows():
    rnd = random.Random(5)
    out = []
    for i in range(3000):
        a = "hot" if i % 3 else f"k{i % 17}"
        v = rnd.choice([0.0, -0.0, 1.25, -3.5, NAN, INF, None, round(rnd.gauss(0, 1000), 2), 1e300])
        out.append((a if i % 50 else None, i % 5 if i % 7 else None, v, "clash"))
    return out


def test_totals_modes_percentiles(spark):
    data = rows()
    df = spark.createDataFrame(data, "a string, b int, value double, n string").repartition(4)
    freq = value_frequencies(df, ["a", "b"], "value")
    groups = {}
    for a, b, v, _ in data:
        for c, k in (("a", a), ("b", b)):
            if k is not None:
                groups.setdefault((c, str(k)), []).append(v)
    totals = {(r.key_column, r.key_value): r for r in key_totals(freq).collect()}
    modes = {(r.key_column, r.key_value): (r["mode"], r.mode_rows) for r in key_modes(freq).collect()}
    perc = {(r.key_column, r.key_value, r.percent): r.value for r in key_percentiles(freq, [0, 10, 50, 99, 100]).collect()}
    assert set(totals) == set(groups)
    for k, vs in groups.items():
        good = sorted(v for v in vs if v is not None and math.isfinite(v))
        assert (totals[k].rows, totals[k].known, totals[k].distinct_values) == (len(vs), len(good), len(set(good)))
        counts = Counter("nan" if math.isnan(v) else v for v in vs if v is not None)
        top = max(counts.values())
        best = min((v for v, n in counts.items() if n == top), key=lambda v: INF if v == "nan" else v)
        assert modes[k][1] == top and (math.isnan(modes[k][0]) if best == "nan" else modes[k][0] == best)
        for p in (0, 10, 50, 99, 100):
            assert perc[*k, p] == good[max(1, math.ceil(len(good) * p / 100)) - 1]


def test_heavy_keys_count_rows_with_null_keys(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("y",)] * 2 + [(None,)] * 95, "k string")
    freq = value_frequencies(df.selectExpr("k", "1.0 as v"), ["k"], "v")
    assert [(r.key_value, r.rows) for r in heavy_keys(freq, df, 0.03).collect()] == [("x", 3)]


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v double")
    freq = value_frequencies(df, ["k"], "v")
    assert key_totals(freq).count() == key_modes(freq).count() == key_percentiles(freq, [50]).count() == heavy_keys(freq, df, 0.1).count() == 0
    nulls = value_frequencies(spark.createDataFrame([("a", None)], "k string, v double"), ["k"], "v")
    assert key_totals(nulls).first().known == 0 and key_percentiles(nulls, [50]).count() == 0
