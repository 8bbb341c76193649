import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareloom.functions.columns import cents, clean_id, finite
from fareloom.operators import aggregates, events, joins, quality, series


def test_asof_join_is_the_latest_not_after(spark):
    rnd = random.Random(1)
    facts = [(rnd.choice(["a", "b", None]), rnd.randrange(100), i) for i in range(200)] + [("a", None, 999)]
    states = [(rnd.choice(["a", "b", None]), rnd.randrange(100), f"s{i}") for i in range(40)]
    f = spark.createDataFrame(facts, "k string, t int, s int")
    s = spark.createDataFrame(states, "k string, at int, v string")
    got = {r.s: r.v for r in joins.asof_join(f, s, ["k"], "t", "at", ["v"]).collect()}
    for k, t, i in facts:
        before = [(a, v) for q, a, v in states if k is not None and t is not None and q == k and a <= t]
        assert got[i] == (max(before)[1] if before else None)


def test_null_safe_join_and_temporal_counts(spark):
    a = spark.createDataFrame([(1, None), (1, "x"), (None, "x")], "k int, c string")
    b = spark.createDataFrame([(1, None, "n"), (1, "x", "e"), (None, "x", "no")], "k int, c string, v string")
    assert sorted(r.v for r in joins.null_safe_join(a, b, ["k"], ["c"]).collect()) == ["e", "n"]
    d = lambda x: dt.date(2025, 1, x)
    facts = spark.createDataFrame([("f1", "t", d(5)), ("f2", "t", d(10)), ("f3", "t", d(1)), ("f4", None, d(5))], "f string, t string, day date")
    states = spark.createDataFrame([("t", d(5), d(10)), ("t", d(10), None)], "t string, a date, b date")
    got = {r.f: r.matches for r in joins.match_counts(facts, states, ["f"], "t", "day", "a", "b").collect()}
    assert got == {"f1": 1, "f2": 1, "f3": 0, "f4": 0}


def test_prefix_variants(spark):
    df = spark.createDataFrame([("m", "A"), ("m", "A AWD"), ("m", "A AWD 2WD"), ("m", "A HYBRID"), ("m", "AB AWD"), ("n", "A AWD")], "g string, n string")
    got = sorted((r.base, r.variant) for r in joins.prefix_variants(df, "g", "n", ["AWD", "2WD"]).collect())
    assert got == [("A", "A AWD"), ("A", "A AWD 2WD"), ("A AWD", "A AWD 2WD")]


def test_largest_remainder_and_units(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1)], "k string, w int")
    got = aggregates.largest_remainder(df, "k", "w", 10)
    assert {r.k: r.units for r in got.collect()} == {"a": 4, "b": 3, "c": 3}
    assert [r.unit_id for r in aggregates.expand_units(got.where("k = 'b'"), "k", "units").collect()] == ["b#00000", "b#00001", "b#00002"]


def test_best_block_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([([1, 5, 0, 5, 1],), ([0, 0, 0, 0, 9],)], "w array<bigint>")
    assert [r[0] for r in df.select(aggregates.best_block(F.col("w"), 2)).collect()] == [0, 3]


def test_top_and_other_histogram_latest(spark):
    df = spark.createDataFrame([("g", v) for v in "aaabbcd"] + [("g", None)], "g string, v string")
    for by in (None, ["g"]):
        assert {r.label: (r.n, r.members) for r in aggregates.top_and_other(df, "v", 2, by).collect()} == {"a": (3, 1), "b": (2, 1), "other": (2, 2)}
    h = spark.createDataFrame([(-5.0,), (0.0,), (9.99,), (10.0,), (99.0,), (float("nan"),), (None,)], "x double")
    assert {r.bin: r.n for r in aggregates.histogram(h, F.col("x"), 0, 10, 3).collect()} == {0: 3, 1: 1, 2: 1}
    v = spark.createDataFrame([("a", 1, 5), ("a", 3, 6), ("a", 3, 7)], "k string, v int, x int")
    assert sorted(r.x for r in aggregates.latest(v, ["k"], "v").collect()) == [6, 7]


@pytest.mark.parametrize("points", [[(5, 10.0), (9, 30.0), (12, 0.0)], [(7, 1.0)], []])
def test_interpolation(spark, points):
    df = spark.createDataFrame([("k", x, y) for x, y in points] + [("k", 6, None)], "k string, at int, v double")
    grid = spark.createDataFrame([("k", i) for i in range(3, 15)], "k string, at int")
    got = {r["at"]: (r.v, r.kind) for r in series.interpolate(df, grid, "at", "v", ["k"]).collect()}
    for i in range(3, 15):
        below, above = [p for p in points if p[0] <= i], [p for p in points if p[0] >= i]
        if not points:
            assert got[i] == (None, None)
        elif below and above:
            a, b = below[-1], above[0]
            assert got[i][0] == (a[1] if a == b else a[1] + (b[1] - a[1]) * (i - a[0]) / (b[0] - a[0]))
        else:
            assert got[i] == ((below or above)[-1 if below else 0][1], "extended")


def test_fold_events_order(spark):
    rows = [
        ("a", 1, "open", "t1"), ("a", 2, "change", "t2"), ("a", 3, "close", None), ("a", 4, "change", "t3"),
        ("b", 1, "change", "t9"), ("c", 5, "open", "t5"), ("c", 5, "close", None), ("d", 1, "open", "x"), ("d", 2, "close", None), ("d", 3, "open", "y"), (None, 1, "open", "z"), ("e", 1, "other", "q"),
    ]
    df = spark.createDataFrame(rows, "k string, at int, kind string, v string")
    got = {r.k: (r.opened_at, r.closed_at, r.v, r.since) for r in events.fold_events(df, "k", "at", "kind", "v", "open", "close", "change").collect()}
    assert got == {"a": (1, 3, "t3", 4), "c": (5, None, "t5", 5), "d": (3, None, "y", 3)}


def test_gate_bounds(spark):
    df = spark.createDataFrame([(100, 5), (100, 10), (100, 0), (0, 0), (100, 4)], "total int, invalid int")
    assert [r.verdict for r in quality.gate(df, 0.05, 0.1).collect()] == ["warn", "fail", "pass", "fail", "pass"]
    assert [r.verdict for r in quality.gate(df, 0.05, 0.1, inclusive=False).collect()] == ["pass", "warn", "pass", "fail", "pass"]
    assert quality.gate(df.where("total = 100 and invalid = 0"), 0, 1).first().verdict == "pass"
    with pytest.raises(ValueError):
        quality.gate(df, 0.2, 0.1)


def test_rules_contracts_and_schemas(spark):
    df = spark.createDataFrame([("1", "a"), ("x", None), (None, "b")], "n string, c string")
    rules = {"number": F.col("n").try_cast("int").isNotNull(), "c": F.col("c") == "a"}
    good, bad = quality.split_valid(df, rules)
    assert good.count() == 1 and sorted(map(tuple, (r.reasons for r in bad.collect()))) == [("number", "c"), ("number", "c")]
    assert tuple(quality.key_counts(df, ["c"]).first()) == (3, 2, 1)
    assert quality.null_contract(df, ["n", "c"]).first().broken == 2
    schema = spark.createDataFrame([], "n int, z date").schema
    assert quality.schema_difference(df.schema, schema) == {"missing": ["z"], "extra": ["c"], "mismatched": ["n"]}
    with pytest.raises(ValueError):
        quality.failed_casts(df, schema)
    assert [r.n for r in quality.project(df.withColumn("z", F.lit("2025-01-01")), schema).collect()] == [1, None, None]


def test_columns(spark):
    df = spark.createDataFrame([(" ab ", 1.01), ("  ", float("nan")), (None, float("-inf")), ("x", 1e15), ("y", None)], "s string, v double")
    got = df.select(clean_id(F.col("s")).alias("s"), finite(F.col("v")).alias("f"), cents(F.col("v")).alias("c")).collect()
    assert [(r.s, r.f, r.c) for r in got] == [("AB", True, 101), (None, False, None), (None, False, None), ("X", True, 10**17), ("Y", False, None)]
    with pytest.raises(Exception, match="no whole cents"):
        spark.createDataFrame([(1e300,)], "v double").select(cents(F.col("v"))).collect()


def test_seeded_draws_repeat(spark):
    from fareloom.operators.draws import seeded_traits

    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    once = sorted((r.k, r.activity, r.prefers, tuple(r.weights)) for r in seeded_traits(df, "k").collect())
    again = sorted((r.k, r.activity, r.prefers, tuple(r.weights)) for r in seeded_traits(df.repartition(3), "k").collect())
    assert once == again and len(once) == 3 and once[0] == once[1] != once[2] and abs(sum(once[0][3]) - 1) < 1e-9


def test_forward_fill_and_command_line(spark, tmp_path):
    from fareloom.__main__ import main

    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("b", 9, None)], "k string, at int, v int")
    assert {(r.k, r["at"]): r.v for r in series.forward_fill(df, ["k"], "at", ["v"]).collect()} == {("a", 1): None, ("a", 2): 5, ("a", 3): 5, ("b", 9): None}
    spark.createDataFrame([("x", 2)], "vehicle_model_id string, stock int").write.parquet(f"file://{tmp_path}/inventory.parquet")
    main(["numbered_units", "--tables", f"file://{tmp_path}", "--out", f"file://{tmp_path}/out", "--limit", "5", "--format", "csv"])
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out").count() == 2


def test_draws_of_fates_units_and_roundings(spark):
    from fareloom.operators.draws import drawn_units, evolved, rounded_at_random, seeded_traits, uniform

    ids = spark.range(4000).selectExpr("concat('d', id) as k")
    fates = {r.fate: r["count"] for r in evolved(ids, "k", F.lit("2025-02"), 0.1, 0.3).groupBy("fate").count().collect()}
    assert 300 < fates["leaves"] < 500 and 1050 < fates["changes"] < 1350
    mean = ids.select(rounded_at_random(F.lit(2.3), uniform(F.col("k"))).alias("n")).agg(F.avg("n")).first()[0]
    assert 2.25 < mean < 2.35
    got = drawn_units(ids.limit(50), "k", spark.range(30).selectExpr("concat('u', id) as unit"), "unit", "p").collect()
    assert len(got) == 50 and len({r.unit for r in got if r.unit}) == 30 and sum(r.unit is None for r in got) == 20
    again = drawn_units(ids.limit(50).repartition(5), "k", spark.range(30).selectExpr("concat('u', id) as unit"), "unit", "p").collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in got}
    for r in seeded_traits(ids.limit(20), "k", shares=5).collect():
        assert abs(sum(r.weights) - 1) < 1e-9 and 0 <= r.days <= 30 and 0 <= r.kind < 5 and sum(r.parts) == 100
