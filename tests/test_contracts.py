"""Operators behind the contract queries, on small fixtures with what real tables seldom hold."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.columns import before_last, hash_bucket, hashed_years, json_key, money, percent, uuid5
from fareloom.operators import joins, quality, series
from fareloom.plans import contracts
from fareloom.sources import readers
from fareloom.sources.versions import Files


def test_licence_and_tips_decide_on_a_trip(spark, tmp_path):
    at = dt.datetime(2025, 3, 1, 9)
    row = lambda licence="HV0003", tier="Comfort", tips=1.0, taxi="T": (taxi, licence, at, at + dt.timedelta(minutes=9), 1, 2, 3.0, 540, 20.0, tips, tier, "2025-03", "L")
    rows = [row(), row("HV0005"), row("HV0005", "Extra Comfort"), row(tier="Extra Comfort"), row("HV0004", "Standard"), row(tips=5000.0), row(tips=5000.01), row(tips=float("nan")), row(tips=None), row(taxi="  "), row(tier=None)]
    schema = "taxi_id string, hvfhs_license_num string, pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int, trip_miles double, trip_time bigint, driver_pay double, tips double, estimated_service_tier string, year_month string, load_id string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/monthly_taxi_trip.parquet")
    (r,) = contracts.clean_reasons(spark, str(tmp_path)).collect()
    assert (r.total, r.valid, r.invalid, r.missing_or_type, r.value, r.service_tier) == (11, 3, 8, 3, 3, 4)
    (r,) = contracts.clean_trips(spark, str(tmp_path)).collect()
    assert (r.n, r.seconds, r.pay_cents) == (3, 1620, 6000)
    (r,) = contracts.trip_reconciliation(spark, str(tmp_path)).collect()
    assert (r.total, r.kept, r.rejected, r.balanced) == (11, 3, 8, True)


def test_reconciliation_sees_what_is_lost(spark):
    every = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    got = {r.k: (r.total, r.x, r.y, r.balanced) for r in quality.reconciled(every, {"x": every.where("v = 1"), "y": every.where("v = 3")}, ["k"]).collect()}
    assert got == {"a": (2, 1, 0, False), "b": (1, 0, 1, True)}


def test_suites_gates_and_collisions(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (None, " ")], "n int, s string")
    got = {r.check: (r.total, r.failed, r.passed) for r in quality.suite(df, {"half": (F.col("n") == 2, 0.5), "all": (F.col("s").isNotNull(), 1.0)}).collect()}
    assert got == {"half": (4, 2, True), "all": (4, 1, False)}
    assert not any(r.passed for r in quality.suite(df.limit(0), {"all": (F.lit(True), 1.0)}).collect())
    assert [tuple(r) for r in quality.errors(df, {"n": F.col("n").isNotNull(), "s": F.trim("s") != ""}, ["n"]).collect()] == [(1, "s"), (None, "n"), (None, "s")]
    assert tuple(quality.key_collisions(df, ["n", "s"], 0.25).first()) == (4, 3, 1, 0.25, "fail") and quality.key_collisions(df, ["n", "s"], 0.26).first().verdict == "pass"
    assert quality.key_collisions(df.limit(0), ["n"], 0.5).first().verdict == "fail"
    assert [tuple(r) for r in quality.empty_values(df.withColumn("d", F.lit(float("nan"))), ["n", "s", "d"]).collect()] == [("n", 4, 1, 0, 0), ("s", 4, 1, 1, 0), ("d", 4, 0, 0, 4)]
    with pytest.raises(ValueError, match="missing columns: z"):
        quality.require_columns(df, ["n", "z"])
    with pytest.raises(ValueError, match="no rows"):
        quality.require_columns(df.limit(0), ["n"])
    with pytest.raises(ValueError, match="twice"):
        quality.fail_on(quality.duplicates(df, ["n"]), "twice")
    quality.fail_on(quality.duplicates(df.where("n = 1"), ["n"]), "twice")
    zone, none = T.StructType([T.StructField("t", T.TimestampType())]), T.StructType([T.StructField("t", T.TimestampNTZType())])
    assert quality.same_signature(zone, T.StructType([T.StructField("t", T.TimestampType(), False)])) and not quality.same_signature(zone, none)


def test_exact_names_go_before_variants(spark):
    names = spark.createDataFrame([("m", "A"), ("m", "B"), ("m", "C"), ("n", "B")], "g string, n string")
    specs = spark.createDataFrame([("m", "A", 1), ("m", "A AWD", 2), ("m", "B AWD", 3), ("m", "B AWD 2WD", 4), ("m", "B HYBRID", 5), ("m", "BB", 6)], "g string, n string, e int")
    got = sorted((r.g, r.n, r.tier or "", r.spec_e or 0) for r in joins.two_tier_match(names, specs, "g", "n", ["AWD", "2WD"]).collect())
    assert got == [("m", "A", "exact", 1), ("m", "B", "variant", 3), ("m", "B", "variant", 4), ("m", "C", "", 0), ("n", "B", "", 0)]


def test_numbers_run_over_all_rows(spark):
    df = spark.createDataFrame([(f"k{i:04}",) for i in range(500)], "k string").repartition(7)
    assert sorted((r.number, r.k) for r in joins.numbered(df, "k").collect()) == [(i, f"k{i:04}") for i in range(500)]
    assert joins.numbered(df.limit(0), "k").count() == 0


def test_as_of_join_over_many_stretches(spark):
    t = lambda h: dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 5}", t(i * 7 % 400)) for i in range(300)] + [(900, None, t(1)), (901, "hot", None), (902, "alone", t(5))], "i int, k string, at timestamp")
    states = spark.createDataFrame([("hot", t(h), h) for h in (50, 51, 200, 399)] + [("k1", t(100), 7), ("k1", t(100), 9), (None, t(0), 1), ("hot", None, 3)], "k string, made timestamp, v int")
    got = {r.i: r.v for r in joins.asof_join(facts, states, ["k"], "at", "made", ["v"], 3600 * 24).collect()}
    have = {"hot": [(50, 50), (51, 51), (200, 200), (399, 399)], "k1": [(100, 9)]}
    want = {i: max((x for x in have.get("hot" if i % 3 else f"k{i % 5}", []) if x[0] <= i * 7 % 400), default=(0, None))[1] for i in range(300)}
    assert got == want | {900: None, 901: None, 902: None}


def test_series_statuses_watermarks_and_recursion(spark):
    day = lambda d: dt.date(2025, 3, d)
    values = spark.createDataFrame([(day(1), 2.0), (day(2), 2.0), (day(2), 3.0), (day(3), float("nan")), (day(4), 1.0), (day(5), None)], "day date, v double")
    got = {r.day.day: r.status for r in series.daily_status(values, series.calendar(spark, "2025-03-01", "2025-03-06"), "day", "v", 1.0, 15.0).collect()}
    assert got == {1: "ok", 2: "repeated", 3: "unusable", 4: "unusable", 5: "unusable", 6: "missing"}
    loads = spark.createDataFrame([("A", "2025-02", dt.datetime(2025, 5, 1)), ("A", "2025-03", dt.datetime(2025, 4, 1)), ("A", "2025-03", dt.datetime(2025, 4, 2))], "area string, month string, at timestamp")
    (r,) = series.watermark(loads, ["area"], "month", "at", "2025-05-10", 31).collect()
    assert (r.month, r.last, r.days, r.stale) == ("2025-03", day(2).replace(month=4), 38, True)
    rows = [("a", i, float(i % 4)) for i in range(70)] + [("b", 3, None), ("b", 9, 1.0)]
    got = {(r.k, r.at): r.state for r in series.decayed(spark.createDataFrame(rows, "k string, at int, v double"), ["k"], "at", "v", 0.8).collect()}
    state = 0.0
    for i in range(70):
        state = 0.8 * state + i % 4
        assert abs(got["a", i] - state) < 1e-9
    assert (got["b", 3], got["b", 9]) == (0.0, 1.0)


def test_keys_buckets_and_texts(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "a", 1), ("n#x#00012", "z", -1234)], "s string, t string, n int")
    space = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
    got = df.select(json_key(["s", "t"]).alias("j"), uuid5(space, F.col("s")).alias("u"), before_last(F.col("s"), "#").alias("b"), money(F.col("n") / 10).alias("m"), percent(F.col("n") / 1000).alias("p"), hash_bucket(F.col("s"), 7, 3).alias("h"), hashed_years(F.col("s"), 5).alias("y")).collect()
    assert got[0].j != got[1].j and got[0].u == str(uuid.uuid5(uuid.UUID(space), "a")) and got[2].u == str(uuid.uuid5(uuid.UUID(space), "n#x#00012"))
    assert (got[2].b, got[0].b, got[2].m, got[0].m, got[2].p) == ("n#x", "a", "-$123.40", "$0.10", "-123.4%")
    assert all(0 <= r.h < 7 for r in got) and all(0 <= r.y < 11 for r in got)


def test_readers_of_pages_and_nested_texts(spark, tmp_path):
    page = '<div class="card x"><h2>Big <i>Car</i></h2><a href="a/1">go</a> $9</div>\n<div class="cardx"><h2>no</h2></div><div class="card"><p>bare</p></div>'
    lines = "# Top\n* **Kia** Niro EV 2015 (A, B)<sup>2</sup>\n- **VW** Golf 2020\n* plain 2019\n* **X** Y"
    df = spark.createDataFrame([(page, lines)], "page string, lines string")
    r = df.select(readers.cards(F.col("page"), "card").alias("c"), readers.model_lines(F.col("lines")).alias("l")).first()
    assert [tuple(x) for x in r.c] == [("Big Car", "a/1", "Big Car go $9"), ("", None, "bare")]
    assert [tuple(x) for x in r.l] == [("Kia", "Niro EV", 2015, ["A", "B"]), ("VW", "Golf", 2020, [])]
    links = spark.createDataFrame([("x/1",), ("/x",), ("https://o.test/",), ("//o.test/y",)], "l string")
    assert [r[0] for r in links.select(readers.absolute(F.col("l"), "https://h.test/a/b")).collect()] == ["https://h.test/a/x/1", "https://h.test/x", "https://o.test/", "https://o.test/y"]
    docs = spark.createDataFrame([("1", '{"a": [{"text": "x", "more": {"text": "y"}}, {"text": {"text": "z"}}]}'), ("2", "no json"), ("3", None), ("4", '{"text": 5}')], "id string, doc string")
    assert [tuple(r) for r in readers.found_values(docs, "id", "doc", "text").collect()] == [("1", 0, "x"), ("1", 1, "y"), ("1", 2, "z")]
    assert readers.merged_headers(["", "Gas ", None, "Ev"], ["day", "price", "unit", None]) == ["day", "Gas_price", "Gas_unit", "Ev"]
    with pytest.raises(ValueError):
        readers.merged_headers(["Gas", None], ["a", "a"])
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="x"):
        readers.parquet(spark, f"{tmp_path}/t", T.StructType([T.StructField("x", T.LongType())]))
    (tmp_path / "c" / "area=A").mkdir(parents=True)
    (tmp_path / "c" / "area=A" / "x.csv").write_text("n\n1\n")
    assert [tuple(r) for r in readers.csv_text(spark, f"file://{tmp_path}/c/area=A", ["n", "area"], f"file://{tmp_path}/c").collect()] == [("1", "A")]


def test_years_fuels_and_aliases(spark):
    df = spark.createDataFrame([("1980", " EV ", "One"), ("2101", "Plug-in Hybrid", None), ("20x5", "Full hybrid", "one "), (" ", None, "ONE"), (None, "diesel", "one")], "y string, f string, a string")
    year, bad = readers.model_year(F.col("y"))
    got = df.select(year.alias("y"), bad.alias("b"), readers.fuel_class(F.col("f")).alias("f"), readers.known_alias(F.col("a"), {"one": "1"}).alias("a")).collect()
    assert [tuple(r) for r in got] == [(1980, False, "EV", "1"), (None, True, "PHEV", None), (None, True, "HYBRID", "1"), (None, False, "GAS", "1"), (None, False, "GAS", "1")]
    with pytest.raises(Exception, match="unknown name: two"):
        spark.createDataFrame([("two",)], "a string").select(readers.known_alias(F.col("a"), {"one": "1"})).collect()


def test_databases_are_asked_for_the_newest_rows_and_once_more(spark, tmp_path):
    from fareloom.sources import sinks

    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    sinks.jdbc(spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 30)], "AREA int, VERSION int, N int"), url, "AGG", driver=driver)
    query = readers.latest_sql("AGG", ["AREA"], "VERSION", ["AREA", "N"])
    assert sorted(tuple(r) for r in readers.jdbc(spark, url, query, driver=driver).collect()) == [(1, 20), (2, 30)]
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 2:
            raise OSError("gone")
        return spark.range(1)

    assert readers.once_more(flaky).count() == 1 and len(tries) == 2
    with pytest.raises(OSError):
        readers.once_more(lambda: (_ for _ in ()).throw(OSError("gone")))
    assert Files(spark).walk(f"file://{tmp_path}/db")
