"""Queries take all of their input: small tables with what a cut would lose."""

import datetime as dt

from fareloom.plans import catalog

DRIVER = "snapshot_month string, driver_id string, taxi_id string, vehicle_model_id string, manufacturer string, model_name string, weekly_lease_fee double, experience_years int, join_date date, exit_date date, comfort_eligible boolean"
ATTRIBUTION = "trip_key string, service_date date, pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int"


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def driver(i, month="2025-05", model="M1", fee=300.0, years=1, maker="X"):
    return (month, f"D{i:03}", f"T{i:03}", model, maker, "N", fee, years, dt.date(2020, 1, 1), None, True)


def test_every_trip_has_candidates_or_a_reason(spark, tmp_path):
    at = dt.datetime(2025, 3, 1, 8)
    trips = [(f"k{i}", at.date(), at + dt.timedelta(minutes=i), at + dt.timedelta(minutes=i + 5), 1, 2) for i in range(200)]
    put(spark, tmp_path, "attribution", trips, ATTRIBUTION)
    put(spark, tmp_path, "driver_snapshot", [driver(i) for i in range(43)], DRIVER)
    put(spark, tmp_path, "zone_lookup", [("1", "X", "Core"), ("2", "Y", None)], "LocationID string, Borough string, service_zone string")
    assert {r.job for r in catalog.greedy_trips(spark, str(tmp_path)).collect()} == {t[0] for t in trips}
    per = catalog.bucketed_candidates(spark, str(tmp_path)).collect()
    assert sum(r.jobs for r in per) == 200
    assert {r.pairs / r.jobs for r in per} == {4.0, 5.0}  # 43 drivers in ten buckets
    put(spark, tmp_path, "driver_snapshot", [], DRIVER)
    assert {(r.agent, r.offers) for r in catalog.greedy_trips(spark, str(tmp_path)).collect()} == {(None, 0)}
    assert [(r.pairs, r.jobs) for r in catalog.bucketed_candidates(spark, str(tmp_path)).collect()] == [(0, 200)]


TRIP = "pickup_datetime timestamp, taxi_id string, hvfhs_license_num string, driver_pay double, tips double, trip_miles double, PULocationID int"


def trip(day, zone=1):
    return (dt.datetime(day.year, day.month, day.day, 9), "T1", "L", 10.0, 0.0, 1.0, zone)


def test_days_are_complete_by_trips_of_any_zone(spark, tmp_path):
    first, second, third = (dt.date(2025, 3, d) for d in (1, 2, 3))
    put(spark, tmp_path, "monthly_taxi_trip", [trip(first, 7), trip(first, 149), trip(second, 8)], TRIP)
    put(spark, tmp_path, "documents", [(first,), (second,), (third,), (None,)], "published_on date")
    got = {r.day: (r.trips, r.documents, r.complete) for r in catalog.daily_completeness(spark, str(tmp_path)).collect()}
    assert (got["2025-03-01"], got["2025-03-02"], got["2025-03-03"]) == ((2, 1, True), (1, 1, True), (None, 1, False))
    assert got["2025-03-04"] == (None, None, False)


INVENTORY = "vehicle_model_id string, weekly_lease_fee double, model_year int, stock int"


def test_units_are_the_stock_less_those_held(spark, tmp_path):
    put(spark, tmp_path, "inventory", [("M1", 200.0, 2024, 5), ("M2", 300.0, 2020, 9), ("M3", 900.0, 2019, 1)], INVENTORY)
    drivers = [driver(i, model="M2", years=i) for i in range(1, 9)] + [driver(9, model="M1", fee=200.0), driver(10, model="M3", fee=150.0), driver(11, model="M3", fee=150.0), driver(12, model="M9", fee=150.0)]
    put(spark, tmp_path, "driver_snapshot", drivers, DRIVER)
    for query in (catalog.accepted_requests, catalog.single_pass_requests):
        got = {r.driver_id: (r.item, r.own) for r in query(spark, str(tmp_path)).collect()}
        # Of five units of M1 one is held; the four drivers of longest experience get the others.
        assert {d: got[d] for d in got if got[d][0] == "M1"} == {"D009": ("M1", True)} | {f"D{i:03}": ("M1", False) for i in range(5, 9)}
        assert {d for d in got if got[d] == ("M2", True)} == {f"D{i:03}" for i in range(1, 5)}
    over = {r.model: (r.used, r.stock) for r in catalog.overbooked_models(spark, str(tmp_path)).collect()}
    assert over == {"M3": (2, 1), "M9": (1, None)}


def test_weekly_points_hold_all_trips(spark, tmp_path):
    start = dt.date(2025, 2, 1)
    days = [start + dt.timedelta(days=i) for i in range(120)]
    # Two weeks without trips are a gap; 1 April is a Tuesday with seven trips more.
    kept = [d for d in days if not dt.date(2025, 3, 3) <= d <= dt.date(2025, 3, 16)] + [dt.date(2025, 4, 1)] * 7
    put(spark, tmp_path, "monthly_taxi_trip", [trip(d) for d in kept], TRIP)
    got = {r.at: (r.value, r.kind) for r in catalog.daily_from_weekly(spark, str(tmp_path)).collect()}
    at = lambda m, d: (dt.date(2025, m, d) - dt.date(2025, 1, 1)).days
    assert got[at(4, 3)] == (2.0, "observed") and got[at(3, 10)] == (1.0, "interpolated")
    assert [k for k in sorted(got) if got[k][1] == "extended"] == [at(5, 29), at(5, 30), at(5, 31)]
    assert sum(kind == "observed" for _, kind in got.values()) == 16
    loads = {r.at: (r.trips, r.ratio) for r in catalog.day_loads(spark, str(tmp_path)).collect()}
    assert loads[at(4, 3)] == (1, 0.5) and loads[at(5, 28)] == (1, 1.0)


def test_all_months_and_all_loads_count(spark, tmp_path):
    put(spark, tmp_path, "driver_snapshot", [driver(1, f"2025-{m:02}", fee=f) for m, f in ((2, 100.0), (3, 400.0), (5, 200.0))], DRIVER)
    fees = {r.at - 24299: (r.fee, r.kind) for r in catalog.monthly_fees(spark, str(tmp_path)).collect()}
    assert fees[3] == (40000.0, "observed") and fees[4] == (30000.0, "interpolated") and fees[1] == (10000.0, "extended")
    put(spark, tmp_path, "gold", [("NYC", "2025-03", v) for v in (1, 1, 2)], "service_area string, year_month string, version int")
    put(spark, tmp_path, "gold_load_versions", [("NYC", "2025-03", 1, dt.datetime(2025, 4, 20))], "service_area string, year_month string, version int, created_at timestamp")
    assert [r.version for r in catalog.versions_without_load(spark, str(tmp_path)).collect()] == [2]
