"""The queries p2 to p7 over the trip, attribution and gold tables, and SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.columns import cents, clean_id, seconds, stamp, within
from fareloom.operators.intervals import periods_and_gaps
from fareloom.operators.profile import NumberColumn, TextColumn, column_profile, deviating_loads
from fareloom.operators.rolling import rolling_totals
from fareloom.operators.sessions import sessions
from fareloom.operators.skew import heavy_keys, key_modes, key_percentiles, key_totals, value_frequencies
from fareloom.operators.snapshots import snapshot_changes
from fareloom.session import written
from fareloom.sources.tables import USABLE_FROM, USABLE_TO, table

SESSION_GAP = 240 * 60
TIERS = ("Standard", "Comfort", "Extra Comfort")
PROFILED = [NumberColumn("driver_pay", 0.0, 2000.0), NumberColumn("tips", 0.0, 2000.0), TextColumn("estimated_service_tier", TIERS)]
HOT_KEYS = ["PULocationID", "hvfhs_license_num"]


def _usable(spark: SparkSession, folder: str) -> DataFrame:
    trips = table(spark, folder, "monthly_taxi_trip")
    return trips.where(within(F.col("pickup_datetime"), USABLE_FROM, USABLE_TO)).withColumn("taxi_id", clean_id(F.col("taxi_id"))).where("taxi_id is not null")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Periods and gaps of each driver."""
    rows = table(spark, folder, "attribution").where("dropoff_datetime > pickup_datetime")
    rows = rows.select(clean_id(F.col("driver_id")).alias("driver_id"), seconds(F.col("pickup_datetime")).alias("s"), seconds(F.col("dropoff_datetime")).alias("e"))
    found = periods_and_gaps(rows, "driver_id", "s", "e")
    return found.select(F.col("key").alias("driver_id"), "kind", stamp(F.col("start")).alias("start_ts"), stamp(F.col("end")).alias("end_ts"))


def p2_driver_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Busy and idle seconds of each driver."""
    rows = table(spark, folder, "attribution").where("dropoff_datetime > pickup_datetime")
    rows = rows.select(clean_id(F.col("driver_id")).alias("driver_id"), seconds(F.col("pickup_datetime")).alias("s"), seconds(F.col("dropoff_datetime")).alias("e"))
    long = F.col("end") - F.col("start")
    return (
        periods_and_gaps(rows, "driver_id", "s", "e")
        .groupBy(F.col("key").alias("driver_id"))
        .agg(F.count_if(F.col("kind") == "period").alias("periods"), F.sum(F.when(F.col("kind") == "period", long)).alias("busy_s"), F.coalesce(F.sum(F.when(F.col("kind") == "gap", long)), F.lit(0)).alias("idle_s"))
    )


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Days whose last 7 days hold no pick-up of the taxi while its last 30 do."""
    daily = _usable(spark, folder).groupBy("taxi_id", F.to_date("pickup_datetime").alias("day")).agg(F.count("*").alias("pickups"))
    rolled = rolling_totals(daily, "taxi_id", "day", ["pickups"])
    return rolled.where("pickups_7 = 0 and pickups_30 > 0").select("taxi_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


def distinct_trips(spark: SparkSession, folder: str) -> DataFrame:
    """``taxi_id, day, cents`` of usable trips, one delivered twice counted once: the same taxi, times, places, distance, duration, pay and tips.

    A trip is told by 128 bits over these columns, so that counting it once combines before the shuffle and ships its pay alone; a busy taxi is spread over its trips.
    """
    same = ["taxi_id", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles", "trip_time", "driver_pay", "tips"]
    mark = [F.xxhash64(F.lit(seed), *(F.col(c) for c in same)).alias(f"h{seed}") for seed in (1, 2)]
    return _usable(spark, folder).groupBy("taxi_id", F.to_date("pickup_datetime").alias("day"), *mark).agg(F.any_value(cents(F.col("driver_pay"))).alias("cents")).drop("h1", "h2")


def p3_taxi_days(spark: SparkSession, folder: str) -> DataFrame:
    """Totals and averages of pay over the last 7 and 30 days. Pay that is not finite counts as a trip without pay."""
    daily = distinct_trips(spark, folder).groupBy("taxi_id", "day").agg(F.count("*").alias("trips"), F.count("cents").alias("paid"), F.coalesce(F.sum("cents"), F.lit(0)).alias("cents"))
    rolled = rolling_totals(daily, "taxi_id", "day", ["trips", "paid", "cents"])
    out = [F.col("taxi_id"), F.date_format("day", "yyyy-MM-dd").alias("day")]
    for w in (7, 30):
        out += [F.col(f"trips_{w}"), F.col(f"cents_{w}").alias(f"pay_cents_{w}"), F.try_divide(F.col(f"cents_{w}"), F.col(f"paid_{w}")).alias(f"cents_per_trip_{w}"), (F.col(f"cents_{w}") / w).alias(f"cents_per_day_{w}")]
    return rolled.select(*out)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The values that occur in at least 3 % of all rows."""
    trips = table(spark, folder, "monthly_taxi_trip")
    return heavy_keys(value_frequencies(trips, HOT_KEYS, "driver_pay"), trips, 0.03).select("key_column", "key_value")


def p4_key_pay(spark: SparkSession, folder: str) -> DataFrame:
    """Trips, pay, its distinct values, mode and exact percentiles per key."""
    # Written once: totals, modes and percentiles all start from it.
    freq = written(value_frequencies(table(spark, folder, "monthly_taxi_trip"), HOT_KEYS, cents(F.col("driver_pay"))), "freq")
    key = ["key_column", "key_value"]
    shares = key_percentiles(freq, [50, 90]).groupBy(*key).agg(*(F.max(F.when(F.col("percent") == p, F.col("value"))).alias(f"pay_cents_p{p}") for p in (50, 90)))
    totals = key_totals(freq).select(*key, F.col("rows").alias("trips"), F.col("distinct_values").alias("pay_values"), F.col("total").alias("pay_cents"))
    modes = key_modes(freq).select(*key, F.col("mode").alias("pay_cents_mode"), "mode_rows")
    return totals.join(modes, key, "left").join(shares, key, "left")


def p4_key_miles(spark: SparkSession, folder: str) -> DataFrame:
    """Trips and miles per key; miles in hundredths so that their sum doesn't depend on an order."""
    freq = value_frequencies(table(spark, folder, "monthly_taxi_trip"), HOT_KEYS, cents(F.col("trip_miles")))
    return key_totals(freq).select("key_column", "key_value", F.col("rows").alias("trips"), F.col("known").alias("measured"), F.col("total").alias("miles_100"))


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    ids = {c: clean_id(F.col(c)) for c in ("driver_id", "taxi_id", "vehicle_model_id")}
    return table(spark, folder, "gold").select("service_area", "year_month", "version", "driver_id", "taxi_id", "vehicle_model_id").withColumns(ids)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers that came, went or changed their taxi or model between consecutive snapshots."""
    changes = snapshot_changes(_gold(spark, folder), ["service_area", "year_month"], "version", "driver_id", ["taxi_id", "vehicle_model_id"])
    return changes.select("service_area", "year_month", "version", "driver_id", "change")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Working sessions of each taxi."""
    rows = _usable(spark, folder).select("taxi_id", seconds(F.col("pickup_datetime")).alias("t"))
    return sessions(rows, "taxi_id", "t", SESSION_GAP).select("taxi_id", stamp(F.col("start")).alias("session_start"), stamp(F.col("end")).alias("session_end"))


def p6_session_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Duration and deliveries of each session."""
    rows = _usable(spark, folder).select("taxi_id", seconds(F.col("pickup_datetime")).alias("t"))
    return sessions(rows, "taxi_id", "t", SESSION_GAP).select("taxi_id", stamp(F.col("start")).alias("session_start"), F.col("duration").alias("duration_s"), F.col("events").alias("pickups"))


def p7_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of three columns per load, with the distance of its values from those of all loads and of the load before."""
    p = column_profile(table(spark, folder, "monthly_taxi_trip"), "load_id", PROFILED)
    return p.select("load_id", "column_name", "rows", "nulls", "fitting", "misfits", "distinct_values", "zeros", "q50", F.round("ks", 9).alias("ks"), F.round("ks_prior", 9).alias("ks_prior"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Loads that differ from the rest."""
    p = column_profile(table(spark, folder, "monthly_taxi_trip"), "load_id", PROFILED)
    return deviating_loads(p, PROFILED, by_median=("driver_pay",))


QUERIES = {f.__name__: f for f in (p2_found, p2_driver_coverage, p3_found, p3_taxi_days, p4_found, p4_key_pay, p4_key_miles, p5_found, p6_found, p6_session_sizes, p7_found, p7_profile)}
