"""Queries over the operators that aren't the numbered problems, named by what they compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.functions.columns import cents, clean_id, finite, natural_key, seconds, seed_of, stamp, unusable, within
from fareloom.operators import aggregates, allocation, assignment, candidates, draws, events, joins, quality, series
from fareloom.sources import readers
from fareloom.sources.tables import USABLE_FROM, USABLE_TO, table
from fareloom.sources.versions import expired_versions

TIERS = ["Standard", "Comfort", "Extra Comfort"]
AS_OF = "2025-05-20"


def _trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with a usable pick-up and a taxi, ids cleaned, money in cents and miles in hundredths."""
    t = table(spark, folder, "monthly_taxi_trip")
    return t.where(within(F.col("pickup_datetime"), USABLE_FROM, USABLE_TO)).withColumns({
        "taxi_id": clean_id(F.col("taxi_id")), "licence": clean_id(F.col("hvfhs_license_num")), "day": F.to_date("pickup_datetime"),
        "pay": cents(F.col("driver_pay")), "tip": cents(F.col("tips")), "miles": cents(F.col("trip_miles")),
    }).where("taxi_id is not null")


def _drivers(spark: SparkSession, folder: str) -> DataFrame:
    """Driver snapshots once per row, ids cleaned."""
    ids = {c: clean_id(F.col(c)) for c in ("driver_id", "taxi_id", "vehicle_model_id", "manufacturer", "model_name")}
    return table(spark, folder, "driver_snapshot").withColumns(ids).distinct()


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    ids = {c: clean_id(F.col(c)) for c in ("driver_id", "taxi_id", "vehicle_model_id")}
    kept = ["service_area", "year_month", "version", "driver_id", "taxi_id", "vehicle_model_id", "manufacturer", "monthly_net_profit", "monthly_driver_pay"]
    return table(spark, folder, "gold").withColumns(ids).select(*kept).distinct()


def _rules() -> dict[str, Column]:
    return {
        "times": F.col("pickup_datetime").cast("timestamp") < F.col("dropoff_datetime").cast("timestamp"),
        "miles": finite(F.col("trip_miles")) & (F.col("trip_miles") > 0) & (F.col("trip_miles") <= 1000),
        "duration": F.col("trip_time").between(1, 86_400),
        "pay": finite(F.col("driver_pay")) & F.col("driver_pay").between(0, 5000),
        "tier": F.col("estimated_service_tier").isin(*TIERS),
        "taxi": clean_id(F.col("taxi_id")).isNotNull(),
    }


# Scans, projections, filters


def trip_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per load that keep all rules, and how many break each."""
    return quality.rule_counts(table(spark, folder, "monthly_taxi_trip"), _rules(), ["load_id"])


def trip_reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Combinations of broken rules and how often they occur."""
    flagged = quality.flag(table(spark, folder, "monthly_taxi_trip"), _rules())
    return flagged.groupBy(F.concat_ws(",", "reasons").alias("reasons")).agg(F.count("*").alias("n"))


def trip_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The loads' verdicts under two bounds on the share of invalid rows."""
    counts = quality.rule_counts(table(spark, folder, "monthly_taxi_trip"), _rules(), ["load_id"])
    return quality.gate(counts, 0.05, 0.12).select("load_id", "total", "invalid", "verdict")


def unusable_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, NaN and infinities per number column and month."""
    t = table(spark, folder, "monthly_taxi_trip")
    return t.groupBy("year_month").agg(*(F.count_if(unusable(F.col(c))).alias(c) for c in ("trip_miles", "driver_pay", "tips")))


def month_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose month column isn't the month of their pick-up."""
    t = table(spark, folder, "monthly_taxi_trip").where(F.date_format("pickup_datetime", "yyyy-MM") != F.col("year_month"))
    return t.groupBy("year_month").agg(F.count("*").alias("n"))


def taxi_weekdays(spark: SparkSession, folder: str) -> DataFrame:
    """The weekdays a taxi works as a bit mask (Monday is bit 0), and its trips on days of the mask of the weekend."""
    index = F.pmod(F.dayofweek("day") + 5, F.lit(7))
    t = _trips(spark, folder).withColumn("bit", F.expr("shiftleft(1, cast(pmod(dayofweek(day) + 5, 7) as int))"))
    return t.groupBy("taxi_id").agg(F.bit_or("bit").alias("mask"), F.count_if(F.col("bit").bitwiseAND(96) != 0).alias("weekend_trips"), F.count_distinct(index).alias("weekdays"))


def active_drivers(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers whose contract is valid on a day, per snapshot month."""
    d = _drivers(spark, folder).where(joins.valid_at(F.lit(AS_OF).cast("date"), F.col("join_date"), F.col("exit_date")))
    return d.groupBy("snapshot_month").agg(F.count_distinct("driver_id").alias("drivers"))


def comparable_names(spark: SparkSession, folder: str) -> DataFrame:
    """Spellings per comparable zone name."""
    t = table(spark, folder, "monthly_taxi_trip").select(F.col("pickup_zone").alias("zone"))
    return t.groupBy(readers.join_key(F.col("zone")).alias("zone_key")).agg(F.count("*").alias("n"), F.count_distinct("zone").alias("spellings"))


def price_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Every dollar amount of each document, numbered in order; null and flagged when it is not within bounds."""
    each = F.posexplode(F.regexp_extract_all("text", F.lit(r"\$ ?([0-9][0-9,]*(?:\.[0-9]+)?)"), F.lit(1)))
    found = table(spark, folder, "documents").where("text is not null").select("doc_id", each.alias("place", "amount"))
    value, bad = readers.optional_number(F.regexp_replace("amount", ",", ""), 50, 5000)
    return found.select("doc_id", (F.col("place") + 1).alias("place"), value.alias("price"), bad.alias("out_of_bounds"))


def stripped_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with tags: their length without them."""
    t = table(spark, folder, "documents").where(F.col("text").rlike("<[^<>]*>"))
    return t.select("doc_id", F.length(readers.strip_markup(F.col("text"))).alias("plain_chars"))


def product_years(spark: SparkSession, folder: str) -> DataFrame:
    """Nested JSON of models and product lists to rows, keeping the first year per product."""
    made = table(spark, folder, "inventory").groupBy("manufacturer", "model_name").agg(F.min("model_year").alias("year"))
    text = F.concat(F.col("year"), F.lit(" (Standard, Comfort) / "), F.col("year") + 2, F.lit(" (Standard, Extra Comfort)"))
    per = made.groupBy("manufacturer").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("model_name", text.alias("t"))))).alias("m"))
    doc = per.select(F.to_json(F.create_map("manufacturer", "m")).alias("json"))
    rows = doc.select(F.inline(readers.nested_names(F.col("json"))))
    return rows.groupBy("make", "model", "product").agg(F.min("year").alias("first_year"), F.count("*").alias("mentions"))


# Joins


def model_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots that agree with the inventory in model and, nulls being equal, in fuel and the two flags."""
    models = table(spark, folder, "inventory").select("vehicle_model_id", "fuel_type", "comfort_eligible", "extra_comfort_eligible", "fuel_efficiency", "model_year")
    d = _drivers(spark, folder).select("snapshot_month", "driver_id", "vehicle_model_id", "fuel_type", "comfort_eligible", "extra_comfort_eligible")
    found = joins.null_safe_join(d, F.broadcast(models), ["vehicle_model_id"], ["fuel_type", "comfort_eligible", "extra_comfort_eligible"])
    return found.groupBy("snapshot_month", "vehicle_model_id").agg(F.count("*").alias("drivers"), F.max("fuel_efficiency").alias("fuel_efficiency"), F.max("model_year").cast("int").alias("model_year"))


def unknown_taxis(spark: SparkSession, folder: str) -> DataFrame:
    """The first few drivers on record to whom no trip is attributed."""
    a = table(spark, folder, "attribution").select(clean_id(F.col("driver_id")).alias("driver_id")).where("driver_id is not null")
    return quality.unmatched(_drivers(spark, folder).select("driver_id"), a, ["driver_id"], 20)


def zone_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Trips between boroughs: one dimension joined in two roles."""
    zones = table(spark, folder, "zone_lookup").withColumn("LocationID", F.col("LocationID").cast("int"))
    t = joins.dimension_roles(table(spark, folder, "monthly_taxi_trip"), zones, "LocationID", {"PULocationID": "pickup", "DOLocationID": "dropoff"}, ["Borough"])
    return t.groupBy(F.col("pickup_Borough").alias("pickup"), F.col("dropoff_Borough").alias("dropoff")).agg(F.count("*").alias("n"))


def attributed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Attributed trips with the delivered ones of the same taxi and pick-up, and the snapshot of the month."""
    a = table(spark, folder, "attribution").select("trip_key", clean_id(F.col("taxi_id")).alias("taxi_id"), clean_id(F.col("driver_id")).alias("driver_id"), F.col("pickup_datetime").alias("at"), F.date_format("service_date", "yyyy-MM").alias("month")).distinct()
    t = _trips(spark, folder).select("taxi_id", F.col("pickup_datetime").alias("at"), "pay").distinct()
    d = _drivers(spark, folder).select(F.col("snapshot_month").alias("month"), "driver_id", F.col("vehicle_model_id").alias("model")).distinct()
    return a.join(t, ["taxi_id", "at"]).join(d, ["month", "driver_id"]).groupBy("month", "model").agg(F.count("*").alias("trips"), F.sum("pay").alias("pay_cents"))


def vehicle_matches(spark: SparkSession, folder: str) -> DataFrame:
    """How many valid snapshots attributed trips have on their day; one is the contract."""
    states = _drivers(spark, folder).groupBy("taxi_id", "driver_id", "vehicle_since").agg(F.max("exit_date").alias("exit_date"))
    facts = table(spark, folder, "attribution").select("trip_key", clean_id(F.col("taxi_id")).alias("taxi_id"), "service_date").distinct()
    counts = joins.match_counts(facts, states.drop("driver_id"), ["trip_key"], "taxi_id", "service_date", "vehicle_since", "exit_date")
    return counts.groupBy("matches").agg(F.count("*").alias("trips"))


def asof_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The newest snapshot not after a trip, per driver."""
    facts = table(spark, folder, "attribution").select("trip_key", clean_id(F.col("driver_id")).alias("driver_id"), F.col("pickup_datetime").cast("timestamp").alias("at")).distinct()
    states = _drivers(spark, folder).select("driver_id", F.col("snapshot_created_at").cast("timestamp").alias("made"), "snapshot_month", "vehicle_model_id")
    found = joins.asof_join(facts, states, ["driver_id"], "at", "made", ["snapshot_month", "vehicle_model_id"])
    return found.select("trip_key", "driver_id", "snapshot_month", "vehicle_model_id")


def versions_without_load(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots in the data that the load list lacks."""
    loads = table(spark, folder, "gold_load_versions")
    return quality.unmatched(table(spark, folder, "gold"), loads, ["service_area", "year_month", "version"])


def busy_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Zones that trips start in (semi join), with those that none does."""
    zones = table(spark, folder, "zone_lookup").select(F.col("LocationID").cast("int").alias("PULocationID"), "Borough")
    started = table(spark, folder, "monthly_taxi_trip").select("PULocationID", F.lit(True).alias("used")).distinct()
    return zones.join(started, "PULocationID", "left").groupBy("Borough").agg(F.count("*").alias("zones"), F.count("used").alias("used"))


def model_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Model names that are another one plus a trim word."""
    every = table(spark, folder, "inventory").select("manufacturer", "model_name")
    short = every.select("manufacturer", F.regexp_replace("model_name", " (AWD|XL|HYBRID)$", "").alias("model_name"))
    return joins.prefix_variants(every.unionByName(short), "manufacturer", "model_name", ["AWD", "XL"])


def cheaper_models(spark: SparkSession, folder: str) -> DataFrame:
    """Per driver and month the number of models whose fee is lower than the driver's own (each driver against the 36 models)."""
    models = table(spark, folder, "inventory").select(F.col("weekly_lease_fee").alias("fee"))
    d = _drivers(spark, folder).where("weekly_lease_fee is not null and not isnan(weekly_lease_fee)").groupBy("snapshot_month", "driver_id").agg(F.min("weekly_lease_fee").alias("own_fee"))
    return d.join(F.broadcast(models), F.col("fee") < F.col("own_fee"), "left").groupBy("snapshot_month", "driver_id").agg(F.count("fee").alias("cheaper"))


def profit_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers of each snapshot at or above each of a list of thresholds."""
    steps = spark.createDataFrame([(x,) for x in (1000, 2000, 3000, 4000, 5000)], "threshold int")
    g = _gold(spark, folder).where(finite(F.col("monthly_net_profit")))
    return g.join(F.broadcast(steps), F.col("monthly_net_profit") >= F.col("threshold")).groupBy("service_area", "year_month", "version", "threshold").agg(F.count_distinct("driver_id").alias("drivers"))


# Aggregates


def driver_month_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Trips, miles, pay and tips per driver and month; the taxi's driver comes from the month's snapshot."""
    same = ["taxi_id", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "miles", "pay", "tip", "day"]
    # Once per trip, told by 128 bits over its columns, with the few figures needed: this combines before the shuffle and ships no other column.
    mark = [F.xxhash64(F.lit(seed), *(F.col(c) for c in same)).alias(f"h{seed}") for seed in (1, 2)]
    t = _trips(spark, folder).groupBy("taxi_id", "day", *mark).agg(*(F.any_value(c).alias(c) for c in ("miles", "pay", "tip")))
    per = t.groupBy("taxi_id", F.date_format("day", "yyyy-MM").alias("month")).agg(F.count("*").alias("trips"), F.sum("miles").alias("miles_100"), F.sum("pay").alias("pay_cents"), F.sum("tip").alias("tip_cents"))
    d = _drivers(spark, folder).select(F.col("snapshot_month").alias("month"), "taxi_id", "driver_id").distinct()
    return per.join(d, ["month", "taxi_id"]).select("driver_id", "month", "trips", "miles_100", "pay_cents", "tip_cents")


def tier_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Pay per mile of each tier, as columns, per licence and distance band."""
    band = F.when(F.col("miles") < 200, "0-2").when(F.col("miles") < 500, "2-5").when(F.col("miles") < 1000, "5-10").when(F.col("miles") < 2000, "10-20").otherwise("20+")
    t = _trips(spark, folder).where("miles > 0 and pay >= 0 and licence is not null").withColumn("band", band)
    rates = aggregates.ratio_pivot(t, ["licence", "band"], "estimated_service_tier", TIERS, F.col("pay"), F.col("miles"))
    return rates.select("licence", "band", *(F.round(c, 6).alias(c) for c in ("standard", "comfort", "extra_comfort")))


def totals_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and pay before and after grouping by taxi and day; both parts must agree."""
    t = _trips(spark, folder)
    daily = t.groupBy("taxi_id", "day").agg(F.sum("pay").alias("pay"), F.count("*").alias("n"))
    parts = quality.control_totals({"trips": t.select("pay", F.lit(1).alias("n")), "days": daily}, {"pay_cents": F.col("pay"), "n": F.col("n")})
    return parts.select("part", "pay_cents", "n").withColumn("same", quality.same_within(F.max("pay_cents").over(Window.partitionBy()), F.min("pay_cents").over(Window.partitionBy())))


def trip_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Uniqueness of the attribution key per day."""
    return quality.key_counts(table(spark, folder, "attribution").withColumn("day", F.date_format("service_date", "yyyy-MM-dd")), ["trip_key"], ["day"])


def repeated_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Keys delivered more than once."""
    return quality.duplicates(table(spark, folder, "attribution"), ["trip_key"]).withColumnRenamed("count", "n")


def zone_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Median minutes between zones with at least five trips."""
    t = table(spark, folder, "attribution").where("dropoff_datetime > pickup_datetime").select("trip_key", "PULocationID", "DOLocationID", "pickup_datetime", "dropoff_datetime").distinct()
    minutes = (seconds(F.col("dropoff_datetime")) - seconds(F.col("pickup_datetime"))) / 60
    # Counted by value first: what a busy pair of zones holds is its different durations, not its trips.
    counted = t.groupBy("PULocationID", "DOLocationID", minutes.alias("minutes")).agg(F.count("*").alias("n"))
    return counted.groupBy("PULocationID", "DOLocationID").agg(F.sum("n").alias("trips"), F.percentile("minutes", F.lit(0.5), F.col("n")).alias("m")).where("trips >= 5").select("PULocationID", "DOLocationID", "trips", F.round("m", 4).alias("minutes"))


def fleet_by_model(spark: SparkSession, folder: str) -> DataFrame:
    """Taxis per model in each snapshot, a taxi once."""
    d = _drivers(spark, folder).groupBy("snapshot_month", "taxi_id").agg(F.min("vehicle_model_id").alias("model"))
    return d.groupBy("snapshot_month", "model").agg(F.count("*").alias("stock"))


def maker_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of the models of a maker, and its fuel or MIXED."""
    i = table(spark, folder, "inventory")
    return i.groupBy("manufacturer").agg(F.min("fuel_efficiency").alias("low"), F.max("fuel_efficiency").alias("high"), F.count("*").alias("models"), aggregates.one_or_mixed(F.col("fuel_type")).alias("fuel"))


def first_taxi(spark: SparkSession, folder: str) -> DataFrame:
    """Of each model and area the driver with the lowest month and id."""
    g = _gold(spark, folder).where("driver_id is not null and vehicle_model_id is not null")
    return g.groupBy("service_area", "vehicle_model_id").agg(F.min("year_month").alias("since"), F.min_by("driver_id", F.struct("year_month", "driver_id")).alias("driver_id"))


def snapshot_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """Count, mean, median and models of the newest version of each snapshot."""
    g = aggregates.latest(_gold(spark, folder), ["service_area", "year_month"], "version").where(finite(F.col("monthly_net_profit")))
    profit = cents(F.col("monthly_net_profit"))
    return g.groupBy("service_area", "year_month").agg(
        F.count("*").alias("drivers"), F.round(F.sum(profit) / F.count("*"), 3).alias("mean_cents"), F.round(F.percentile(profit, 0.5), 3).alias("median_cents"), F.count_distinct("vehicle_model_id").alias("models")
    )


def top_zones(spark: SparkSession, folder: str) -> DataFrame:
    """The seven busiest zones, and one row for all others."""
    return aggregates.top_and_other(table(spark, folder, "monthly_taxi_trip"), "PULocationID", 7)


def top_makers(spark: SparkSession, folder: str) -> DataFrame:
    """The three most frequent makers per area, and the others."""
    return aggregates.top_and_other(_gold(spark, folder), "manufacturer", 3, ["service_area"])


def profit_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers per 24 bins of profit and area."""
    return aggregates.histogram(_gold(spark, folder), F.col("monthly_net_profit"), -2000.0, 500.0, 24, ["service_area"])


def working_capacity(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a month on which a taxi usually works: its weekday mask against the calendar."""
    masks = taxi_weekdays(spark, folder).select("taxi_id", "mask")
    days = series.calendar(spark, "2025-04-01", "2025-04-30").select(F.expr("shiftleft(1, cast(pmod(dayofweek(day) + 5, 7) as int))").alias("bit"), "day")
    return masks.join(F.broadcast(days), F.col("mask").bitwiseAND(F.col("bit")) != 0).groupBy("taxi_id").agg(F.count("*").alias("days"))


def shared_units(spark: SparkSession, folder: str) -> DataFrame:
    """1000 units shared over makers by their stock: largest remainders."""
    stock = table(spark, folder, "inventory").groupBy("manufacturer").agg(F.sum("stock").alias("weight"))
    return aggregates.largest_remainder(stock, "manufacturer", "weight", 1000)


def numbered_units(spark: SparkSession, folder: str) -> DataFrame:
    """One row per vehicle in stock."""
    return aggregates.expand_units(table(spark, folder, "inventory"), "vehicle_model_id", "stock")


def snapshot_grain(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and drivers of each snapshot, and whether every driver has one row."""
    g = _gold(spark, folder).where("driver_id is not null")
    return g.groupBy("service_area", "year_month", "version").agg(F.count("*").alias("n"), F.count_distinct("driver_id").alias("drivers")).withColumn("one_each", F.col("n") == F.col("drivers"))


# Windows, ranks, sets


def best_attributions(spark: SparkSession, folder: str) -> DataFrame:
    """The three best-scored trips of each zone and day."""
    a = table(spark, folder, "attribution").where("driver_id is not null").select("service_date", "PULocationID", "trip_key", "preference_score", "tie_break").distinct()
    order = Window.partitionBy("service_date", "PULocationID").orderBy(F.desc("preference_score"), "tie_break", "trip_key")
    return a.withColumn("place", F.row_number().over(order)).where("place <= 3").select(F.date_format("service_date", "yyyy-MM-dd").alias("day"), "PULocationID", "trip_key", "place")


def occurrences(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows are a first, second, ... delivery of a trip."""
    same = ["taxi_id", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]
    t = aggregates.occurrence(_trips(spark, folder).select(*same, "load_id"), same, ["load_id"])
    return t.groupBy("occurrence").agg(F.count("*").alias("n"))


def dear_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips 15 % above the median pay of their licence and route, where the route has at least 20."""
    t = _trips(spark, folder).where("pay is not null and licence is not null").select("licence", "PULocationID", "DOLocationID", "pay")
    route = ["licence", "PULocationID", "DOLocationID"]
    # Counted by value first, and the median aggregated and joined: no window holds a busy route in one task.
    counted = t.groupBy(*route, "pay").agg(F.count("*").alias("c"))
    usual = counted.groupBy(*route).agg(F.sum("c").alias("n"), F.percentile("pay", F.lit(0.5), F.col("c")).alias("median")).where("n >= 20")
    return counted.join(usual, route).groupBy(*route, "n").agg(F.sum(F.when(F.col("pay") >= F.col("median") * 1.15, F.col("c")).otherwise(0)).alias("dear"))


def newest_version(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers of the newest version of each snapshot."""
    g = aggregates.latest(_gold(spark, folder), ["service_area", "year_month"], "version")
    return g.select("service_area", "year_month", "version", "driver_id", "taxi_id")


def expired(spark: SparkSession, folder: str) -> DataFrame:
    """Versions that retention would delete."""
    return expired_versions(table(spark, folder, "gold"), table(spark, folder, "gold_load_versions"), ["service_area", "year_month"], "version", "created_at", "2025-05-10 00:00:00")


def best_hours(spark: SparkSession, folder: str) -> DataFrame:
    """The three neighbouring three-hour blocks in which a taxi has most trips."""
    block = F.floor(F.hour("pickup_datetime") / 3)
    t = _trips(spark, folder).groupBy("taxi_id").agg(*(F.count_if(block == i).alias(f"b{i}") for i in range(8)))
    weights = F.array(*(F.col(f"b{i}") for i in range(8)))
    return t.select("taxi_id", aggregates.best_block(weights, 3).cast("int").alias("first_block"))


def all_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Version keys of two tables, each once."""
    key = ["service_area", "year_month", "version"]
    return aggregates.union_all([table(spark, folder, "gold").select(*key), table(spark, folder, "gold_load_versions").select(*key)]).distinct()


# Series


def month_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The days of the months that have snapshots."""
    months = table(spark, folder, "driver_snapshot").select("snapshot_month").distinct()
    return months.select("snapshot_month", F.explode(series.month_days(F.col("snapshot_month"))).alias("d")).select("snapshot_month", F.date_format("d", "yyyy-MM-dd").alias("day"))


def _weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Mean trips a day of each week (Monday to Sunday, within the usable days), at the middle day of the week. Weeks without trips are gaps."""
    since = lambda d: F.datediff(d, F.lit("2025-01-01").cast("date"))
    monday = since(F.date_trunc("week", "day").cast("date"))
    first = F.greatest(monday, since(F.lit(USABLE_FROM).cast("date")))
    last = F.least(monday + 6, since(F.lit(USABLE_TO).cast("date")) - 1)
    t = _trips(spark, folder).groupBy(first.alias("first"), last.alias("last")).agg(F.count("*").alias("n"))
    return t.select(F.floor((F.col("first") + F.col("last")) / 2).cast("int").alias("at"), (F.col("n") / (F.col("last") - F.col("first") + 1)).alias("value"))


def daily_from_weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Daily values between the means of all weeks, constant beyond them."""
    grid = spark.range(31, 151).select(F.col("id").cast("int").alias("at"))
    return series.interpolate(_weekly(spark, folder), grid, "at", "value").select("at", F.round("value", 6).alias("value"), "kind")


def monthly_fees(spark: SparkSession, folder: str) -> DataFrame:
    """The mean fee of a maker for each month of half a year, missing months between their neighbours."""
    month = (F.substring("snapshot_month", 1, 4).cast("int") * 12 + F.substring("snapshot_month", 6, 2).cast("int") - 1).cast("int")
    d = _drivers(spark, folder).where("weekly_lease_fee is not null and not isnan(weekly_lease_fee) and manufacturer is not null")
    points = d.groupBy("manufacturer", month.alias("at")).agg((F.sum(F.round(F.col("weekly_lease_fee") * 100).cast("bigint")) / F.count("*")).alias("fee"))
    grid = points.select("manufacturer").distinct().select("manufacturer", F.explode(F.sequence(F.lit(24300), F.lit(24306))).alias("at"))
    return series.interpolate(points, grid, "at", "fee", ["manufacturer"]).select("manufacturer", "at", F.round("fee", 3).alias("fee"), "kind")


def daily_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of all zones and documents of each day side by side, and whether both have the day."""
    a = _trips(spark, folder).groupBy("day").agg(F.count("*").alias("trips"))
    b = table(spark, folder, "documents").where("published_on is not null").groupBy(F.col("published_on").alias("day")).agg(F.count("*").alias("documents"))
    merged = series.merge_daily(a, b, series.calendar(spark, "2025-01-25", "2025-06-05"), "day")
    return merged.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "trips", "documents", "complete")


def stale_taxis(spark: SparkSession, folder: str) -> DataFrame:
    """Days since a taxi's last trip before a day."""
    return series.staleness(_trips(spark, folder).select("taxi_id", "day"), ["taxi_id"], "day", AS_OF, 7).select("taxi_id", F.date_format("last", "yyyy-MM-dd").alias("last"), "days", "stale")


def decayed_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Daily trips of a borough with memory: 0.8 of yesterday's state plus today's trips."""
    zones = table(spark, folder, "zone_lookup").select(F.col("LocationID").cast("int").alias("PULocationID"), "Borough")
    t = _trips(spark, folder).join(F.broadcast(zones), "PULocationID").groupBy("Borough", F.datediff("day", F.lit("2025-02-01").cast("date")).alias("at")).agg(F.count("*").alias("n"))
    return series.decayed(t, ["Borough"], "at", "n", 0.8).select("Borough", "at", F.round("state", 4).alias("state"))


# State, assignment, allocation


def folded_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users after all their events: sign-up opens, an error closes, a click changes the value."""
    e = table(spark, folder, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "v": F.col("value").cast("string")})
    s = events.fold_events(e, "user_id", "ts", "event_type", "v", "signup", "error", "click")
    return s.select("user_id", stamp(seconds(F.col("opened_at"))).alias("opened_at"), stamp(seconds(F.col("closed_at"))).alias("closed_at"), F.round(F.col("v").cast("double"), 4).alias("value"), stamp(seconds(F.col("since"))).alias("since"))


def rebuilt_states(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots turned into an event log and folded again."""
    last = aggregates.latest(_drivers(spark, folder), ["driver_id"], "snapshot_month").groupBy("driver_id").agg(*(F.max(c).alias(c) for c in ("taxi_id", "join_date", "exit_date", "vehicle_since")))
    log = events.state_to_events(last, "driver_id", "taxi_id", "join_date", "exit_date", "vehicle_since")
    s = events.fold_events(log, "driver_id", "at", "kind", "value", "open", "close", "change")
    return s.select("driver_id", F.date_format("opened_at", "yyyy-MM-dd").alias("opened"), F.date_format("closed_at", "yyyy-MM-dd").alias("closed"), "value", F.date_format("since", "yyyy-MM-dd").alias("since"))


def _requests(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """What each driver of a snapshot month would rather drive: newer models of at most the same fee, then the own one; and, for each month, the units free:
    the stock less the distinct drivers of that month who hold one. Items are models of a month, so that each month has its own units."""
    models = table(spark, folder, "inventory").select(F.col("vehicle_model_id").alias("item"), F.col("weekly_lease_fee").alias("fee"), "model_year", "stock")
    every = _drivers(spark, folder)
    d = every.where("weekly_lease_fee is not null and not isnan(weekly_lease_fee)").groupBy("snapshot_month", "driver_id").agg(F.min("vehicle_model_id").alias("model"), F.min("weekly_lease_fee").alias("own_fee"), F.min("experience_years").alias("years"))
    c = d.join(F.broadcast(models), (F.col("item") == F.col("model")) | (F.col("fee") <= F.col("own_fee"))).withColumn("own", F.col("item") == F.col("model"))
    ranked = allocation.preference_ranks(c, ["snapshot_month", "driver_id"], [F.desc("model_year"), F.asc("fee"), F.asc("item")])
    held = every.groupBy("snapshot_month", F.col("vehicle_model_id").alias("item")).agg(F.count_distinct("driver_id").alias("held"))
    months = every.select("snapshot_month").distinct()
    free = months.crossJoin(F.broadcast(models)).join(held, ["snapshot_month", "item"], "left").select("snapshot_month", "item", F.greatest(F.col("stock") - F.coalesce("held", F.lit(0)), F.lit(0)).alias("free"))
    return ranked, free


def accepted_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Immediate acceptance of requests in each month while units last, longer experience first."""
    ranked, stock = _requests(spark, folder)
    given = allocation.immediate_acceptance(ranked, ["snapshot_month", "driver_id"], "item", "own", [F.desc("years"), F.asc("driver_id")], stock, ["snapshot_month"])
    return given.select("snapshot_month", "driver_id", "item", "rank", "own")


def single_pass_requests(spark: SparkSession, folder: str) -> DataFrame:
    """In each month the best of the items for which a driver is among the first by experience."""
    ranked, stock = _requests(spark, folder)
    given = allocation.single_pass(ranked, ["snapshot_month", "driver_id"], "item", "own", [F.desc("years"), F.asc("driver_id")], stock, ["snapshot_month"])
    return given.select("snapshot_month", "driver_id", "item", "rank", "own")


SAVINGS = [0, 25, 50, 100, 200]


def _sweep(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The requests again for each of a list of least savings a week: below it a model is none for the driver. Greater savings first."""
    ranked, stock = _requests(spark, folder)
    steps = spark.createDataFrame([(x,) for x in SAVINGS], "least int")
    c = ranked.drop("rank").withColumn("saving", F.col("own_fee") - F.col("fee")).join(F.broadcast(steps), F.col("own") | (F.col("saving") >= F.col("least")))
    order = [F.desc("saving"), F.desc("own"), F.asc("item")]
    return allocation.preference_ranks(c, ["snapshot_month", "least", "driver_id"], order), stock


def savings_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """Immediate acceptance for each month and least saving, independently: who gets what."""
    ranked, stock = _sweep(spark, folder)
    key = ["snapshot_month", "least", "driver_id"]
    given = allocation.immediate_acceptance(ranked, key, "item", "own", [F.desc("saving"), F.asc("driver_id")], stock, ["snapshot_month", "least"])
    return given.select(*key, "item", "rank", "own")


def sweep_grain(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for each month and least saving: a row a driver, as many as before, no model given more often than it was free, no loss."""
    ranked, stock = _sweep(spark, folder)
    by = ["snapshot_month", "least"]
    given = allocation.immediate_acceptance(ranked, [*by, "driver_id"], "item", "own", [F.desc("saving"), F.asc("driver_id")], stock, by)
    asking = ranked.groupBy(*by).agg(F.count_distinct("driver_id").alias("asking"), F.count_distinct("driver_id", "item").alias("grain"), F.count("*").alias("rows"))
    most = given.where("not own").groupBy(*by, "item").agg(F.count("*").alias("n")).join(stock, ["snapshot_month", "item"], "left").where("free is null or n > free").groupBy(*by).agg(F.count("*").alias("over"))
    got = given.groupBy(*by).agg(F.count("*").alias("given"), F.count_distinct("driver_id").alias("drivers"), F.min("saving").alias("least_saving"))
    return asking.join(got, by, "left").join(most, by, "left").select(
        *by, "asking", "given", (F.col("grain") == F.col("rows")).alias("one_row_a_choice"), (F.col("given") == F.col("drivers")).alias("one_row_a_driver"), F.coalesce("over", F.lit(0)).alias("over"), (F.col("least_saving") >= 0).alias("no_loss")
    )


def _usable_jobs(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "attribution").where("pickup_datetime is not null and dropoff_datetime > pickup_datetime")
    # Rows of one key are equal, so the columns needed tell them apart as well as all.
    return a.select("service_date", F.col("trip_key").alias("job"), seconds(F.col("pickup_datetime")).alias("start"), seconds(F.col("dropoff_datetime")).alias("end"), F.col("PULocationID").alias("origin"), F.col("DOLocationID").alias("target")).distinct()


def bucketed_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of a day with the drivers of their bucket: pairs per bucket and day. Drivers are dealt in turn to as many buckets as there are fours of them; a trip without drivers stays, with a null one."""
    d = _drivers(spark, folder).select(F.col("driver_id").alias("agent")).where("agent is not null").distinct()
    pairs = joins.bucketed_pairs(_usable_jobs(spark, folder), d, "job", "agent", 4)
    return pairs.groupBy("bucket", F.date_format("service_date", "yyyy-MM-dd").alias("day")).agg(F.count("agent").alias("pairs"), F.count_distinct("job").alias("jobs"))


#: What the score of a candidate is made of.
WEIGHTS = {"hour": 0.35, "length": 0.3, "core": 0.15, "field": 0.2}


def _agents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per driver: contract, vehicle, minutes of work a day by experience, and preferences drawn from the id alone: weekdays, three-hour blocks with weights, length of trips, zones."""
    d = _drivers(spark, folder).where("driver_id is not null").groupBy("driver_id").agg(
        F.min("join_date").alias("since"), F.max("exit_date").alias("until"), F.min("taxi_id").alias("vehicle"), F.bool_or("comfort_eligible").alias("comfort"), F.max("experience_years").alias("years")
    )
    seed = seed_of(F.col("driver_id"))
    free = F.expr("127 & ~(shiftleft(1, cast(seed % 7 as int)) | shiftleft(1, cast(seed div 7 % 7 as int)))")
    return d.withColumn("seed", seed).select(
        F.col("driver_id").alias("agent"), "since", "until", "vehicle", "comfort", free.alias("weekdays"), F.expr("cast(seed div 49 % 256 as int) | 60").alias("blocks"),
        F.expr("transform(sequence(0, 7), b -> (shiftright(seed, b * 4) & 15) / 15D)").alias("hours"), F.expr("10 + seed % 31").alias("length"), F.expr("seed div 1000 % 101 / 100D").alias("core"), F.expr("seed div 100000 % 101 / 100D").alias("field"),
        (240 + 60 * F.least(F.greatest(F.coalesce("years", F.lit(0)), F.lit(0)), F.lit(6))).cast("double").alias("work"),
    )


def _offers(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with the drivers of their bucket that have a contract on the day, may take the trip and work at that time, best first."""
    zones = table(spark, folder, "zone_lookup").select(F.col("LocationID").cast("int").alias("target"), (F.col("service_zone") == "Core").alias("to_core"), (F.col("service_zone") == "Airfield").alias("to_field"))
    jobs = _usable_jobs(spark, folder).join(F.broadcast(zones), "target", "left")
    at = F.timestamp_seconds("start")
    jobs = jobs.withColumns({"weekday": F.pmod(F.dayofweek(at) + 5, F.lit(7)), "block": F.floor(F.hour(at) / 3).cast("int"), "minutes": (F.col("end") - F.col("start")) / 60})
    bit = lambda mask, i: (F.try_divide(mask, F.pow(F.lit(2), i)).cast("int") % 2) == 1
    rules = {
        "roster": lambda a: joins.valid_at(F.col("service_date"), a["since"], a["until"]),
        "grade": lambda a: a["comfort"] | ~F.coalesce("to_field", F.lit(False)),
        "hours": lambda a: bit(a["weekdays"], F.col("weekday")) & bit(a["blocks"], F.col("block")),
    }
    liked = lambda yes, p: F.when(F.coalesce(yes, F.lit(False)), p).otherwise(1 - p)
    score = lambda a: (
        WEIGHTS["hour"] * F.element_at(a["hours"], F.col("block") + 1)
        + WEIGHTS["length"] * F.greatest(F.lit(0.0), 1 - F.abs(F.col("minutes") - a["length"]) / a["length"])
        + WEIGHTS["core"] * liked(F.col("to_core"), a["core"])
        + WEIGHTS["field"] * liked(F.col("to_field"), a["field"])
    )
    return candidates.job_candidates(jobs, _agents(spark, folder), "job", "agent", 4, rules, lambda a: F.round(score(a), 9))


def candidate_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Per day how many drivers were looked at, refused by each rule, and left."""
    sums = {"looked_at": "offered", "roster": "roster", "grade": "grade", "hours": "hours"}
    return _offers(spark, folder).groupBy(F.date_format("service_date", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("jobs"), *(F.sum(c).alias(n) for n, c in sums.items()), F.sum(F.size("candidates")).alias("candidates"))


def candidate_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The best candidate of each trip with its score."""
    best = F.get("candidates", F.lit(0))
    return _offers(spark, folder).where(F.size("candidates") > 0).select("job", "bucket", best["agent"].alias("agent"), best["score"].alias("score"))


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    travel = zone_minutes(spark, folder).select(F.col("PULocationID").alias("origin"), F.col("DOLocationID").alias("target"), "minutes")
    return assignment.greedy_assignment(_offers(spark, folder), travel, ["bucket", "service_date"])


def greedy_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips given to drivers one after the other."""
    return _assigned(spark, folder).select("job", "agent", "sequence", F.round("way_minutes", 4).alias("way_minutes"), "offers")


def greedy_refusals(spark: SparkSession, folder: str) -> DataFrame:
    """One row: trips, those given away, offers, and refusals by reason."""
    return _assigned(spark, folder).agg(F.count("*").alias("jobs"), F.count("agent").alias("given"), F.sum("offers").alias("offers"), *(F.sum(r).alias(r) for r in assignment.REASONS))


def assignment_contract(spark: SparkSession, folder: str) -> DataFrame:
    """What is wrong with the trips and ways given to the assignment, by condition."""
    travel = zone_minutes(spark, folder).select(F.col("PULocationID").alias("origin"), F.col("DOLocationID").alias("target"), "minutes")
    a = table(spark, folder, "attribution")
    jobs = a.select("service_date", F.col("trip_key").alias("job"), seconds(F.col("pickup_datetime")).alias("start"), seconds(F.col("dropoff_datetime")).alias("end"), F.col("PULocationID").alias("origin"), F.col("DOLocationID").alias("target"), F.array(F.struct(clean_id(F.col("driver_id")).alias("agent"))).alias("candidates"))
    return assignment.assignment_contract(jobs, travel, ["service_date"])


def attribution_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage, waits and minutes of attribution per day."""
    a = table(spark, folder, "attribution").distinct()
    minutes = (seconds(F.col("dropoff_datetime")) - seconds(F.col("pickup_datetime")))
    wait = F.when(finite(F.col("deadhead_minutes")), F.round(F.col("deadhead_minutes") * 10).cast("bigint"))
    return a.groupBy(F.date_format("service_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("trips"), F.count(clean_id(F.col("driver_id"))).alias("assigned"), F.count_distinct(clean_id(F.col("driver_id"))).alias("drivers"),
        F.sum(F.when(minutes > 0, minutes)).alias("drive_s"), F.sum(wait).alias("wait_tenths"), F.count_if(series.clipped(F.col("deadhead_minutes"), 0.0, 20.0) != F.col("deadhead_minutes")).alias("clipped"),
    )


def required_values(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls in the columns a snapshot must have."""
    return quality.null_contract(table(spark, folder, "driver_snapshot"), ["driver_id", "taxi_id", "fuel_type", "exit_date", "join_date"])


def snapshot_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers of a snapshot: all, those gone by its end, those left."""
    d = _drivers(spark, folder).groupBy("snapshot_month", "driver_id").agg(F.max("exit_date").alias("exit_date"))
    gone = F.col("exit_date") <= F.last_day(F.to_date(F.concat("snapshot_month", F.lit("-01"))))
    return d.groupBy("snapshot_month").agg(F.count("*").alias("total"), F.count_if(F.coalesce(gone, F.lit(False))).alias("gone")).withColumn("left", F.col("total") - F.col("gone"))


def trip_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A key for every delivered trip: its columns and the number of the occurrence."""
    same = ["taxi_id", "PULocationID", "DOLocationID", "trip_time"]
    t = aggregates.occurrence(_trips(spark, folder).select(*same, "pickup_datetime"), [*same, "pickup_datetime"], ["pickup_datetime"])
    t = t.withColumn("at", stamp(seconds(F.col("pickup_datetime"))))
    return t.select(natural_key([*same, "at"], F.col("occurrence")).alias("trip_key"), "taxi_id", "occurrence")


def day_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of a borough's day against the interpolated weekly level of that day: a join on a derived date."""
    level = series.interpolate(_weekly(spark, folder), spark.range(31, 151).select(F.col("id").cast("int").alias("at")), "at", "value").select("at", "value")
    t = _trips(spark, folder).groupBy(F.datediff("day", F.lit("2025-01-01").cast("date")).alias("at")).agg(F.count("*").alias("trips"))
    return t.join(level, "at").select("at", "trips", F.round(F.col("trips") / F.col("value"), 6).alias("ratio"))


def overbooked_models(spark: SparkSession, folder: str) -> DataFrame:
    """Models of a snapshot that the inventory lacks or that more drivers have than it has units."""
    used = _drivers(spark, folder).groupBy("snapshot_month", F.col("vehicle_model_id").alias("model")).agg(F.count_distinct("driver_id").alias("used"))
    stock = table(spark, folder, "inventory").select(F.col("vehicle_model_id").alias("model"), "stock")
    return used.join(F.broadcast(stock), "model", "left").where(F.col("stock").isNull() | (F.col("used") > F.col("stock")))


def filled_fees(spark: SparkSession, folder: str) -> DataFrame:
    """A driver's fee of each month, carried forward where it is missing."""
    fee = F.when(finite(F.col("weekly_lease_fee")), F.round(F.col("weekly_lease_fee") * 100).cast("bigint"))
    d = _drivers(spark, folder).groupBy("driver_id", "snapshot_month").agg(F.max(fee).alias("fee_cents"))
    return series.forward_fill(d, ["driver_id"], "snapshot_month", ["fee_cents"])


def driver_traits(spark: SparkSession, folder: str) -> DataFrame:
    """Random traits per driver, the same in every run."""
    return draws.seeded_traits(_drivers(spark, folder).select("driver_id").distinct(), "driver_id")


def favourite_zones(spark: SparkSession, folder: str) -> DataFrame:
    """The zones in which at least a fifth of a taxi's trips start."""
    found = aggregates.top_shares(_trips(spark, folder), ["taxi_id"], "PULocationID", 0.2)
    return found.select("taxi_id", "PULocationID", "n", F.round("share", 6).alias("share"))


def driver_experience(spark: SparkSession, folder: str) -> DataFrame:
    """Whole years since joining, and months of a vehicle, at the end of each snapshot month."""
    end = F.last_day(F.to_date(F.concat("snapshot_month", F.lit("-01"))))
    d = _drivers(spark, folder).where(F.col("join_date") <= end).select("snapshot_month", "driver_id", F.floor(F.datediff(end, F.col("join_date")) / 365.25).alias("years"))
    return d.groupBy("snapshot_month", "years").agg(F.count_distinct("driver_id").alias("drivers"))


def model_flags(spark: SparkSession, folder: str) -> DataFrame:
    """What any snapshot says a model may do, next to the inventory."""
    seen = _drivers(spark, folder).groupBy("vehicle_model_id").agg(F.bool_or("comfort_eligible").alias("seen_comfort"), F.bool_or("extra_comfort_eligible").alias("seen_extra"))
    i = table(spark, folder, "inventory").select("vehicle_model_id", "comfort_eligible", "extra_comfort_eligible")
    return i.join(seen, "vehicle_model_id", "left")


QUERIES = {
    f.__name__: f
    for f in (
        trip_rule_counts, trip_reject_reasons, trip_gate, unusable_numbers, month_mismatch, taxi_weekdays, active_drivers, comparable_names, price_mentions, stripped_lengths, product_years,
        model_profiles, unknown_taxis, zone_pairs, attributed_trips, vehicle_matches, asof_snapshot, versions_without_load, busy_zones, model_variants, cheaper_models, profit_thresholds,
        driver_month_totals, tier_rates, totals_kept, trip_key_counts, repeated_trips, zone_minutes, fleet_by_model, maker_ranges, first_taxi, snapshot_kpis, top_zones, top_makers, profit_histogram,
        working_capacity, shared_units, numbered_units, snapshot_grain, best_attributions, occurrences, dear_trips, newest_version, expired, best_hours, all_versions, month_calendar,
        daily_from_weekly, monthly_fees, daily_completeness, stale_taxis, decayed_activity, folded_users, rebuilt_states, accepted_requests, single_pass_requests, savings_sweep, sweep_grain, bucketed_candidates, candidate_rules, candidate_scores, greedy_trips, greedy_refusals, assignment_contract,
        attribution_quality, required_values, snapshot_balance, trip_keys, day_loads, overbooked_models, filled_fees, driver_traits, favourite_zones, driver_experience, model_flags,
    )
}
