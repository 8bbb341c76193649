"""Queries over cleaning rules, contracts of tables, reference data and derived views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.columns import before_last, cents, clean_id, finite, json_key, money, percent, seconds, seed_of, unusable, uuid5
from fareloom.operators import aggregates, draws, joins, quality, series
from fareloom.plans import catalog
from fareloom.plans.catalog import AS_OF, TIERS, _drivers, _gold, _trips
from fareloom.sources import readers
from fareloom.sources.tables import table

#: Tiers that each licence may drive.
LICENCE_TIERS = {"HV0003": ["Standard", "Comfort"], "HV0005": ["Standard", "Extra Comfort"]}
REQUIRED = ["taxi_id", "hvfhs_license_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles", "trip_time", "driver_pay", "tips", "estimated_service_tier"]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def _clean_rules() -> dict[str, Column]:
    """What a trip must keep to enter the next layer: values present, values within bounds, a tier its licence may drive."""
    present = _all([*(F.col(c).isNotNull() for c in REQUIRED), *(F.trim(F.col(c)) != "" for c in ("taxi_id", "hvfhs_license_num", "estimated_service_tier"))])
    between = lambda c, low, high: finite(F.col(c)) & F.col(c).between(low, high)
    value = _all([F.col("pickup_datetime") < F.col("dropoff_datetime"), between("trip_miles", 0, 1000) & (F.col("trip_miles") > 0), F.col("trip_time").between(1, 86_400), between("driver_pay", 0, 5000), between("tips", 0, 5000)])
    tier = F.lit(False)
    for licence, tiers in LICENCE_TIERS.items():
        tier = tier | ((F.col("hvfhs_license_num") == licence) & F.col("estimated_service_tier").isin(tiers))
    return {"missing_or_type": present, "value": value, "service_tier": tier}


def clean_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Per month trips that keep all cleaning rules, projected to the columns and types of the next layer, and their pay."""
    schema = T.StructType([T.StructField("taxi_id", T.StringType()), T.StructField("trip_time", T.IntegerType()), T.StructField("driver_pay", T.DoubleType()), T.StructField("year_month", T.StringType())])
    good, _ = quality.split_valid(table(spark, folder, "monthly_taxi_trip"), _clean_rules())
    return quality.project(good, schema).groupBy("year_month").agg(F.count("*").alias("n"), F.sum("trip_time").alias("seconds"), F.sum(cents(F.col("driver_pay"))).alias("pay_cents"))


def clean_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Per load the rows, those kept, and those that break each cleaning rule."""
    return quality.rule_counts(table(spark, folder, "monthly_taxi_trip"), _clean_rules(), ["load_id"])


def trip_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Per load the rows delivered against the kept and the rejected ones, each counted from its own frame."""
    t = table(spark, folder, "monthly_taxi_trip")
    good, bad = quality.split_valid(t, _clean_rules())
    return quality.reconciled(t, {"kept": good, "rejected": bad}, ["load_id"])


def trip_suite(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of each load with the share of rows that must hold them."""
    checks = {"in_month": (F.date_format("pickup_datetime", "yyyy-MM") == F.col("year_month"), 0.9), "known_tier": (F.col("estimated_service_tier").isin(TIERS), 0.97), "record": (_all(list(_clean_rules().values())), 0.9), "has_load": (F.col("load_id").isNotNull(), 1.0)}
    return quality.suite(table(spark, folder, "monthly_taxi_trip"), checks, ["load_id"])


def placed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Per month trips with both zones known to the lookup and pay within bounds, with and without a taxi."""
    zones = table(spark, folder, "zone_lookup").where("Borough <> 'Unknown'").select(F.col("LocationID").cast("int").alias("zone"))
    t = table(spark, folder, "monthly_taxi_trip").where(finite(F.col("driver_pay")) & F.col("driver_pay").between(0, 5000))
    both = t.join(zones.withColumnRenamed("zone", "PULocationID"), "PULocationID", "left_semi").join(zones.withColumnRenamed("zone", "DOLocationID"), "DOLocationID", "left_semi")
    return both.groupBy("year_month").agg(F.count("*").alias("n"), F.count_if(clean_id(F.col("taxi_id")).isNull()).alias("without_taxi"))


def cast_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Zones whose texts can't be read as the types asked for."""
    z = table(spark, folder, "zone_lookup")
    failed = quality.failed_casts(z, T.StructType([T.StructField("LocationID", T.IntegerType()), T.StructField("Borough", T.DoubleType()), T.StructField("service_zone", T.StringType())]))
    return z.agg(*(F.count_if(c).alias(n) for n, c in failed.items()))


def natural_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Trips beyond the first with the same natural key, against a bound of 5 %."""
    key = ["taxi_id", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles", "trip_time", "driver_pay", "tips"]
    return quality.key_collisions(table(spark, folder, "monthly_taxi_trip"), key, 0.05).select("rows", "keys", "collisions", F.round("ratio", 9).alias("ratio"), "verdict")


def skip_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts in documents that can't be used: skipped up to 1 % of them, beyond that the source fails (strictly)."""
    p = catalog.price_mentions(spark, folder).join(table(spark, folder, "documents").select("doc_id", "source"), "doc_id")
    counts = p.groupBy("source").agg(F.count("*").alias("total"), F.count_if("out_of_bounds").alias("invalid"))
    return quality.gate(counts, 0.0, 0.01, inclusive=False).select("source", "total", "invalid", F.when(F.col("verdict") == "fail", "fail").otherwise("skip").alias("verdict"))


def inventory_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Every broken rule of every model: all are known before anything fails."""
    positive = lambda c: finite(F.col(c)) & (F.col(c) > 0)
    rules = {"id": clean_id(F.col("vehicle_model_id")).isNotNull(), "year": F.col("model_year").between(2019, 2100), "fee": positive("weekly_lease_fee"), "efficiency": positive("fuel_efficiency"), "stock": F.col("stock") >= 10, "image": F.col("image_url").isNotNull()}
    return quality.errors(table(spark, folder, "inventory"), rules, ["vehicle_model_id"])


def dimension_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Per month: drivers that occur twice or are nameless, models unknown to the inventory or held more often than there are, fees that can't be."""
    d = table(spark, folder, "driver_snapshot").withColumns({"driver_id": clean_id(F.col("driver_id")), "model": clean_id(F.col("vehicle_model_id"))}).distinct()
    per = d.groupBy("snapshot_month", "driver_id").agg(F.count("*").alias("n"))
    keys = per.groupBy("snapshot_month").agg(F.coalesce(F.sum(F.when(F.col("driver_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"), F.count_if((F.col("n") > 1) & F.col("driver_id").isNotNull()).alias("repeated"))
    stock = table(spark, folder, "inventory").select(F.col("vehicle_model_id").alias("model"), "stock")
    held = d.groupBy("snapshot_month", "model").agg(F.count_distinct("driver_id").alias("held")).join(stock, "model", "left")
    models = held.groupBy("snapshot_month").agg(F.count_if(F.col("stock").isNull()).alias("unknown_models"), F.count_if(F.col("held") > F.col("stock")).alias("overbooked"))
    fees = d.groupBy("snapshot_month").agg(F.count_if(unusable(F.col("weekly_lease_fee")) | (F.col("weekly_lease_fee") <= 0)).alias("bad_fees"))
    return keys.join(models, "snapshot_month").join(fees, "snapshot_month")


def column_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, blank texts and NaN of every column of the driver snapshot."""
    df = table(spark, folder, "driver_snapshot")
    return quality.empty_values(df, df.columns)


def snapshot_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Per month: drivers in all, gone ones left out, those that keep the rules, and drivers that remain more than once."""
    d = _drivers(spark, folder)
    stays = d.where("exit_date is null")
    rules = {"ids": F.col("driver_id").isNotNull() & F.col("taxi_id").isNotNull(), "fee": finite(F.col("weekly_lease_fee")) & (F.col("weekly_lease_fee") > 0), "fuel": F.col("fuel_type").isNotNull()}
    good, _ = quality.split_valid(stays, rules)
    twice = good.groupBy("snapshot_month", "driver_id").count().where("count > 1").groupBy("snapshot_month").agg(F.count("*").alias("repeated"))
    counts = quality.reconciled(d, {"stay": stays, "gone": d.where("exit_date is not null")}, ["snapshot_month"]).join(good.groupBy("snapshot_month").agg(F.count("*").alias("good")), "snapshot_month", "left")
    return counts.join(twice, "snapshot_month", "left").select("snapshot_month", "total", "stay", "gone", "balanced", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("repeated", F.lit(0)).alias("repeated"))


def contract_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Per month: taxis with several drivers at once, and drivers that the trips of the month don't know."""
    d = _drivers(spark, folder).select("snapshot_month", "driver_id", "taxi_id", "exit_date").distinct()
    active = d.where("exit_date is null").groupBy("snapshot_month", "taxi_id").agg(F.count_distinct("driver_id").alias("n"))
    shared = active.groupBy("snapshot_month").agg(F.count("*").alias("taxis"), F.count_if(F.col("n") > 1).alias("shared"))
    seen = table(spark, folder, "attribution").select(F.date_format("service_date", "yyyy-MM").alias("snapshot_month"), clean_id(F.col("driver_id")).alias("driver_id")).where("driver_id is not null").distinct()
    idle = quality.unmatched(d, seen, ["snapshot_month", "driver_id"]).groupBy("snapshot_month").agg(F.count("*").alias("without_trips"))
    return shared.join(idle, "snapshot_month", "left").select("snapshot_month", "taxis", "shared", F.coalesce("without_trips", F.lit(0)).alias("without_trips"))


def one_date_each(spark: SparkSession, folder: str) -> DataFrame:
    """Whether all rows of a snapshot month were made on one day, and how old that was by a day."""
    d = table(spark, folder, "driver_snapshot").groupBy("snapshot_month").agg(F.count_distinct(F.to_date("snapshot_created_at")).alias("dates"), F.max(F.to_date("snapshot_created_at")).alias("last"))
    age = F.datediff(F.lit(AS_OF).cast("date"), F.col("last"))
    return d.select("snapshot_month", "dates", (F.col("dates") == 1).alias("one"), age.alias("age"), (age <= 45).alias("fresh"))


def agent_contract(spark: SparkSession, folder: str) -> DataFrame:
    """What the candidates' drivers must be: named once, with eight weights between 0 and 1, a mask of seven days and one of eight blocks."""
    a = catalog._agents(spark, folder)
    checks = {
        "named": F.col("agent").isNotNull(), "eight_weights": F.size("hours") == 8, "weights": F.forall("hours", lambda w: (w >= 0) & (w <= 1)), "weekdays": F.col("weekdays").between(1, 127), "blocks": F.col("blocks").between(1, 255), "work": F.col("work") > 0,
    }
    return quality.suite(a, {n: (c, 1.0) for n, c in checks.items()}).unionByName(a.groupBy("agent").count().agg(F.lit("unique").alias("check"), F.count("*").alias("total"), F.count_if(F.col("count") > 1).alias("failed")).withColumn("passed", F.col("failed") == 0))


def attribution_ceiling(spark: SparkSession, folder: str) -> DataFrame:
    """Per day: trips that could be given away, those that were, the drivers' minutes of work, and how far they were used."""
    a = table(spark, folder, "attribution").where("dropoff_datetime > pickup_datetime").distinct()
    took = seconds(F.col("dropoff_datetime")) - seconds(F.col("pickup_datetime"))
    who = clean_id(F.col("driver_id"))
    per = a.groupBy("service_date").agg(F.count("*").alias("trips"), F.count(who).alias("given"), F.count_distinct(who).alias("drivers"), F.sum(F.when(who.isNotNull(), took)).alias("used"))
    return per.select(F.date_format("service_date", "yyyy-MM-dd").alias("day"), "trips", "given", "drivers", F.round(F.col("given") / F.col("trips"), 6).alias("coverage"), F.round(F.col("used") / (F.col("drivers") * 36_000), 6).alias("saturation"))


# Views and reference data


def _rates(t: DataFrame) -> DataFrame:
    return aggregates.ratio_pivot(t, ["licence", "band"], "estimated_service_tier", TIERS, F.col("pay"), F.col("miles"))


def _banded(spark: SparkSession, folder: str) -> DataFrame:
    band = F.when(F.col("miles") < 200, "0-2").when(F.col("miles") < 500, "2-5").when(F.col("miles") < 1000, "5-10").when(F.col("miles") < 2000, "10-20").otherwise("20+")
    return _trips(spark, folder).where("miles > 0 and pay >= 0 and licence is not null").withColumn("band", band)


def tier_multipliers(spark: SparkSession, folder: str) -> DataFrame:
    """What the standard trips of a licence and band would pay at the rate of each other tier: rates as columns, joined back to the trips."""
    t = _banded(spark, folder)
    r = _rates(t).select("licence", "band", F.try_divide("comfort", "standard").alias("to_comfort"), F.try_divide("extra_comfort", "standard").alias("to_extra"))
    joined = t.where("estimated_service_tier = 'Standard'").groupBy("licence", "band", "pay").agg(F.count("*").alias("n")).join(r, ["licence", "band"], "left")
    scenario = lambda c: F.round(F.sum(F.col("pay") * F.col("n") * (1 + 0.3 * (F.coalesce(c, F.lit(1.0)) - 1))), 2)
    return joined.groupBy("licence", "band").agg(F.sum("n").alias("trips"), F.sum(F.col("pay") * F.col("n")).alias("pay_cents"), scenario("to_comfort").alias("as_comfort"), scenario("to_extra").alias("as_extra"))


def missing_multipliers(spark: SparkSession, folder: str) -> DataFrame:
    """Licences and bands with standard trips but without a usable rate of the tier that the licence could drive."""
    t = _banded(spark, folder)
    r = _rates(t).withColumn("standard_trips", F.col("standard").isNotNull())
    needed = F.when(F.col("licence") == "HV0003", F.try_divide("comfort", "standard")).when(F.col("licence") == "HV0005", F.try_divide("extra_comfort", "standard"))
    return r.where(F.col("standard_trips") & (needed.isNull() | unusable(needed))).select("licence", "band")


def driver_models(spark: SparkSession, folder: str) -> DataFrame:
    """Every driver of a month with every model (each month's drivers against the 36 models): the grain, and the models that are cheaper, dearer or the own one."""
    models = table(spark, folder, "inventory").select(F.col("vehicle_model_id").alias("item"), F.col("weekly_lease_fee").alias("fee"))
    d = _drivers(spark, folder).where(finite(F.col("weekly_lease_fee"))).groupBy("snapshot_month", "driver_id").agg(F.min("vehicle_model_id").alias("model"), F.min("weekly_lease_fee").alias("own"))
    c = d.crossJoin(F.broadcast(models))
    return c.groupBy("snapshot_month").agg(
        F.count("*").alias("rows"), F.count_distinct("driver_id", "item").alias("pairs"), F.count_if(F.col("item") == F.col("model")).alias("own"),
        F.count_if((F.col("item") != F.col("model")) & (F.col("fee") < F.col("own"))).alias("cheaper"), F.count_if((F.col("item") != F.col("model")) & (F.col("fee") >= F.col("own"))).alias("not_cheaper"),
    )


def _views(spark: SparkSession, folder: str) -> DataFrame:
    """Who was given what, beside what the newest aggregation says of the driver."""
    given = catalog.accepted_requests(spark, folder).select(F.col("snapshot_month").alias("year_month"), "driver_id", F.col("item").alias("given"), "own")
    now = aggregates.latest(_gold(spark, folder), ["service_area", "year_month"], "version").where(finite(F.col("monthly_net_profit")))
    now = now.groupBy("service_area", "year_month", "driver_id").agg(F.max("vehicle_model_id").alias("current"), F.max(cents(F.col("monthly_net_profit"))).alias("profit_cents"))
    return now.join(given, ["year_month", "driver_id"])


def suggested_models(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers with a suggestion other than their model, the present figures beside it."""
    return _views(spark, folder).where("not own").select("service_area", "year_month", "driver_id", "current", "given", "profit_cents")


def suggestion_gains(spark: SparkSession, folder: str) -> DataFrame:
    """Per area and month: suggestions, those that change the model, and efficiency before and after."""
    mpg = table(spark, folder, "inventory").select(F.col("vehicle_model_id").alias("m"), F.round(F.col("fuel_efficiency") * 10).cast("bigint").alias("e"))
    v = _views(spark, folder).join(mpg.select(F.col("m").alias("current"), F.col("e").alias("before")), "current", "left").join(mpg.select(F.col("m").alias("given"), F.col("e").alias("after")), "given", "left")
    verdict = F.when(F.col("after") > F.col("before"), "better").when(F.col("after") < F.col("before"), "worse").otherwise("same")
    return v.groupBy("service_area", "year_month", verdict.alias("verdict")).agg(F.count("*").alias("drivers"), F.count_if(~F.col("own")).alias("changed"), F.sum("before").alias("before"), F.sum("after").alias("after"))


def scoped_profit(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers of each area and month within a scope: the newest version, profit from a threshold on, pay above 0."""
    g = aggregates.latest(_gold(spark, folder), ["service_area", "year_month"], "version")
    scope = finite(F.col("monthly_net_profit")) & (F.col("monthly_net_profit") >= 1500) & (F.col("monthly_driver_pay") > 0)
    return g.where(scope).groupBy("service_area", "year_month").agg(F.count_distinct("driver_id").alias("drivers"))


def ordered_profits(spark: SparkSession, folder: str) -> DataFrame:
    """The drivers of the newest versions by profit, best first, numbered over all of them without one task that orders them all."""
    g = aggregates.latest(_gold(spark, folder), ["service_area", "year_month"], "version").where(finite(F.col("monthly_net_profit")) & F.col("driver_id").isNotNull())
    g = g.groupBy("service_area", "year_month", "driver_id").agg(F.max(cents(F.col("monthly_net_profit"))).alias("profit_cents"))
    keyed = g.withColumn("order", F.struct((-F.col("profit_cents")).alias("p"), "service_area", "year_month", "driver_id"))
    return joins.numbered(keyed, "order").select((F.col("number") + 1).alias("place"), "service_area", "year_month", "driver_id", "profit_cents")


def driver_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers numbered from 1 in the order of their ids."""
    d = _drivers(spark, folder).where("driver_id is not null").select("driver_id").distinct()
    return joins.numbered(d, "driver_id").select("driver_id", (F.col("number") + 1).alias("number"))


def capacity_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes a driver can work in each month: those of a day times the days on which the driver works."""
    days = catalog.month_calendar(spark, folder).select("snapshot_month", F.pmod(F.dayofweek(F.to_date("day")) + 5, F.lit(7)).alias("weekday")).groupBy("snapshot_month", "weekday").agg(F.count("*").alias("n"))
    a = catalog._agents(spark, folder).select("agent", "work", "weekdays")
    met = a.join(F.broadcast(days), F.try_divide("weekdays", F.pow(F.lit(2), F.col("weekday"))).cast("int") % 2 == 1)
    return met.groupBy(F.col("agent").alias("driver_id"), "snapshot_month").agg(F.sum("n").alias("days"), F.sum(F.col("n") * F.col("work")).alias("minutes"))


def lease_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """The fleet as snapshots show it: taxis per model, each once, with the middle of the efficiencies that the inventory gives for the model's name."""
    fleet = catalog.fleet_by_model(spark, folder).where("model is not null")
    names = table(spark, folder, "inventory").withColumn("e", F.round(F.col("fuel_efficiency") * 10).cast("bigint"))
    spans = names.groupBy("manufacturer", "model_name").agg(((F.min("e") + F.max("e")) / 2).alias("efficiency_tenths"))
    meta = names.select(F.col("vehicle_model_id").alias("model"), "manufacturer", "model_name", "fuel_type").distinct()
    return fleet.join(meta, "model", "left").join(spans, ["manufacturer", "model_name"], "left").select("snapshot_month", "model", "stock", "fuel_type", "efficiency_tenths")


def eligibility_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Models by what they may drive."""
    i = table(spark, folder, "inventory")
    group = F.when(F.col("comfort_eligible") & F.col("extra_comfort_eligible"), "BOTH").when(F.col("comfort_eligible") | F.col("extra_comfort_eligible"), "SINGLE").otherwise("STANDARD")
    return i.groupBy(group.alias("kind"), (F.col("model_year") >= 2023).alias("recent")).agg(F.count("*").alias("models"), F.sum("stock").alias("stock"))


def fuel_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Fuels of the snapshots by class; blank ones are petrol."""
    return table(spark, folder, "driver_snapshot").groupBy("fuel_type", readers.fuel_class(F.col("fuel_type")).alias("fuel")).agg(F.count("*").alias("n"))


def tier_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Spellings of tiers with their canonical name, null where it is unknown."""
    names = {"standard": "Standard", "comfort": "Comfort", "extra comfort": "Extra Comfort", "std": "Standard", "xl comfort": "Extra Comfort"}
    t = table(spark, folder, "monthly_taxi_trip").where("estimated_service_tier is not null")
    return t.groupBy(F.col("estimated_service_tier").alias("spelling")).agg(F.count("*").alias("n")).withColumn("tier", readers.alias(F.col("spelling"), names))


def model_years(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of four digits in the texts of documents, as years within bounds or not, per source."""
    d = table(spark, folder, "documents").where("text is not null").select("source", F.explode(F.filter(F.split("text", "[^0-9]+"), lambda x: F.length(x) == 4)).alias("y"))
    year, bad = readers.model_year(F.col("y"))
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count(year).alias("years"), F.count_if(bad).alias("bad"), F.min(year).alias("low"), F.max(year).alias("high"))


def eligibility_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A marked-up list of models, made from the inventory with foot notes and other lines between, read back into rows."""
    i = table(spark, folder, "inventory").select("manufacturer", "model_name", "model_year", "comfort_eligible")
    line = F.concat(F.lit("* **"), F.col("manufacturer"), F.lit("** "), F.col("model_name"), F.lit("<sup>1</sup> "), F.col("model_year"), F.when(F.col("comfort_eligible"), " (Standard, Comfort)").otherwise(" (Standard)"))
    page = i.groupBy("manufacturer").agg(F.concat_ws("\n", F.lit("# Models"), F.sort_array(F.collect_list(line))).alias("page"))
    rows = page.select(F.inline(readers.model_lines(F.concat("page", F.lit("\nNot a model 2020\n")))))
    return rows.select("make", "model", "year", F.explode("products").alias("product")).groupBy("make", "product").agg(F.count("*").alias("n"), F.min("year").alias("first"), F.count_distinct("model").alias("models"))


def card_links(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of cards, made from the inventory, read back: title, full address, fee."""
    i = table(spark, folder, "inventory").select("vehicle_model_id", "manufacturer", "model_name", "weekly_lease_fee")
    card = F.concat(F.lit('<div class="big card"><h3>'), F.col("manufacturer"), F.lit(" <b>"), F.col("model_name"), F.lit('</b></h3><a href="/cars/'), F.col("vehicle_model_id"), F.lit('">more</a> $'), F.col("weekly_lease_fee").cast("int"), F.lit(" a week</div><p>x</p>"))
    page = i.groupBy("manufacturer").agg(F.concat_ws("", F.sort_array(F.collect_list(card))).alias("page"))
    c = page.select(F.inline(readers.cards(F.col("page"), "card")))
    return c.select("title", readers.absolute(F.col("link"), "https://lease.test/list/all").alias("address"), F.regexp_extract("text", r"\$([0-9]+)", 1).cast("int").alias("fee"))


def spec_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Models of the inventory's makers against specifications: their exact name, else the name with a trim word; what has neither stays."""
    i = table(spark, folder, "inventory").select("manufacturer", "model_name").distinct()
    trims = ["AWD", "XL", "HYBRID"]
    bare = i.select("manufacturer", F.regexp_replace("model_name", f" ({'|'.join(trims)})$", "").alias("model_name")).unionByName(i.select("manufacturer", F.concat("model_name", F.lit(" ZZ")).alias("model_name"))).distinct()
    specs = table(spark, folder, "inventory").select("manufacturer", "model_name", "fuel_type", F.round(F.col("fuel_efficiency") * 10).cast("bigint").alias("e"))
    m = joins.two_tier_match(bare, specs, "manufacturer", "model_name", trims)
    return m.groupBy("manufacturer", "model_name", "tier").agg(F.count("spec_e").alias("trims"), F.min("spec_e").alias("low"), F.max("spec_e").alias("high"), aggregates.one_or_mixed(F.col("spec_fuel_type")).alias("fuel"))


# Series, versions, keys


def month_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Documents published within each snapshot month."""
    months = _drivers(spark, folder).select("snapshot_month").distinct()
    d = table(spark, folder, "documents").where("published_on is not null").withColumn("m", F.date_format("published_on", "yyyy-MM"))
    return months.join(d, F.col("m") == F.col("snapshot_month"), "left").groupBy("snapshot_month").agg(F.count("doc_id").alias("n"), F.count_if(series.in_month(F.col("published_on"), F.col("snapshot_month"))).alias("within"))


def daily_fees(spark: SparkSession, folder: str) -> DataFrame:
    """A maker's fee of the month on each of its days, a seventh of it with a markup."""
    at = F.col("at").cast("int")
    month = F.concat_ws("-", F.lpad((F.floor(at / 12)).cast("string"), 4, "0"), F.lpad((at % 12 + 1).cast("string"), 2, "0"))
    m = catalog.monthly_fees(spark, folder).withColumn("month", month).withColumn("daily", F.round(F.col("fee") / 700 * 1.1, 6))
    return series.spread_months(m, "month", ["daily", "kind"], ["manufacturer"]).select("manufacturer", F.date_format("day", "yyyy-MM-dd").alias("day"), "daily", "kind")


def daily_statuses(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a series of mean pay per mile: missing, repeated, outside its bounds, or fine."""
    t = _trips(spark, folder).where("miles > 0 and pay >= 0").groupBy("day", F.when(F.col("PULocationID") > 100, 1).otherwise(0).alias("half")).agg((F.sum("pay") / F.sum("miles")).alias("rate"))
    some = t.where("half = 0 or dayofmonth(day) % 5 = 0").where("dayofmonth(day) <> 13")
    return series.daily_status(some, series.calendar(spark, "2025-02-01", "2025-05-31"), "day", "rate", 0.05, 15.0).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "status")


def area_states(spark: SparkSession, folder: str) -> DataFrame:
    """The state of each service area of the snapshots; an area that the list lacks has none."""
    states = {"nyc": "NY", "li_east": "NY", "boston": "MA"}
    g = table(spark, folder, "gold").groupBy("service_area").agg(F.count("*").alias("n"))
    return g.withColumn("state", readers.alias(F.col("service_area"), states))


def noise_chain(spark: SparkSession, folder: str) -> DataFrame:
    """A driver's noise of each month: 0.6 of the last, a shock drawn from id and month, and a season; clipped."""
    d = _drivers(spark, folder).where("driver_id is not null").select("driver_id", "snapshot_month").distinct()
    at = (F.substring("snapshot_month", 1, 4).cast("int") * 12 + F.substring("snapshot_month", 6, 2).cast("int") - 1).cast("int")
    shock = (seed_of(F.col("driver_id"), F.col("snapshot_month")) % 2001 - 1000) / 1000
    season = F.when(F.substring("snapshot_month", 6, 2).isin("12", "01", "02"), 0.2).otherwise(-0.05)
    chain = series.decayed(d.select("driver_id", at.alias("at"), (shock + season).alias("v")), ["driver_id"], "at", "v", 0.6)
    level = 1 + F.col("state") * 0.5
    return chain.select("driver_id", "at", F.round(series.clipped(level, 0.3, 2.0), 6).alias("level"), ((level < 0.3) | (level > 2.0)).alias("clipped"))


def area_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    """Per area the newest month that was loaded and when last; loading an older month doesn't advance it."""
    return series.watermark(table(spark, folder, "gold_load_versions"), ["service_area"], "year_month", "created_at", "2025-07-15", 31).select("service_area", "year_month", F.date_format("last", "yyyy-MM-dd").alias("last"), "days", "stale")


def target_months(spark: SparkSession, folder: str) -> DataFrame:
    """Per area the month to work on by a limit: the latest loaded one not after it, and the month whose prices are known then."""
    g = table(spark, folder, "gold_load_versions")
    month = F.max(F.when(F.col("year_month") <= "2025-04", F.col("year_month")))
    return g.groupBy("service_area").agg(month.alias("month")).withColumn("prices", F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), -2), "yyyy-MM"))


def refreshes(spark: SparkSession, folder: str) -> DataFrame:
    """Months whose trips must be made anew: a layer lacks them, or rows came in after their snapshot was loaded."""
    trips = table(spark, folder, "monthly_taxi_trip").groupBy("year_month").agg(F.max("collected_at").alias("came"))
    loads = table(spark, folder, "gold_load_versions").groupBy("year_month").agg(F.max("created_at").alias("loaded"))
    both = trips.join(loads, "year_month", "full")
    changed = F.coalesce(F.col("came") > F.col("loaded"), F.lit(False))
    return both.select("year_month", changed.alias("changed"), F.col("came").isNotNull().alias("has_source"), F.col("loaded").isNotNull().alias("has_target"), (changed | F.col("came").isNull() | F.col("loaded").isNull()).alias("refresh"))


def attribution_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of attributed trips: a hash of their ids as JSON, nulls included, and a name-based UUID."""
    a = table(spark, folder, "attribution").select("trip_key", "driver_id", "taxi_id", "PULocationID").distinct()
    return a.select(json_key(["driver_id", "taxi_id", "PULocationID"]).alias("json_key"), uuid5("6ba7b810-9dad-11d1-80b4-00c04fd430c8", F.col("trip_key")).alias("uuid"))


def unit_models(spark: SparkSession, folder: str) -> DataFrame:
    """The model of each numbered unit, read from its name, and the units' share in the fleet as text."""
    u = catalog.numbered_units(spark, folder).select(before_last(F.col("unit_id"), "#").alias("model"))
    c = u.groupBy("model").agg(F.count("*").alias("units"))
    fee = table(spark, folder, "inventory").select(F.col("vehicle_model_id").alias("model"), money(F.col("weekly_lease_fee")).alias("fee"))
    every = c.agg(F.sum("units").alias("all"))
    return c.join(fee, "model").crossJoin(F.broadcast(every)).select("model", "units", "fee", percent(F.col("units") / F.col("all")).alias("share"))


def evolved_drivers(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of the drivers of each month in the next one, how many join (a fiftieth, rounded at random), and how many that makes."""
    d = _drivers(spark, folder).where("driver_id is not null and exit_date is null").select("snapshot_month", "driver_id").distinct()
    fates = draws.evolved(d, "driver_id", F.col("snapshot_month"), 0.03, 0.1)
    per = fates.groupBy("snapshot_month").agg(F.count("*").alias("drivers"), *(F.count_if(F.col("fate") == f).alias(f) for f in ("leaves", "changes", "stays")))
    joins_ = draws.rounded_at_random(F.col("drivers") / 50, draws.uniform(F.lit("join"), F.col("snapshot_month")))
    return per.withColumn("joins", joins_).withColumn("next", F.col("drivers") - F.col("leaves") + F.col("joins"))


def drawn_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    """The units on stock that drivers draw who change in any month; who comes after the last unit gets none."""
    d = _drivers(spark, folder).where("driver_id is not null and exit_date is null").select("snapshot_month", "driver_id").distinct()
    wanting = draws.evolved(d, "driver_id", F.col("snapshot_month"), 0.03, 0.1).where("fate = 'changes'").select(F.concat_ws(":", "driver_id", "snapshot_month").alias("asking"))
    return draws.drawn_units(wanting, "asking", catalog.numbered_units(spark, folder), "unit_id", "draw")


QUERIES = {
    f.__name__: f
    for f in (
        clean_trips, clean_reasons, trip_reconciliation, trip_suite, placed_trips, cast_failures, natural_collisions, skip_gate, inventory_errors, dimension_checks, column_quality, snapshot_rules, contract_integrity,
        one_date_each, agent_contract, attribution_ceiling, tier_multipliers, missing_multipliers, driver_models, suggested_models, suggestion_gains, scoped_profit, ordered_profits, driver_numbers, capacity_minutes,
        lease_inventory, eligibility_groups, fuel_classes, tier_aliases, model_years, eligibility_lines, card_links, spec_matches, month_slices, daily_fees, daily_statuses, area_states, noise_chain, area_watermarks,
        target_months, refreshes, attribution_keys, unit_models, evolved_drivers, drawn_vehicles,
    )
}
