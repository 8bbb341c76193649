"""Queries that send tables through sinks, versioned folders and readers, and give what comes back. Their folders are scratch folders of the shared one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.columns import clean_id
from fareloom.operators import quality
from fareloom.plans.catalog import _drivers
from fareloom.session import scratch_dir
from fareloom.sources import readers, sinks, versions
from fareloom.sources.tables import table


def partition_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots written by month and area, two partitions of them once more, read back from the folders: those that weren't written again are as they were."""
    path = scratch_dir(spark, "parts")
    g = table(spark, folder, "gold").select("service_area", "year_month", "version", "driver_id", "monthly_mileage")
    sinks.overwrite(g, path, ["year_month", "service_area"])
    sinks.overwrite(g.where("year_month = '2025-03' and service_area <> 'NYC' and version > 1"), path, ["year_month", "service_area"])
    schema = readers.parquet(spark, path).schema
    return readers.parquet(spark, [path], schema, path).groupBy("year_month", "service_area").agg(F.count("*").alias("n"), F.max("version").alias("newest"), F.min("version").alias("oldest"))


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Zones written as text with a header by borough and read back, all as text, blanks as null, the folder as a column."""
    path = scratch_dir(spark, "csv")
    table(spark, folder, "zone_lookup").withColumn("service_zone", F.coalesce("service_zone", F.lit("  "))).write.option("header", True).option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).partitionBy("Borough").csv(path)
    z = readers.csv_text(spark, path, ["LocationID", "Zone", "service_zone", "Borough"], path)
    return z.groupBy("Borough").agg(F.count("*").alias("n"), F.count("service_zone").alias("zoned"), F.max(F.col("LocationID").cast("int")).alias("last"))


def single_file_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The inventory as one file, and its rows and models."""
    path = f"{scratch_dir(spark, 'one')}/inventory.parquet"
    sinks.single_file(table(spark, folder, "inventory"), path)
    back = readers.parquet(spark, path, table(spark, folder, "inventory").schema).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), F.count_distinct("vehicle_model_id").alias("models"), F.sum("stock").alias("stock"))
    return back.agg(F.sum("rows").alias("rows"), F.sum("models").alias("models"), F.sum("stock").alias("stock"), F.count("*").alias("files"))


def version_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Driver snapshots as one version a month, with the rows that keep the rules, the others counted, and both against what came in; the newest complete version of each month read back."""
    root, files = scratch_dir(spark, "versions"), versions.Files(spark)
    d = table(spark, folder, "driver_snapshot")
    rules = {"fee": F.col("weekly_lease_fee").isNotNull() & ~F.isnan("weekly_lease_fee"), "fuel": F.col("fuel_type").isNotNull()}
    months = sorted(r.snapshot_month for r in d.select("snapshot_month").distinct().collect())
    for m in months:
        own = d.where(F.col("snapshot_month") == m)
        good, bad = quality.split_valid(own, rules)
        sinks.write_version(good, f"{root}/month={m}", "collected_at", "1", bad, total=own)
        sinks.write_version(good, f"{root}/month={m}", "collected_at", "2", bad, total=own.unionByName(own))  # quarantined: half of the rows are missing
    found = versions.latest_of_each(files, [f"{root}/month={m}" for m in months], "collected_at")
    return readers.parquet(spark, [versions.explicit_input(files, f) for f in found], base=root).groupBy(F.col("month").cast("string").alias("month"), "collected_at").agg(F.count("*").alias("n"))


def switched_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables written together twice; the second time all or nothing fails at the second table, so both stay as they were."""
    root = scratch_dir(spark, "switched")
    i = table(spark, folder, "inventory")
    sinks.all_or_nothing({"models": i, "makers": i.select("manufacturer").distinct()}, root)
    try:
        sinks.all_or_nothing({"models": i.limit(1), "makers": i.select(F.raise_error(F.lit("stop")).cast("string").alias("manufacturer"))}, root)
    except Exception as error:  # noqa: BLE001 - the error that the query makes
        if "stop" not in str(error):
            raise
    return quality.control_totals({n: sinks.current(spark, root, n) for n in ("models", "makers")}, {"named": F.when(F.col("manufacturer").isNotNull(), 1)})


def release_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables published as a release, published again (the same one is reused), checked against its manifest, and the rows it says they have."""
    root = scratch_dir(spark, "releases")
    frames = {n: table(spark, folder, n) for n in ("inventory", "zone_lookup", "gold_load_versions")}
    run = versions.run_id("2025-05", {"seed": 1})
    made = sinks.publish_release(frames, root, run, "h")
    again = sinks.publish_release({n: f.limit(1) for n, f in frames.items()}, root, run, "h")
    checked = sinks.validate_release(spark, root, run)
    return spark.createDataFrame([(n, checked["datasets"][n]["rows"], made == again) for n in frames], "dataset string, rows bigint, reused boolean")


def load_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of the newest month of each area loaded in order, the last one twice; the newest version of each read back."""
    root = scratch_dir(spark, "loads")
    g = table(spark, folder, "gold").select("service_area", "year_month", "version", "driver_id", "taxi_id")
    listed = g.select("service_area", "year_month", "version").distinct()
    newest = listed.groupBy("service_area").agg(F.max("year_month").alias("year_month"))
    each = sorted(tuple(r) for r in listed.join(newest, ["service_area", "year_month"]).select("service_area", "year_month", "version").collect())
    for area, month, version in [*each, each[-1]]:
        own = g.where((F.col("service_area") == area) & (F.col("year_month") == month) & (F.col("version") == version)).select("driver_id", "taxi_id")
        made = versions.fingerprint(area, month, {"gold": "table"}, {"gold": str(version)}, {}, set())
        sinks.idempotent_load({"drivers": own}, root, area, month, made, "2025-06-01")
    return sinks.read_latest(spark, root, "drivers").groupBy("service_area", F.col("year_month").cast("string").alias("year_month"), "version").agg(F.count("*").alias("n"))


def sorted_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Trips' taxis and times sorted over all files; per month whether any row comes before the one it follows in its file."""
    path = scratch_dir(spark, "sorted")
    t = table(spark, folder, "attribution").select(clean_id(F.col("taxi_id")).alias("taxi_id"), "trip_key", F.date_format("service_date", "yyyy-MM").alias("month")).where("taxi_id is not null and trip_key is not null").distinct()
    sinks.sorted_files(t, path, ["taxi_id", "trip_key"])
    back = readers.parquet(spark, path)
    ends = back.groupBy(F.input_file_name().alias("file")).agg(F.min(F.struct("taxi_id", "trip_key")).alias("low"), F.max(F.struct("taxi_id", "trip_key")).alias("high"))
    # Files are ranges: none overlaps another. There are few files.
    crossed = ends.alias("a").join(ends.alias("b"), (F.col("a.file") < F.col("b.file")) & (F.col("a.low") <= F.col("b.high")) & (F.col("b.low") <= F.col("a.high"))).agg((F.count("*") == 0).alias("ranges"))
    return back.groupBy("month").agg(F.count("*").alias("n")).crossJoin(F.broadcast(crossed))


def appended_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of an area and month offered one after the other, each twice: a version is written only where the rows changed."""
    root, files = scratch_dir(spark, "appended"), versions.Files(spark)
    g = table(spark, folder, "gold").where("service_area = 'NYC' and year_month = '2025-02'").select("version", "driver_id", "taxi_id", "vehicle_model_id").distinct()
    out = []
    for v in sorted(r.version for r in g.select("version").distinct().collect()):
        own = g.where(F.col("version") == v).drop("version")
        for turn in ("a", "b"):
            wrote = sinks.append_if_changed(own, f"{root}/p", "v", f"{v:04}{turn}", versions.table_digest(own.repartition(2 if turn == "a" else 3)))
            out.append((f"{v:04}{turn}", wrote, len(versions.versions(files, f"{root}/p", "v"))))
    return spark.createDataFrame(out, "token string, wrote boolean, versions int")


def latest_folders(spark: SparkSession, folder: str) -> DataFrame:
    """A marked folder for each listed load, every fifth version quarantined: the newest complete one of each area and month."""
    root, files = scratch_dir(spark, "folders"), versions.Files(spark)
    loads = [tuple(r) for r in table(spark, folder, "gold_load_versions").select("service_area", "year_month", "version").collect()]  # a fixed list of some 40
    for area, month, version in loads:
        here = f"{root}/{area}/{month}/v={version:05}"
        files.write(f"{here}/data.parquet", f"{version}".encode())
        versions.mark(files, here, versions.QUARANTINED if version % 5 == 0 else versions.SUCCESS)
    found = []
    for area, month in sorted({x[:2] for x in loads}):
        have = versions.versions(files, f"{root}/{area}/{month}", "v")
        found.append((area, month, int(have[-1]) if have else None, len(have), versions.content_digest(files, f"{root}/{area}/{month}/v={have[-1]}/data.parquet") if have else None))
    return spark.createDataFrame(found, "service_area string, year_month string, version int, complete int, digest string")


def retention_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """What retention does with each listed load's folder, every fifth version being quarantined and every seventh unmarked."""
    loads = table(spark, folder, "gold_load_versions").select("service_area", "year_month", "version", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("at")).collect()  # a fixed list of some 40
    listing = [(f"{r.service_area}/{r.year_month}", f"{r.version:05}", r.version % 5 != 0 and r.version % 7 != 0, r.version % 5 == 0, r["at"]) for r in loads]
    return spark.createDataFrame([(k.folder, k.action, k.why) for k in versions.retention(listing, "2025-05-10 00:00:00")], "folder string, action string, why string")


def load_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """A run's name and a load's fingerprint for each snapshot month: digests of all they depend on, in one written form."""
    months = sorted(r.snapshot_month for r in _drivers(spark, folder).select("snapshot_month").distinct().collect())  # a calendar
    rows = [(m, versions.run_id(m, {"seed": 7, "rate": 0.5}), versions.fingerprint("NYC", m, {"trips": "silver"}, {"trips": m}, {"share": 0.3}, {("b", 2), ("a", 1)})) for m in months]
    return spark.createDataFrame(rows, "month string, run string, fingerprint string")


def lost_months(spark: SparkSession, folder: str) -> DataFrame:
    """Months of the loads that the trips don't have, the month at work excepted, and those that only trips have."""
    have = {r.year_month for r in table(spark, folder, "monthly_taxi_trip").select("year_month").distinct().collect()}
    loaded = {r.year_month for r in table(spark, folder, "gold_load_versions").select("year_month").distinct().collect()}
    rows = [(m, "lost") for m in versions.lost_partitions(loaded, have, "2025-05")] + [(m, "new") for m in versions.lost_partitions(have, loaded, "2025-05")]
    return spark.createDataFrame(rows, "month string, what string")


QUERIES = {
    f.__name__: f
    for f in (
        partition_round_trip, csv_round_trip, single_file_round_trip, version_round_trip, switched_tables, release_round_trip, load_round_trip, sorted_round_trip, appended_versions, latest_folders, retention_decisions, load_fingerprints, lost_months,
    )
}
