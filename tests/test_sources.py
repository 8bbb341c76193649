import pytest
from pyspark.sql import functions as F

from fareloom.sources import readers, sinks, versions
from fareloom.sources.versions import QUARANTINED, Files


def test_version_writing_marking_and_resolving(spark, tmp_path):
    part = f"file://{tmp_path}/month=2025-02"
    df = spark.range(5)
    assert sinks.write_version(df, part, "collected_at", "20250301", 2) == {"total": 7, "valid": 5, "invalid": 2}
    sinks.write_version(df, part, "collected_at", "20250401", 9, problem="too many")
    files = Files(spark)
    assert versions.latest_version(files, part, "collected_at").endswith("=20250301")
    sinks.write_version(spark.range(3), part, "collected_at", "20250401", 0)
    assert QUARANTINED not in files.names(f"{part}/collected_at=20250401")
    assert spark.read.parquet(versions.latest_version(files, part, "collected_at")).count() == 3
    with pytest.raises(FileNotFoundError, match="month=2025-03.*month=2025-04"):
        versions.latest_of_each(files, [part, f"file://{tmp_path}/month=2025-03", f"file://{tmp_path}/month=2025-04"], "collected_at")
    files.write(f"{part}/collected_at=20250401/{QUARANTINED}", b"{}")
    with pytest.raises(ValueError, match="quarantined"):
        versions.is_complete(files, f"{part}/collected_at=20250401")


def test_append_only_when_changed(spark, tmp_path):
    part = f"file://{tmp_path}/p"
    a = versions.table_digest(spark.range(10))
    assert a == versions.table_digest(spark.range(10).repartition(3)) != versions.table_digest(spark.range(11))
    assert sinks.append_if_changed(spark.range(10), part, "v", "1", a)
    assert not sinks.append_if_changed(spark.range(10), part, "v", "2", a)
    assert sinks.append_if_changed(spark.range(11), part, "v", "3", "other")
    assert versions.versions(Files(spark), part, "v") == ["1", "3"]


def test_single_file_and_all_or_nothing(spark, tmp_path):
    sinks.single_file(spark.range(100).repartition(7), f"file://{tmp_path}/one.parquet")
    assert (tmp_path / "one.parquet").is_file() and spark.read.parquet(f"file://{tmp_path}/one.parquet").count() == 100
    root = f"file://{tmp_path}/gold"
    sinks.all_or_nothing({"a": spark.range(1), "b": spark.range(2)}, root)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.all_or_nothing({"a": spark.range(9), "b": broken}, root)
    assert sinks.current(spark, root, "a").count() == 1 and sinks.current(spark, root, "b").count() == 2
    assert len(list((tmp_path / "gold" / "_tables").iterdir())) == 1
    for n in (3, 4, 5):
        sinks.all_or_nothing({"a": spark.range(n), "b": spark.range(n)}, root)
    assert sinks.current(spark, root, "a").count() == sinks.current(spark, root, "b").count() == 5
    assert len(list((tmp_path / "gold" / "_tables").iterdir())) == 2


def test_what_was_written_is_reconciled_with_what_came_in(spark, tmp_path):
    part, files = f"file://{tmp_path}/p", Files(spark)
    every = spark.range(10)
    assert sinks.write_version(every.where("id < 7"), part, "v", "1", every.where("id >= 7"), total=every) == {"total": 10, "valid": 7, "invalid": 3}
    sinks.write_version(every.where("id < 7"), part, "v", "2", every.where("id > 7"), total=every)
    assert versions.versions(files, part, "v") == ["1"] and b"10 rows" in files.read(f"{part}/v=2/{QUARANTINED}")


def test_release_is_checked_against_its_manifest(spark, tmp_path):
    root = f"file://{tmp_path}"
    sinks.publish_release({"x": spark.range(4), "y": spark.range(2)}, root, "r1", "h")
    assert sinks.validate_release(spark, root, "r1")["datasets"]["x"]["rows"] == 4
    with pytest.raises(ValueError, match="scope"):
        sinks.publish_release({"x": spark.range(4)}, root, "r1", "h", scope="first 10")
    spark.range(5).write.mode("overwrite").parquet(f"{root}/r1/x")
    with pytest.raises(ValueError, match="x.rows.*x.sha256"):
        sinks.validate_release(spark, root, "r1")


def test_loads_at_once_and_loads_that_failed(spark, tmp_path):
    root = f"file://{tmp_path}"
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.idempotent_load({"agg": spark.range(2), "more": broken}, root, "A", "2025-02", "f1", "x")
    # Another load meanwhile takes the next number, the failed one its own again.
    assert sinks.idempotent_load({"agg": spark.range(5)}, root, "A", "2025-02", "f2", "x").version == 2
    assert sinks.idempotent_load({"agg": spark.range(2)}, root, "A", "2025-02", "f1", "x") == sinks.Loaded(1, True, {"agg": 2})
    files = Files(spark)
    assert files.create_new(f"{root}/one", b"1") and not files.create_new(f"{root}/one", b"2") and files.read(f"{root}/one") == b"1"


def test_rows_are_sorted_over_all_files(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    sinks.sorted_files(spark.range(1000).selectExpr("pmod(id * 7919, 1000) as x").repartition(5), path, ["x"])
    got = [r.x for n in Files(spark).names(path) if n.endswith(".parquet") for r in spark.read.parquet(f"{path}/{n}").collect()]
    assert got == sorted(got) and len(got) == 1000


def test_digests_are_of_names_and_bytes(spark, tmp_path):
    import hashlib

    files = Files(spark)
    for folder, more in (("v", b""), ("v_old", b"!")):
        (tmp_path / folder / "sub").mkdir(parents=True)
        (tmp_path / folder / "b.parquet").write_bytes(b"bytes" * 400_000 + more)
        (tmp_path / folder / "_SUCCESS").write_bytes(b"")
        (tmp_path / folder / "sub" / "a").write_bytes(b"x")
    want = hashlib.sha256(b"".join(n.encode() + b"\0" + (tmp_path / "v" / n).read_bytes() + b"\0" for n in ("_SUCCESS", "b.parquet", "sub/a"))).hexdigest()
    assert versions.content_digest(files, f"file://{tmp_path}/v") == want != versions.content_digest(files, f"file://{tmp_path}/v_old")
    one = versions.content_digest(files, f"file://{tmp_path}/v/sub/a")
    assert one == hashlib.sha256(b"a\0x\0").hexdigest()
    (tmp_path / "empty").mkdir()
    for gone in ("empty", "nowhere"):
        with pytest.raises(FileNotFoundError):
            versions.content_digest(files, f"file://{tmp_path}/{gone}")


def test_months_areas_and_versions_to_work_on(spark, tmp_path):
    assert versions.months("2024-11", "2025-02") == ["2024-11", "2024-12", "2025-01", "2025-02"] and versions.month_before("2025-01", 2) == "2024-11"
    for bad in (("2025-13", "2025-13"), ("2025-02", "2025-01")):
        with pytest.raises(ValueError):
            versions.months(*bad)
    have = ["2025-01", "2025-03", "2025-02"]
    assert versions.target_month("2024-05", "A:2025-01", have, "2025-02") == "2024-05"
    assert versions.target_month(None, "A:2025-01", have, "2025-02") == "2025-01" and versions.target_month(None, None, have, "2025-02") == "2025-02"
    with pytest.raises(FileNotFoundError):
        versions.target_month(None, None, have, "2024-12")
    assert versions.target_area("NYC_1:2025-01", "X") == "NYC_1" and versions.target_area(None, "X") == "X"
    with pytest.raises(ValueError):
        versions.target_area(None, "x y")
    assert versions.source_month("2025-05", 6, {"2025-04"}, lambda m: m <= "2025-03") == "2025-03" and versions.source_month("2025-05", 1, set(), lambda m: False) is None
    assert [versions.refresh_needed(*x) for x in ((False, True, True), (True, True, True), (False, False, True), (False, True, False))] == [False, True, True, True]
    files, part = Files(spark), f"file://{tmp_path}/p"
    for token in ("9_1", "10_2", "plain"):
        sinks.write_version(spark.range(1), part, "v", token, 0)
    assert versions.latest_pair(files, part, "v")[1] == ("9", "1")
    with pytest.raises(FileNotFoundError):
        versions.explicit_input(files, f"{part}/v=none")
    assert versions.explicit_input(files, f"{part}/v=plain") == f"{part}/v=plain"


def test_same_bytes_are_one_version(spark, tmp_path):
    files, part = Files(spark), f"file://{tmp_path}/m"
    for token, text in (("20250201", "a"), ("20250202", "a"), ("20250203", "b"), ("20250204", "a")):
        folder = tmp_path / "m" / f"v={token}"
        folder.mkdir(parents=True)
        (folder / f"{token}.parquet").write_text(text)
        (folder / "_SUCCESS").write_text("")
    assert versions.newest_distinct(files, part, "v", "2025-02") == ["20250204", "20250203", "20250201"]
    with pytest.raises(ValueError):
        versions.newest_distinct(files, part, "v", "2025-03")


def test_deliveries_checkpoints_settings_and_reports(spark, tmp_path):
    import hashlib
    import json

    folder = tmp_path / "month=2025-02" / "collected_at=t1"
    sinks.single_file(spark.range(6), f"file://{folder}/data.parquet")
    data = (folder / "data.parquet").read_bytes()
    manifest = {"dataset": "trips", "month": "2025-02", "token": "t1", "rows": 6, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}
    (folder / "manifest.json").write_text(json.dumps(manifest))
    assert versions.check_delivery(spark, f"file://{folder}") == manifest
    (folder / "manifest.json").write_text(json.dumps(manifest | {"rows": 7, "token": "t2"}))
    with pytest.raises(ValueError, match="token, rows"):
        versions.check_delivery(spark, f"file://{folder}")
    for bad in ({"rows": "6"}, {"more": 1}, {"sha256": "x"}, {"month": "2025-2"}):
        with pytest.raises(ValueError):
            versions.checked_manifest(json.dumps(manifest | bad).encode())
    files, root = Files(spark), f"file://{tmp_path}/state"
    assert versions.check_checkpoint(files, root, "2025-01", "h", first="2025-01") is None
    versions.write_checkpoint(files, root, "2025-01", "h", {"n": 1})
    versions.write_checkpoint(files, root, "2025-01", "h", {"n": 2})
    assert versions.check_checkpoint(files, root, "2025-02", "h", first="2025-01")["state"] == {"n": 2}
    with pytest.raises(ValueError):
        versions.check_checkpoint(files, root, "2025-02", "other", first="2025-01")
    with pytest.raises(FileNotFoundError):
        versions.check_checkpoint(files, root, "2025-04", "h", first="2025-01")
    ranges = {"a": (0, 1), "b": (0, 1)}
    assert versions.checked_settings({"a": 0.4, "b": 0.6}, ranges, {"all": ["a", "b"]}) == {"a": 0.4, "b": 0.6}
    for bad in ({"a": 1}, {"a": 2, "b": 0}, {"a": 0.5, "b": 0.6}, {"a": True, "b": 0}):
        with pytest.raises(ValueError):
            versions.checked_settings(bad, ranges, {"all": ["a", "b"]})
    report = spark.createDataFrame([("2025-02", 1)], "m string, n int")
    versions.check_report(report, ["n"], "m", "2025-02")
    for df, columns, month in ((report, ["z"], "2025-02"), (report.limit(0), ["n"], "2025-02"), (report, ["n"], "2025-03")):
        with pytest.raises(ValueError):
            versions.check_report(df, columns, "m", month)


def test_dynamic_overwrite(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    sinks.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "x int, city string"), path, ["city"])
    sinks.overwrite(spark.createDataFrame([(3, "b")], "x int, city string"), path, ["city"])
    assert sorted(tuple(r) for r in readers.parquet(spark, [f"{path}/city=a", f"{path}/city=b"], base=path).collect()) == [(1, "a"), (3, "b")]


def test_release_is_reused(spark, tmp_path):
    root = f"file://{tmp_path}"
    made = sinks.publish_release({"x": spark.range(4)}, root, "2025-02_abc", "h1")
    assert made["datasets"]["x"]["rows"] == 4 and (tmp_path / "2025-02_abc" / "manifest.json").exists()
    assert sinks.publish_release({"x": spark.range(99)}, root, "2025-02_abc", "h1") == made
    with pytest.raises(ValueError):
        sinks.publish_release({"x": spark.range(4)}, root, "2025-02_abc", "h2")


def test_idempotent_load_and_latest(spark, tmp_path):
    root = f"file://{tmp_path}"
    load = lambda n, f, area="NYC": sinks.idempotent_load({"agg": spark.range(n)}, root, area, "2025-02", f, "2025-03-01")
    assert (load(3, "f1").version, load(3, "f1").created, load(5, "f2").version, load(5, "f1").version) == (1, False, 2, 1)
    load(7, "f9", "NJ")
    got = sinks.read_latest(spark, root, "agg").groupBy("service_area").count().collect()
    assert {r.service_area: r["count"] for r in got} == {"NYC": 5, "NJ": 7}


def test_fingerprints_and_runs():
    f = lambda c, d="x": versions.fingerprint("A", "2025-02", {"t": "p"}, {"t": d}, {"k": 1}, c)
    assert f({("a", 1), ("b", 2)}) == f({("b", 2), ("a", 1)}) != f({("a", 1)}) and f(set()) != f(set(), "y")
    assert versions.run_id("2025-02", {"a": 1}).startswith("2025-02_")
    for bad in ("2025-13", "2025-2", "x"):
        with pytest.raises(ValueError):
            versions.run_id(bad, {})
    assert versions.lost_partitions({"a", "b", "c"}, {"a"}, "b") == {"c"}


def test_retention():
    listing = [("p", "1", True, False, "2025-01-01"), ("p", "2", True, False, "2025-01-02"), ("p", "3", False, True, "2025-01-03"), ("p", "4", False, False, "2025-01-01"), ("q", "1", True, False, "2025-01-01"), ("p", "1b", True, False, "2025-06-01")]
    got = {k.folder: (k.action, k.why) for k in versions.retention(listing, "2025-02-01")}
    assert got == {"p/1": ("delete", "expired"), "p/2": ("keep", "newest"), "p/3": ("delete", "expired"), "p/4": ("keep", "unmarked"), "q/1": ("keep", "newest"), "p/1b": ("keep", "recent")}
    with pytest.raises(ValueError):
        versions.retention([("p", "1", True, True, "x")], "y")


def test_expired_versions_need_metadata(spark):
    data = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), ("b", 1)], "k string, v int")
    meta = data.selectExpr("k", "v", "timestamp '2025-01-01' + make_interval(0, 0, 0, v) as made")
    got = versions.expired_versions(data, meta, ["k"], "v", "made", "2025-01-02 12:00:00").collect()
    assert [tuple(r) for r in got] == [("a", 1)]
    with pytest.raises(ValueError):
        versions.expired_versions(data, meta.where("v < 5"), ["k"], "v", "made", "2025-01-02")


def test_csv_and_parsers(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Zone\n1, a  b \n2,\n")
    df = readers.csv_text(spark, f"file://{tmp_path}/z.csv", ["LocationID", "Zone"])
    assert [tuple(r) for r in df.collect()] == [("1", "a  b"), ("2", None)]
    with pytest.raises(ValueError):
        readers.csv_text(spark, f"file://{tmp_path}/z.csv", ["Nope"])
    row = spark.createDataFrame([('{"Kia": {"Niro": "2010 (A, B) / 2018 (C)"}}', " a \t b ", "12.5", "-1", "x", "<p>Hi<b>you</b></p>&nbsp;!")], "j string, k string, n string, m string, o string, h string")
    parsed = [readers.optional_number(F.col(c)) for c in "nmo"]
    got = row.select(readers.nested_names(F.col("j")).alias("j"), readers.join_key(F.col("k")).alias("k"), *(v.alias(f"v{i}") for i, (v, _) in enumerate(parsed)), *(b.alias(f"b{i}") for i, (_, b) in enumerate(parsed)), readers.strip_markup(F.col("h")).alias("h"), readers.alias(F.lit(" One "), {"one": "1"}).alias("a")).first()
    assert [tuple(x) for x in got.j] == [("Kia", "Niro", 2010, "A"), ("Kia", "Niro", 2010, "B"), ("Kia", "Niro", 2018, "C")]
    assert (got.k, got.v0, got.v1, got.v2, got.b0, got.b1, got.b2, got.h, got.a) == ("A B", 12.5, None, None, False, True, True, "Hi you !", "1")


def test_jdbc_round_trip(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id int, name string")
    sinks.jdbc(df, url, "agg", driver=driver)
    sinks.jdbc(df.limit(1), url, "agg", driver=driver)
    back = readers.jdbc(spark, url, "agg", "id", 0, 50, 3, driver=driver)
    assert back.count() == 51 and back.rdd.getNumPartitions() == 3 and back.where("id = 7").first().name == "n7"
