"""Writing tables: whole or not at all, versioned, and not again when nothing changed."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.versions import QUARANTINED, RECON, SUCCESS, Files, mark, versions


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table, or with ``partition_by`` only the partitions that ``df`` has rows for."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def jdbc(df: DataFrame, url: str, table: str, connections: int = 8, mode: str = "append", **options: str) -> None:
    """Insert into a database table over at most ``connections`` connections. Each task commits its own rows, so load into a staging table
    and publish by version (:func:`idempotent_load` keeps the list) where readers must see all or nothing."""
    df.coalesce(connections).write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def _stage(target: str) -> str:
    return f"{target.rstrip('/')}.staging-{uuid.uuid4().hex}"


def single_file(df: DataFrame, path: str) -> None:
    """One Parquet file at ``path``, in place only when complete. For tables that one task can write."""
    files = Files(df.sparkSession)
    stage = _stage(path)
    try:
        df.coalesce(1).write.parquet(stage)
        parts = [n for n in files.names(stage) if n.endswith(".parquet")]
        if len(parts) != 1:
            raise OSError(f"{len(parts)} files instead of one")
        files.delete(path)
        files.rename(f"{stage}/{parts[0]}", path)
    finally:
        files.delete(stage)


def all_or_nothing(frames: dict[str, DataFrame], root: str, kept: int = 2) -> str:
    """Write every table into a new folder, then point to it: readers (:func:`current`) see all old tables or all new ones, whenever this fails. Gives the folder's name.

    The pointer is one small file moved into place in one step. The last ``kept`` folders stay, for those who still read the one before.
    """
    files = Files(next(iter(frames.values())).sparkSession)
    made = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        for name, df in frames.items():
            df.write.parquet(f"{root}/_tables/{made}/{name}")
        files.replace(f"{root}/CURRENT", made.encode())
    except BaseException:
        files.delete(f"{root}/_tables/{made}")
        raise
    for old in files.names(f"{root}/_tables")[:-kept]:
        files.delete(f"{root}/_tables/{old}")
    return made


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the folder that is pointed to."""
    return spark.read.parquet(f"{root}/_tables/{Files(spark).read(f'{root}/CURRENT').decode()}/{name}")


def sorted_files(df: DataFrame, path: str, order: list[str]) -> None:
    """The rows in order, over all files by name: each file is a range, sorted. No task sorts all rows."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def _counted(rows: DataFrame | int) -> int:
    return rows if isinstance(rows, int) else rows.count()


def write_version(df: DataFrame, partition: str, name: str, token: str, invalid: DataFrame | int, problem: str | None = None, total: DataFrame | int | None = None) -> dict:
    """A version folder with its reconciliation beside it, marked as complete, or as quarantined when ``problem`` says why.

    ``total``, the rows (or their number) the version was made from, is counted for itself: where it isn't what was written plus ``invalid``, the version is quarantined. Without it nothing is reconciled, only noted.
    Old markers go first, then data, reconciliation and marker in this order: a reader that sees the marker sees all.
    """
    spark = df.sparkSession
    files, folder = Files(spark), f"{partition}/{name}={token}"
    for m in (SUCCESS, QUARANTINED, RECON):
        files.delete(f"{folder}/{m}")
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)
    valid, bad = spark.read.schema(df.schema).parquet(folder).count(), _counted(invalid)
    every = valid + bad if total is None else _counted(total)
    recon = {"total": every, "valid": valid, "invalid": bad}
    if every != valid + bad:
        problem = problem or f"{every} rows came in, {valid} and {bad} went out"
    files.write(f"{folder}/{RECON}", json.dumps(recon, sort_keys=True).encode())
    mark(files, folder, QUARANTINED if problem else SUCCESS, {"reason": problem} if problem else recon)
    return recon


#: The form of a release's manifest.
RELEASE_FORM = 1


def publish_release(frames: dict[str, DataFrame], root: str, run: str, config_hash: str, scope: str = "full") -> dict:
    """Datasets and a manifest (form, scope of the input, rows, schema and digest of each), staged and moved in as one folder; a finished run is reused if it was made alike."""
    spark = next(iter(frames.values())).sparkSession
    files, target = Files(spark), f"{root}/{run}"
    if files.exists(f"{target}/manifest.json"):
        have = json.loads(files.read(f"{target}/manifest.json"))
        for key, want in (("config_hash", config_hash), ("form", RELEASE_FORM), ("scope", scope)):
            if have.get(key) != want:
                raise ValueError(f"{run} was published with another {key}: {have.get(key)}")
        return have
    stage = f"{root}/.staging-{uuid.uuid4().hex}"
    try:
        manifest = {"run_id": run, "config_hash": config_hash, "form": RELEASE_FORM, "scope": scope, "datasets": {}}
        for name, df in frames.items():
            df.write.parquet(f"{stage}/{name}")
            manifest["datasets"][name] = _described(spark, files, f"{stage}/{name}")
        files.write(f"{stage}/manifest.json", json.dumps(manifest, sort_keys=True).encode())
        files.rename(stage, target)
    finally:
        files.delete(stage)
    return manifest


def _described(spark: SparkSession, files: Files, folder: str) -> dict:
    parts = [n for n in files.walk(folder) if n.endswith(".parquet")]
    df = spark.read.parquet(folder)
    return {"rows": df.count(), "schema": df.schema.simpleString(), "files": len(parts), "sha256": files.digest(folder, parts)}


def validate_release(spark: SparkSession, root: str, run: str) -> dict:
    """A published release against its manifest: every dataset's files, digest, rows and schema. All that differs is named in one error."""
    files, target = Files(spark), f"{root}/{run}"
    manifest = json.loads(files.read(f"{target}/manifest.json"))
    wrong = [] if manifest.get("run_id") == run else ["run_id"]
    for name, want in manifest["datasets"].items():
        have = _described(spark, files, f"{target}/{name}") if files.exists(f"{target}/{name}") else {}
        wrong += [f"{name}.{k}" for k in want if have.get(k) != want[k]]
    wrong += [f"{n} is not in the manifest" for n in files.names(target) if n not in manifest["datasets"] and n != "manifest.json" and not n.startswith(".")]
    if wrong:
        raise ValueError(f"{run} differs from its manifest in: {', '.join(wrong)}")
    return manifest


def append_if_changed(df: DataFrame, partition: str, name: str, token: str, digest: str) -> bool:
    """Write a version unless the newest complete one has this digest; says whether it wrote."""
    files = Files(df.sparkSession)
    have = versions(files, partition, name)
    if have:
        folder = f"{partition}/{name}={have[-1]}"
        if files.exists(f"{folder}/_DIGEST") and files.read(f"{folder}/_DIGEST").decode() == digest:
            return False
    write_version(df, partition, name, token, 0)
    files.write(f"{partition}/{name}={token}/_DIGEST", digest.encode())
    return True


@dataclass(frozen=True)
class Loaded:
    """The version a load has, and whether this call made it."""

    version: int
    created: bool
    rows: dict[str, int]


def idempotent_load(frames: dict[str, DataFrame], root: str, area: str, month: str, fingerprint: str, created_at: str) -> Loaded:
    """Load tables as the next version of (area, month), or reuse the version that has the same fingerprint.

    A version's number is claimed first, by a file that only one loader can create; of several at once each gets a number of its own. The entry of the version list is written last, after the
    rows have been counted again, so a load that failed halfway has no version; the next try with its fingerprint takes over its number and folders. Rows are counted while they are written.
    """
    spark: SparkSession = next(iter(frames.values())).sparkSession
    files = Files(spark)
    log = f"{root}/load_versions/service_area={area}/year_month={month}"
    names = files.names(log)
    known = [json.loads(files.read(f"{log}/{n}")) for n in names if n.endswith(".json")]
    for entry in known:
        if entry["fingerprint"] == fingerprint:
            rows = {n: _rows(spark, root, n, area, month, entry["version"]) for n in frames}
            if rows != entry["rows"]:
                raise ValueError(f"version {entry['version']} has {rows}, not {entry['rows']}")
            return Loaded(entry["version"], False, rows)
    claims = {int(n[:-6]): files.read(f"{log}/{n}").decode() for n in names if n.endswith(".claim")}
    version = next((v for v, f in claims.items() if f == fingerprint), None)
    if version is None:
        version = max(claims, default=0) + 1
        while not files.create_new(f"{log}/{version:06d}.claim", fingerprint.encode()):
            version += 1
    wanted = {}
    for name, df in frames.items():
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}/service_area={area}/year_month={month}/version={version}")
        wanted[name] = counted.get["n"]
    rows = {n: _rows(spark, root, n, area, month, version) for n in frames}
    if rows != wanted:
        raise ValueError(f"wrote {rows}, expected {wanted}")
    entry = {"version": version, "fingerprint": fingerprint, "created_at": created_at, "rows": rows}
    if not files.create_new(f"{log}/{version:06d}.json", json.dumps(entry, sort_keys=True).encode()):
        raise ValueError(f"version {version} was loaded by another try")
    return Loaded(version, True, rows)


def _rows(spark: SparkSession, root: str, name: str, area: str, month: str, version: int) -> int:
    path = f"{root}/{name}/service_area={area}/year_month={month}/version={version}"
    return spark.read.parquet(path).count() if Files(spark).exists(path) else 0


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of the newest version of every (area, month); other versions are pruned before they are read."""
    df = spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
    key = ["service_area", "year_month"]
    top = df.select(*key, "version").distinct().groupBy(*key).agg(F.max("version").alias("version"))
    return df.join(top, [*key, "version"], "left_semi")
