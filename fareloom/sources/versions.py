"""Versioned folders: which version is complete, newest, unchanged or expired.

A version is a folder ``<partition>/<name>=<token>`` that counts once it has a ``_SUCCESS`` marker and a data file.
Everything here lists and moves folders through Hadoop's file system, so it works wherever Spark can write.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCESS, QUARANTINED, RECON = "_SUCCESS", "_QUARANTINED.json", "_RECON.json"


class Files:
    """A few file operations on any path Spark can reach."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf, self._gateway = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _of(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._of(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none where it doesn't exist."""
        fs, p = self._of(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def rename(self, source: str, target: str) -> None:
        fs, a = self._of(source)
        if not fs.rename(a, self._of(target)[1]):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        fs, p = self._of(path)
        fs.delete(p, True)

    def write(self, path: str, data: bytes) -> None:
        fs, p = self._of(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def read(self, path: str) -> bytes:
        fs, p = self._of(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create_new(self, path: str, data: bytes) -> bool:
        """Writes a file that must not exist yet; says whether it did. Of several that try at once only one succeeds."""
        fs, p = self._of(path)
        try:
            out = fs.create(p, False)
        except Py4JJavaError as error:
            if fs.exists(p):
                return False
            raise error
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        return True

    def replace(self, path: str, data: bytes) -> None:
        """Writes a file beside its place and moves it over what is there, in one step: a reader sees the old or the new one."""
        beside = f"{path}.{uuid.uuid4().hex}"
        self.write(beside, data)
        jvm, (_, a), (_, b) = self._jvm, self._of(beside), self._of(path)
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), self._conf).rename(a, b, options)

    def walk(self, path: str) -> list[str]:
        """Names below a folder, relative to it, sorted; of a file its own name; hidden checksum files are none. Nothing there is an error."""
        fs, p = self._of(path)
        if not fs.exists(p):
            raise FileNotFoundError(path)
        root = fs.getFileStatus(p)
        if not root.isDirectory():
            return [p.getName()]
        below, start, out = fs.listFiles(p, True), len(root.getPath().toString()) + 1, []
        while below.hasNext():
            out.append(below.next().getPath().toString()[start:])
        return sorted(n for n in out if not n.endswith(".crc"))

    def digest(self, path: str, names: list[str] | None = None) -> str:
        """SHA-256 over name, zero byte, bytes, zero byte of each file, in the order of names. The bytes are streamed inside the JVM: none of them come to Python."""
        jvm = self._jvm
        md = jvm.java.security.MessageDigest.getInstance("SHA-256")
        single = not self._of(path)[0].getFileStatus(self._of(path)[1]).isDirectory()
        for name in self.walk(path) if names is None else sorted(names):
            md.update(bytearray(name.encode() + b"\0"))
            fs, p = self._of(path if single else f"{path}/{name}")
            stream = jvm.java.security.DigestInputStream(fs.open(p), md)
            try:
                jvm.org.apache.commons.io.IOUtils.copyLarge(stream, jvm.java.io.OutputStream.nullOutputStream())
            finally:
                stream.close()
            md.update(bytearray(b"\0"))
        return bytes(md.digest()).hex()

    def size(self, path: str) -> int:
        fs, p = self._of(path)
        return fs.getFileStatus(p).getLen()


def is_complete(files: Files, folder: str) -> bool:
    """A success marker, no quarantine marker, and at least one data file. Both markers at once are an error."""
    names = files.names(folder)
    if SUCCESS in names and QUARANTINED in names:
        raise ValueError(f"{folder} is marked as complete and as quarantined")
    return SUCCESS in names and any(n.endswith(".parquet") for n in names)


def versions(files: Files, partition: str, name: str) -> list[str]:
    """Tokens of the complete versions of a partition, oldest first."""
    prefix = f"{name}="
    return [n[len(prefix) :] for n in files.names(partition) if n.startswith(prefix) and is_complete(files, f"{partition}/{n}")]


def latest_version(files: Files, partition: str, name: str) -> str:
    """The folder of the newest complete version."""
    found = versions(files, partition, name)
    if not found:
        raise FileNotFoundError(f"no complete {name} in {partition}")
    return f"{partition}/{name}={found[-1]}"


def latest_of_each(files: Files, partitions: list[str], name: str) -> list[str]:
    """The newest version of every partition; all that have none are named in one error."""
    found, missing = [], []
    for p in partitions:
        have = versions(files, p, name)
        (found.append(f"{p}/{name}={have[-1]}") if have else missing.append(p))
    if missing:
        raise FileNotFoundError(f"no complete {name} in: {', '.join(missing)}")
    return found


def mark(files: Files, folder: str, marker: str, payload: dict | None = None) -> None:
    """Set one marker and take the other away."""
    for other in {SUCCESS, QUARANTINED} - {marker}:
        files.delete(f"{folder}/{other}")
    files.write(f"{folder}/{marker}", json.dumps(payload or {}, sort_keys=True).encode())


def content_digest(files: Files, path: str) -> str:
    """SHA-256 over the names and bytes of a file, or of all files of a folder, markers included. A folder whose name only begins alike is another one; an empty one is an error."""
    names = files.walk(path)
    if not names:
        raise FileNotFoundError(f"{path} is empty")
    return files.digest(path, names)


def table_digest(df: DataFrame) -> str:
    """A digest of the rows, whatever their order or files: sums of two row hashes, computed where the rows are."""
    columns = [F.col(c) for c in sorted(df.columns)]
    halves = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]
    row = df.agg(F.count("*"), *halves).first()
    return hashlib.sha256(":".join(map(str, row)).encode()).hexdigest()


def fingerprint(area: str, month: str, inputs: dict[str, str], digests: dict[str, str], constants: dict, combinations: set[tuple]) -> str:
    """One digest of everything a load depends on. The order of combinations doesn't count."""
    parts = {"area": area, "month": month, "inputs": inputs, "digests": digests, "constants": constants, "combinations": sorted(map(list, combinations))}
    return hashlib.sha256(json.dumps(parts, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def run_id(month: str, config: dict) -> str:
    """``<month>_<hash>`` for a run of one configuration."""
    y, dash, m = month.partition("-")
    if not (dash and len(y) == 4 and y.isdigit() and len(m) == 2 and m.isdigit() and 1 <= int(m) <= 12):
        raise ValueError(f"not a month: {month}")
    return f"{month}_{hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:12]}"


def lost_partitions(before: set[str], after: set[str], current: str | None = None) -> set[str]:
    """Partitions that were there and no longer are; the one being rewritten may be absent."""
    return before - after - {current}


@dataclass(frozen=True)
class Kept:
    """What retention decides for a folder."""

    folder: str
    action: str
    why: str


def retention(listing: list[tuple[str, str, bool, bool, str]], cutoff: str) -> list[Kept]:
    """Decides on (partition, token, success, quarantined, finished) entries, dates as ISO text.

    The newest success of a partition always stays; other successes and quarantined folders that finished before the cutoff go;
    unmarked folders stay, they may be being written.
    """
    newest: dict[str, str] = {}
    for partition, token, good, bad, _ in listing:
        if good and bad:
            raise ValueError(f"{partition}/{token} has both markers")
        if good:
            newest[partition] = max(newest.get(partition, ""), token)
    out = []
    for partition, token, good, bad, finished in listing:
        name = f"{partition}/{token}"
        if not (good or bad):
            out.append(Kept(name, "keep", "unmarked"))
        elif good and newest[partition] == token:
            out.append(Kept(name, "keep", "newest"))
        else:
            out.append(Kept(name, "delete", "expired") if finished < cutoff else Kept(name, "keep", "recent"))
    return out


def expired_versions(data: DataFrame, meta: DataFrame, key: list[str], version: str, created: str, cutoff: str) -> DataFrame:
    """``*key, version``: versions older than a key's latest and created by the cutoff. Versions without metadata must not exist."""
    have = data.select(*key, version).distinct()
    if not have.join(meta, [*key, version], "left_anti").isEmpty():
        raise ValueError("there are versions without metadata")
    top = have.groupBy(*key).agg(F.max(version).alias("_top"))
    return have.join(top, key).join(meta.select(*key, version, created), [*key, version]).where((F.col(version) < F.col("_top")) & (F.col(created) <= F.lit(cutoff).cast("timestamp"))).select(*key, version)


# Which version, which month


def explicit_input(files: Files, folder: str) -> str:
    """A folder named by hand must be complete like any other."""
    if not is_complete(files, folder):
        raise FileNotFoundError(f"{folder} is not a complete version")
    return folder


def latest_pair(files: Files, partition: str, name: str) -> tuple[str, tuple[str, ...]]:
    """The newest complete version whose token is made of several, ``<name>=<a>_<b>``, compared part by part, and its parts."""
    found = [(tuple(t.split("_")), t) for t in versions(files, partition, name) if re.fullmatch(r"[0-9A-Za-z]+(_[0-9A-Za-z]+)+", t)]
    if not found:
        raise FileNotFoundError(f"no complete {name} in {partition}")
    parts, token = max(found)
    return f"{partition}/{name}={token}", parts


def months(first: str, last: str) -> list[str]:
    """All months ``yyyy-MM`` from first to last, both included."""
    number = lambda m: int(m[:4]) * 12 + int(m[5:]) - 1
    for m in (first, last):
        if not re.fullmatch(r"[0-9]{4}-(0[1-9]|1[0-2])", m):
            raise ValueError(f"not a month: {m}")
    if number(last) < number(first):
        raise ValueError(f"{last} is before {first}")
    return [f"{n // 12:04}-{n % 12 + 1:02}" for n in range(number(first), number(last) + 1)]


def month_before(month: str, by: int) -> str:
    """The month ``by`` months earlier: what was published then is known now."""
    number = int(month[:4]) * 12 + int(month[5:]) - 1 - by
    return f"{number // 12:04}-{number % 12 + 1:02}"


def target_month(named: str | None, partition: str | None, available: list[str], limit: str) -> str:
    """The month to work on: the one named, else that of the partition (``AREA:yyyy-MM``), else the latest available one not after ``limit``."""
    if named:
        return months(named, named)[0]
    if partition:
        return months(m := partition.rpartition(":")[2], m)[0]
    before = [m for m in available if m <= limit]
    if not before:
        raise FileNotFoundError(f"no month up to {limit}")
    return max(before)


def target_area(partition: str | None, named: str | None) -> str:
    """The area of the partition (``AREA:yyyy-MM``), else the one named: capitals, digits and underscores, beginning with a capital."""
    area = partition.partition(":")[0] if partition and ":" in partition else named
    if not area or not re.fullmatch(r"[A-Z][A-Z0-9_]*", area):
        raise ValueError(f"not an area: {area}")
    return area


def source_month(reference: str, look_back: int, released: set[str], has_data: Callable[[str], bool]) -> str | None:
    """The newest of the months up to ``look_back`` before the reference that isn't released yet and has data."""
    return next((m for m in (month_before(reference, i) for i in range(1, look_back + 1)) if m not in released and has_data(m)), None)


def refresh_needed(changed: bool, has_bronze: bool, has_silver: bool) -> bool:
    """A partition is made anew when its source changed or a layer lacks it."""
    return changed or not has_bronze or not has_silver


def newest_distinct(files: Files, partition: str, name: str, month: str | None = None) -> list[str]:
    """Tokens of complete versions, newest first, without those whose bytes are those of the next older one. With ``month`` (``yyyy-MM``) a token of another month is an error."""
    out: list[str] = []
    digest = None
    for token in versions(files, partition, name):
        if month and not token.startswith(month.replace("-", "")):
            raise ValueError(f"{partition} holds {token}, which is not of {month}")
        folder = f"{partition}/{name}={token}"
        # Names of parts differ between writes, so files are compared by their bytes alone.
        now = content_hash(files, folder, [n for n in files.walk(folder) if n.endswith(".parquet")])
        if now != digest:
            out.append(token)
        digest = now
    return out[::-1]


def content_hash(files: Files, folder: str, names: list[str]) -> str:
    """A digest of files by their bytes, whatever they are called and in whatever order."""
    return hashlib.sha256(b"".join(sorted(_bytes_digest(files, f"{folder}/{n}") for n in names))).hexdigest()


# Manifests, checkpoints, settings

#: What the manifest of a delivered file must say.
MANIFEST = {"dataset": str, "month": str, "token": str, "rows": int, "bytes": int, "sha256": str}


def checked_manifest(text: bytes) -> dict:
    """The manifest of a delivered file: exactly the fields of ``MANIFEST``, of their types and with sensible values."""
    have = json.loads(text)
    if not isinstance(have, dict) or have.keys() != MANIFEST.keys():
        raise ValueError(f"manifest has not exactly {sorted(MANIFEST)}")
    wrong = [k for k, t in MANIFEST.items() if type(have[k]) is not t]
    if wrong or have["rows"] < 0 or have["bytes"] < 0 or not re.fullmatch(r"[0-9a-f]{64}", have["sha256"]):
        raise ValueError(f"manifest has unusable values: {wrong or have}")
    months(have["month"], have["month"])
    return have


def check_delivery(spark: SparkSession, folder: str, file: str = "data.parquet") -> dict:
    """A delivered file against the manifest beside it: its place (``.../month=<month>/collected_at=<token>``), size, digest and rows. All that is wrong is named in one error."""
    files = Files(spark)
    have, path = checked_manifest(files.read(f"{folder}/manifest.json")), f"{folder}/{file}"
    if not files.exists(path):
        raise FileNotFoundError(path)
    wrong = [n for n, ok in {
        "month": f"month={have['month']}/" in folder + "/", "token": folder.rstrip("/").endswith(f"collected_at={have['token']}"), "bytes": files.size(path) == have["bytes"],
        "sha256": _bytes_digest(files, path).hex() == have["sha256"], "rows": spark.read.parquet(path).count() == have["rows"],
    }.items() if not ok]
    if wrong:
        raise ValueError(f"{path} differs from its manifest in: {', '.join(wrong)}")
    return have


def _bytes_digest(files: Files, path: str) -> bytes:
    """SHA-256 of one file's bytes, streamed in the JVM."""
    jvm = files._jvm
    fs, p = files._of(path)
    stream = fs.open(p)
    try:
        return bytes.fromhex(jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream))
    finally:
        stream.close()


def check_checkpoint(files: Files, root: str, month: str, config_hash: str, first: str) -> dict | None:
    """The checkpoint a month goes on from: that of the month before, made with the same settings. The first month goes on from none."""
    if month == first:
        return None
    path = f"{root}/{month_before(month, 1)}/checkpoint.json"
    if not files.exists(path):
        raise FileNotFoundError(f"{month} goes on from {path}, which is not there")
    have = json.loads(files.read(path))
    if have["config_hash"] != config_hash:
        raise ValueError(f"{path} was made with other settings")
    return have


def write_checkpoint(files: Files, root: str, month: str, config_hash: str, state: dict) -> None:
    """A checkpoint is there whole or not at all."""
    files.replace(f"{root}/{month}/checkpoint.json", json.dumps({"month": month, "config_hash": config_hash, "state": state}, sort_keys=True).encode())


def checked_settings(given: dict, ranges: dict[str, tuple[float, float]], weights: dict[str, list[str]] | None = None) -> dict:
    """Settings with exactly the keys of ``ranges``, each within its bounds; each list of ``weights`` names settings that add up to 1."""
    if given.keys() != ranges.keys():
        raise ValueError(f"settings lack {sorted(ranges.keys() - given.keys())} or have {sorted(given.keys() - ranges.keys())} too many")
    off = [k for k, (low, high) in ranges.items() if isinstance(given[k], bool) or not isinstance(given[k], (int, float)) or not low <= given[k] <= high]
    off += [n for n, names in (weights or {}).items() if abs(sum(given[k] for k in names) - 1) > 1e-9]
    if off:
        raise ValueError(f"settings out of bounds: {off}")
    return given


def check_report(df: DataFrame, columns: list[str], month_column: str, month: str) -> None:
    """A report has rows, the columns it must have, and no month but its own."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    row = df.agg(F.count("*").alias("n"), F.count_if(~F.col(month_column).eqNullSafe(F.lit(month))).alias("off")).first()
    if not row.n or row.off:
        raise ValueError(f"{row.n} rows, {row.off} of them not of {month}")
