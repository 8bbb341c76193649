"""Sessions, and tables written once to cut lineage.

Every timestamp in the library is a wall-clock value read as UTC, so a session
made here pins the zone; a session handed in by a cluster is left as it is.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
#: What every written table's folder is called, before its name.
PREFIX = "fareloom-"


def get_spark(app: str = "fareloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the zone pinned to UTC, for the session and for the process. The package goes to the executors' workers with it, wherever the process was started."""
    os.environ["TZ"] = "UTC"
    time.tzset()
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    if not getattr(context, "_has_fareloom", False):
        context.addPyFile(package_zip())
        context._has_fareloom = True
    return spark


def package_zip() -> str:
    """This package as a zip file that executors can import."""
    here = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix=PREFIX)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return shutil.make_archive(f"{folder}/{here.name}", "zip", here.parent, here.name)


def _on_one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the directory
    set on the context. Only where neither is set and all runs in one process (tests, one machine) a temporary one is made;
    on a cluster a folder of one machine would lose the other machines' parts, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    have = context._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get().rstrip("/")
    if not _on_one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="fareloom-")
    context.setCheckpointDir(made)
    return made


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001 - a folder that is gone, or a session that has ended
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder.

    Unlike a cached or locally checkpointed frame it survives the loss of any
    executor, its plan is one scan, and the columns are compressed.
    The table is removed at the end of the process, or earlier by :func:`scratch` or :func:`drop_written`;
    what a killed process leaves behind, :func:`sweep` removes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{PREFIX}{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._fareloom_path = path
    return back


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one, owned and removed like a written table."""
    path = f"{shared_dir(spark)}/{PREFIX}{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the scan of a small table would use less than half of them.

    For steps that spend long on each row. A large table has more partitions than there are cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def drop_written(df: DataFrame) -> None:
    """Remove a table of :func:`written` that no later plan reads."""
    path = getattr(df, "_fareloom_path", None)
    if path:
        _remove(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


@contextmanager
def scratch() -> Iterator[None]:
    """Owns the tables written inside: they are removed at its end, when the results built on them have been stored."""
    before = len(_written)
    try:
        yield
    finally:
        mine = _written[before:]
        del _written[before:]
        for spark, path in mine:
            _remove(spark, path)


def sweep(spark: SparkSession, hours: float = 72.0) -> int:
    """Remove written tables older than ``hours`` from the shared folder (those of processes that were killed); says how many."""
    jvm, folder = spark.sparkContext._jvm, shared_dir(spark)
    where = jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        return 0
    until, own, gone = (time.time() - hours * 3600) * 1000, {path.rpartition("/")[2] for _, path in _written}, 0
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name.startswith(PREFIX) and name not in own and status.getModificationTime() < until:
            files.delete(status.getPath(), True)
            gone += 1
    return gone


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        _remove(spark, path)
    _written.clear()
