import os
import shutil
import time
import uuid
import zipfile

import pytest

from fareloom import session


def test_scratch_removes_what_was_written_inside(spark):
    kept = session.written(spark.range(3), "kept")
    with session.scratch():
        inside = session.written(spark.range(4), "inside")
        assert inside.count() == 4
    assert kept.count() == 3
    folder = session.shared_dir(spark).removeprefix("file://").removeprefix("file:")
    names = os.listdir(folder)
    assert any(n.startswith("fareloom-kept") for n in names) and not any(n.startswith("fareloom-inside") for n in names)


def test_sweep_takes_old_tables_of_other_processes_only(spark):
    folder = session.shared_dir(spark).removeprefix("file://").removeprefix("file:")
    mark = uuid.uuid4().hex
    ages = {f"fareloom-old-{mark}": 100, f"fareloom-new-{mark}": 1, f"other-{mark}": 100}
    try:
        for name, age in ages.items():
            os.mkdir(f"{folder}/{name}")
            os.utime(f"{folder}/{name}", (time.time() - age * 3600,) * 2)
        assert session.sweep(spark, 72) >= 1
        assert {n for n in ages if os.path.exists(f"{folder}/{n}")} == {f"fareloom-new-{mark}", f"other-{mark}"}
    finally:
        for name in ages:
            shutil.rmtree(f"{folder}/{name}", ignore_errors=True)


class Elsewhere:
    """Stands for a session on a cluster without a shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        getConf = staticmethod(lambda: {})

        class _jsc:  # noqa: N801
            sc = staticmethod(lambda: Elsewhere.sparkContext._jsc)
            getCheckpointDir = staticmethod(lambda: Elsewhere.sparkContext._jsc)
            isDefined = staticmethod(lambda: False)

    conf = {}


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)


def test_the_package_can_be_sent_along():
    assert "fareloom/session.py" in zipfile.ZipFile(session.package_zip()).namelist()
