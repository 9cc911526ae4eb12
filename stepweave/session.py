"""Small helpers around the session: shared folder, quoting, Hadoop file listing."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import shutil
import tempfile
import time
import uuid
import warnings
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession

COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"

# Scratch of runs that ended without clearing it goes after so many hours without a change.
SCRATCH_HOURS = 7 * 24
SCRATCH_SETTING = "spark.stepweave.scratch.hours"
_RUNS = "stepweave/runs"
_run: contextvars.ContextVar[str] = contextvars.ContextVar("run", default="")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stepweave-")


@functools.cache
def _ship(application: str, add) -> None:
    package = Path(__file__).resolve().parent
    target = f"{tempfile.mkdtemp(prefix='stepweave-')}/{package.name}-{application}"
    add(shutil.make_archive(target, "zip", package.parent, package.name))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package; once per application."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext.addPyFile)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver and
    the executors are one process.  A cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; in the run's folder, if any."""
    run = _run.get()
    base = f"{_RUNS}/{run}" if run else "stepweave"
    return f"{shared_folder(spark)}/{base}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder; that it stays behind is no error."""
    try:
        delete_folder(spark, path)
    except OSError as error:
        warnings.warn(f"scratch stays behind: {error}", stacklevel=2)


@contextlib.contextmanager
def run_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch paths taken within lie in one folder, which goes at the end, come what may.

    First, what runs that died have left behind is cleared: folders in which nothing has
    changed for ``SCRATCH_HOURS``, or the session's setting.
    """
    sweep_scratch(spark)
    token = _run.set(uuid.uuid4().hex)
    try:
        yield
    finally:
        run = _run.get()
        _run.reset(token)
        with contextlib.suppress(ValueError):  # without a shared folder there is no scratch
            drop_scratch(spark, f"{shared_folder(spark)}/{_RUNS}/{run}")


def sweep_scratch(spark: SparkSession, hours: float | None = None) -> list[str]:
    """Clear the folders of runs in which nothing has changed for so long; gives their paths."""
    if hours is None:
        hours = float(spark.conf.get(SCRATCH_SETTING, str(SCRATCH_HOURS)))
    try:
        folders = matching_folders(spark, f"{shared_folder(spark)}/{_RUNS}/*")
    except ValueError:
        return []
    before = (time.time() - hours * 3600) * 1000
    old = [folder for folder in folders if _last_change(spark, folder) < before]
    for folder in old:
        drop_scratch(spark, folder)
    return old


def _last_change(spark: SparkSession, path: str) -> int:
    """When a file under ``path``, or the folder itself, was last changed; milliseconds."""
    fs, target = hadoop_path(spark, path)
    last = fs.getFileStatus(target).getModificationTime()
    files = fs.listFiles(target, True)
    while files.hasNext():
        last = max(last, files.next().getModificationTime())
    return last


@contextlib.contextmanager
def uncoalesced(spark: SparkSession):
    """Keep the number of shuffle partitions asked for; large ones are still split."""
    before = spark.conf.get(COALESCE)
    spark.conf.set(COALESCE, "false")
    try:
        yield
    finally:
        spark.conf.set(COALESCE, before)


def quoted(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def quoted_table(full_name: str) -> str:
    """A ``database.table`` name as a SQL identifier."""
    return ".".join(quoted(part) for part in full_name.split("."))


def literal(text: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop ``FileSystem`` that holds ``path``, and the path object."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a Hadoop glob: one metadata call, no data is read."""
    fs, target = hadoop_path(spark, pattern)
    found = fs.globStatus(target) or []
    return [status.getPath().toString() for status in found if status.isDirectory()]


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a data file lies under ``path``; stops at the first one.

    Names that start with ``_`` or ``.`` are markers or unfinished writes.
    """
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return False
    root = fs.getFileStatus(target).getPath().toString()
    files = fs.listFiles(target, True)
    while files.hasNext():
        inner = files.next().getPath().toString()[len(root) :].split("/")
        if not any(part.startswith(("_", ".")) for part in inner):
            return True
    return False


def partition_names(spark: SparkSession, path: str) -> list[str] | None:
    """The partition columns of the first data file under ``path``; None without one."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    root = fs.getFileStatus(target).getPath().toString()
    files = fs.listFiles(target, True)
    while files.hasNext():
        *folders, name = files.next().getPath().toString()[len(root) :].strip("/").split("/")
        if not any(part.startswith(("_", ".")) for part in (*folders, name)):
            return [folder.split("=", 1)[0] for folder in folders if "=" in folder]
    return None


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder and what lies in it, and make sure it is gone."""
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)
    if fs.exists(target):
        raise OSError(f"could not delete {path}")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files that lie directly in a folder; none if there is no folder."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target) if status.isFile()]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or a folder to a path at which nothing lies."""
    fs, there = hadoop_path(spark, target)
    fs.mkdirs(there.getParent())
    if not fs.rename(hadoop_path(spark, source)[1], there):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it is there as a whole or not at all."""
    fs, target = hadoop_path(spark, path)
    unfinished = f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.create(hadoop_path(spark, unfinished)[1])
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, unfinished, path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    return spark.read.text(path, wholetext=True).first()[0]
