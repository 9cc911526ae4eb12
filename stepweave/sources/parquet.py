"""Parquet sources and the views that step SQL reads."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from stepweave.config import Job, Source
from stepweave.session import has_files, matching_folders, quoted_table, scratch_path

# The snapshot column, and where a materialised source starts.
SNAPSHOT_COLUMN = "batch_id"
MATERIALIZED_PARTITIONS = 200


class SourceError(RuntimeError):
    """A source that cannot be read."""


def scan_parquet_merged(spark: SparkSession, path: str) -> DataFrame:
    """All files under ``path``; file schemas are united by name, gaps read as null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def _snapshot_order(value: str) -> tuple[bool, int, str]:
    return (True, int(value), value) if value.isdigit() else (False, 0, value)


def latest_snapshot(spark: SparkSession, path: str) -> str:
    """The id of the newest snapshot that holds files.

    Only the folder names one level down are listed, so the cost depends on the
    number of snapshots and not on how many files they hold.  Ids made of digits
    compare as numbers, others as text.
    """
    prefix = f"{SNAPSHOT_COLUMN}="
    folders = {f.rsplit(prefix, 1)[1]: f for f in matching_folders(spark, f"{path}/{prefix}*")}
    for snapshot in sorted(folders, key=_snapshot_order, reverse=True):
        if has_files(spark, folders[snapshot]):
            return snapshot
    raise SourceError(f"no snapshot with files under {path}")


def scan_latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot only.  Reading its folder directly leaves out the id column
    and lists, and merges the footers of, no other snapshot's files."""
    path = path.rstrip("/")
    newest = latest_snapshot(spark, path)
    return scan_parquet_merged(spark, f"{path}/{SNAPSHOT_COLUMN}={newest}")


def materialize(df: DataFrame, path: str, partitions: int = MATERIALIZED_PARTITIONS) -> DataFrame:
    """Write ``df`` evenly and read it back: cuts lineage and fixes the file layout.

    ``partitions`` is where the exchange starts; adaptive execution splits what
    exceeds the advisory size and joins what is far below it.
    """
    df.hint("rebalance", partitions).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_historical(
    spark: SparkSession, path: str, target: str, partitions: int = MATERIALIZED_PARTITIONS
) -> DataFrame:
    """The whole directory, re-materialised under ``target``."""
    return materialize(scan_parquet_merged(spark, path), target, partitions)


def register_view(df: DataFrame, name: str, cache: bool = False) -> DataFrame:
    """Expose ``df`` to SQL under ``name``; the last registration wins."""
    if cache:
        df = df.persist(StorageLevel.DISK_ONLY)
    df.createOrReplaceTempView(name)
    return df


def table_exists(spark: SparkSession, full_name: str) -> bool:
    return spark.catalog.tableExists(quoted_table(full_name))


def load_source(spark: SparkSession, source: Source, job: Job) -> DataFrame:
    """Read one source in the job's mode and register its view."""
    if job.job_type == "daily" and source.view in job.snapshot_views:
        df = scan_latest_snapshot(spark, source.path)
    elif job.job_type == "historical":
        df = scan_historical(spark, source.path, scratch_path(spark, f"checkpoint/{source.view}"))
    else:
        df = scan_parquet_merged(spark, source.path)
    return register_view(df, source.view, source.cache)
