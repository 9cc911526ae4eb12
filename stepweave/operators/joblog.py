"""The job log: records appended as Parquet, and the table over them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stepweave.operators.catalog import refresh_table
from stepweave.operators.publish import Manifest

# The log's columns and partitions, and its time format.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("level", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("msg", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
LOG_PARTITIONS = ("job_name", "batch_id")
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


class JobLog:
    """Collects records and writes them together, one small file per flush."""

    def __init__(self, spark: SparkSession, path: str, job_name: str, batch_id: int):
        self._spark = spark
        self._path = path
        self._job = (job_name, batch_id)
        self._records: list[tuple] = []

    def info(self, step: str, msg: str) -> None:
        self._add("INFO", step, msg)

    def warn(self, step: str, msg: str) -> None:
        self._add("WARN", step, msg)

    def error(self, step: str, msg: str) -> None:
        """An error is written at once."""
        self._add("ERROR", step, msg)
        self.flush()

    def _add(self, level: str, step: str, msg: str) -> None:
        time = datetime.now().strftime(TIME_FORMAT)
        self._records.append((level, time, step, msg, *self._job))
        print(f"{time} {level}:{msg}")

    def flush(self) -> None:
        if not self._records:
            return
        records = self._spark.createDataFrame(self._records, LOG_SCHEMA).coalesce(1)
        records.write.mode("append").partitionBy(*LOG_PARTITIONS).parquet(self._path)
        self._records.clear()


def refresh_log_table(
    spark: SparkSession, full_name: str, path: str, job: tuple[str, int] | None = None
) -> None:
    """Create the log table if it is absent, and register its partitions: that of ``job``,
    a name and a batch, or all."""
    manifest = None
    if job is not None:
        manifest = Manifest(LOG_PARTITIONS, ((job[0] or None, str(job[1])),))
    refresh_table(spark, full_name, LOG_SCHEMA, path, LOG_PARTITIONS, manifest)
