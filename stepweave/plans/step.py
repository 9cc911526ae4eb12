"""One step: its SQL, identifier casts, derived columns and publication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stepweave.config import Job, Step
from stepweave.operators.catalog import check_table, refresh_table
from stepweave.operators.columns import cast_id_columns, derive_columns
from stepweave.operators.joblog import JobLog
from stepweave.operators.publish import replace_by_key
from stepweave.sources.parquet import register_view


# The views of a step's stages, before the table's name with ``_`` for ``.``.
SQL_VIEW, CAST_VIEW, OUTPUT_VIEW = "dfSource0__", "dfSource__", "dfSource__DerivedColumns__"


def sql_step(spark: SparkSession, step: Step) -> DataFrame:
    """The step's SQL over the registered views and lookup functions, as it is."""
    return spark.sql(step.sql)


def step_output(
    spark: SparkSession, step: Step, parameters: Mapping[str, str], table: str | None = None
) -> DataFrame:
    """What a step publishes; nothing runs yet.

    Each stage is also a view that later SQL may read.
    """
    name = (table or step.table).replace(".", "_")
    source = register_view(sql_step(spark, step), SQL_VIEW + name)
    cast = register_view(cast_id_columns(source), CAST_VIEW + name)
    return register_view(derive_columns(cast, step.pre, step.post, parameters), OUTPUT_VIEW + name)


class StepFailed(RuntimeError):
    """A step's error, with the stage in which it came up."""

    def __init__(self, table: str, stage: str, cause: Exception):
        super().__init__(f"{table}, {stage}: {cause}")
        self.stage = stage


def run_step(spark: SparkSession, job: Job, step: Step, log: JobLog) -> str:
    """Compute and publish one step; gives the table's name."""
    table, path = job.table_name(step), job.table_path(step)
    stage = "Generate output"
    try:
        log.info(stage, f'For table "{table}", start generating the output.')
        output = step_output(spark, step, job.parameters, table)
        check_table(spark, table, output.schema, path, step.partition_columns)
        stage = "Replace by key and write"
        log.info(stage, f'For table "{table}", start writing to {path}.')
        manifest = replace_by_key(output, path, step.partition_columns, step.write_files)
        stage = "Refresh table"
        log.info(stage, f'For table "{table}", start refreshing the catalog table.')
        refresh_table(spark, table, output.schema, path, step.partition_columns, manifest)
    except Exception as cause:
        raise StepFailed(table, stage, cause) from cause
    log.flush()
    return table
