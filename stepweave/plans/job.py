"""A whole job: sources, lookups, steps in order, job log."""

from __future__ import annotations

import contextlib
from typing import Any

from pyspark.sql import SparkSession

from stepweave.config import Job, parse_job, read_config
from stepweave.operators.joblog import JobLog, refresh_log_table
from stepweave.operators.lookups import build_lookup, register_sql_functions
from stepweave.plans.step import StepFailed, run_step
from stepweave.session import run_scratch
from stepweave.sources.parquet import load_source


def prepare(
    spark: SparkSession, job: Job, log: JobLog, release: contextlib.ExitStack
) -> None:
    """Register the sources' views, then the lookups' views and SQL functions.

    What is held for the job is released by ``release``.
    """
    for source in job.sources():
        log.info("read sources", f"{source.view} comes from {source.path}")
        df = load_source(spark, source, job)
        if source.cache:
            release.callback(df.unpersist)
    lookups = {}
    for spec in job.lookups():
        lookup = build_lookup(spark, spec)
        if lookup is not None:
            lookups[spec.name] = lookup
            release.callback(lookup.release)
            log.info("build lookups", f"{spec.name} has {lookup.rows} keys")
    register_sql_functions(spark, lookups.values())


def run_job(
    spark: SparkSession, config: str | dict[str, Any], parameters: dict[str, str]
) -> list[str]:
    """Run a job description (JSON text or a dict); gives the published tables.

    Steps run in order; each is parallel in itself.  The first failure is logged
    and raised, and no further step starts.  At the end, good or bad, cached sources,
    lookups and the run's scratch are released.
    """
    job = parse_job(config, parameters)
    log = JobLog(spark, job.log_path, job.name, job.batch_id)
    tables = []
    parent, child = "run_job", "prepare"
    with contextlib.ExitStack() as release:
        release.enter_context(run_scratch(spark))
        try:
            if job.steps:
                prepare(spark, job, log, release)
            else:
                log.warn("read the job", "it has no steps")
            for step in job.steps:
                child = job.table_name(step)
                tables.append(run_step(spark, job, step, log))
            parent, child = "refresh_log_table", job.log_table_name
            log.flush()
            batch = job.name, job.batch_id
            refresh_log_table(spark, job.log_table_name, job.log_path, batch)
        except Exception as error:
            if isinstance(error, StepFailed):
                child = f"{child}, {error.stage}"
            log.error(f"{parent}, {child}", f"failed: {error}")
            raise
    return tables


def run_job_file(spark: SparkSession, parameters: dict[str, str]) -> list[str]:
    """Run the job described in the file that ``configFileFullPath`` names."""
    return run_job(spark, read_config(spark, parameters["configFileFullPath"]), parameters)
