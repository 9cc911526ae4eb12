"""Job entry for spark-submit: arguments are ``name=value`` job parameters."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from stepweave.plans.job import run_job_file


def main(arguments: list[str]) -> None:
    parameters = dict(a.split("=", 1) for a in arguments)
    builder = SparkSession.builder.appName(parameters.get("jobName", "stepweave"))
    run_job_file(builder.enableHiveSupport().getOrCreate(), parameters)


if __name__ == "__main__":
    main(sys.argv[1:])
