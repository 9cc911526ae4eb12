"""The job description: JSON text to frozen dataclasses, with defaults and limits."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

# Fixed values of the config vocabulary.
STEP_TYPE = "transformation"
SOURCE_CATEGORIES = ("object", "relationship")
LOOKUP_CATEGORY = "object"
WRITE_FILES_DEFAULT, WRITE_FILES_MIN, WRITE_FILES_MAX = 20, 1, 40
# Job parameters that may be placed in an expression; never the credentials.
OPEN_PARAMETERS = ("jobName", "batchId", "configFileFullPath")


class ConfigError(ValueError):
    """A job description that cannot be run."""


@dataclass(frozen=True)
class Source:
    path: str
    view: str
    cache: bool = False


@dataclass(frozen=True)
class LookupSpec:
    name: str
    kind: str
    path: str
    sql: str


@dataclass(frozen=True)
class DerivedColumn:
    expression: str
    alias: str
    source: str = ""
    source_expression: str = ""


@dataclass(frozen=True)
class Step:
    table: str
    sql: str
    category: str = ""
    sources: tuple[Source, ...] = ()
    lookups: tuple[LookupSpec, ...] = ()
    write_files: int = WRITE_FILES_DEFAULT
    partition_columns: tuple[str, ...] = ()
    pre: tuple[DerivedColumn, ...] = ()
    post: tuple[DerivedColumn, ...] = ()


@dataclass(frozen=True)
class Job:
    name: str
    batch_id: int
    database: str
    base_path: str
    log_table: str
    project: str = ""
    job_type: str = ""
    snapshot_views: tuple[str, ...] = ()
    steps: tuple[Step, ...] = ()
    parameters: dict[str, str] = field(default_factory=dict, hash=False)

    def table_name(self, step: Step) -> str:
        return f"{self.database}.{step.table}"

    def table_path(self, step: Step) -> str:
        return f"{self.base_path}/{step.table}"

    @property
    def log_table_name(self) -> str:
        return f"{self.database}.{self.log_table}"

    @property
    def log_path(self) -> str:
        return f"{self.base_path}/{self.log_table}"

    def sources(self) -> list[Source]:
        """Sources of the steps that may contribute some, each once."""
        wanted = (s for s in self.steps if s.category.lower() in SOURCE_CATEGORIES)
        return list(dict.fromkeys(source for step in wanted for source in step.sources))

    def lookups(self) -> list[LookupSpec]:
        """Lookups over all steps, each once."""
        return list(dict.fromkeys(spec for step in self.steps for spec in step.lookups))


def _text(node: dict[str, Any], key: str, default: str = "") -> str:
    value = node.get(key)
    if value is None:
        return default
    return (value if isinstance(value, str) else json.dumps(value)).strip()


def _required(node: dict[str, Any], key: str) -> str:
    value = _text(node, key)
    if not value:
        raise ConfigError(f'"{key}" is missing or empty')
    return value


def _nodes(node: dict[str, Any], key: str) -> list[dict[str, Any]]:
    """A list of objects: bare values are wrapped, a lone object is a list of one."""
    value = node.get(key)
    if value is None or (isinstance(value, str) and not value.strip()):
        return []
    if isinstance(value, dict):
        return [value]
    if isinstance(value, list):
        return [item if isinstance(item, dict) else {"value": item} for item in value]
    raise ConfigError(f'"{key}" must be a list or an object')


def write_files(value: str) -> int:
    """Files per write: a whole number within the limits, else the default."""
    try:
        wanted = int(value)
    except ValueError:
        return WRITE_FILES_DEFAULT
    return min(max(wanted, WRITE_FILES_MIN), WRITE_FILES_MAX)


def _source(node: dict[str, Any]) -> Source:
    return Source(
        path=_required(node, "sourcePath"),
        view=_required(node, "viewName"),
        cache=_text(node, "cacheFlag").lower() == "true",
    )


def _lookup(node: dict[str, Any]) -> LookupSpec:
    return LookupSpec(
        name=_required(node, "lookupListName"),
        kind=_required(node, "lookupListType").lower(),
        path=_required(node, "lookupListSourcePath"),
        sql=_required(node, "lookupListSourceSQL"),
    )


def _derived(node: dict[str, Any]) -> DerivedColumn:
    return DerivedColumn(
        expression=_required(node, "colExpression"),
        alias=_required(node, "colAlias").strip("`"),
        source=_text(node, "colSource").lower(),
        source_expression=_text(node, "colSourceExpression"),
    )


def _step(node: dict[str, Any]) -> Step:
    category = _text(node, "stepCategory")
    lookups = _nodes(node, "lookupList") if category.lower() == LOOKUP_CATEGORY else []
    return Step(
        table=_required(node, "hiveTableName"),
        sql=_required(node, "sourceJoinSQL"),
        category=category,
        sources=tuple(_source(n) for n in _nodes(node, "sourceJoinTableList")),
        lookups=tuple(_lookup(n) for n in lookups),
        write_files=write_files(_text(node, "numOfWriteRepartition")),
        partition_columns=tuple(_required(n, "value") for n in _nodes(node, "partitionColumnList")),
        pre=tuple(_derived(n) for n in _nodes(node, "preDerivedColumnList")),
        post=tuple(_derived(n) for n in _nodes(node, "postDerivedColumnList")),
    )


def _base_path(node: dict[str, Any]) -> str:
    path = _text(node, "basePath")
    if not path:
        path = f"s3a://{_required(node, 's3Bucket')}/{_required(node, 's3ProjectFolder')}"
    return path.rstrip("/")


def parse_job(config: str | dict[str, Any], parameters: dict[str, str]) -> Job:
    """Read a job description; ``parameters`` are the job arguments by name."""
    node = json.loads(config) if isinstance(config, str) else config
    try:
        batch_id = int(parameters["batchId"])
    except (KeyError, ValueError):
        raise ConfigError("the batchId parameter must be a whole number") from None
    views = (v.strip() for v in _text(node, "sourceJoinSnapshotTablesList").split(","))
    return Job(
        name=parameters.get("jobName", ""),
        batch_id=batch_id,
        project=_text(node, "projectName"),
        database=_required(node, "projectDB"),
        base_path=_base_path(node),
        log_table=_required(node, "jobLogTableName"),
        job_type=_text(node, "jobType").lower(),
        snapshot_views=tuple(v for v in views if v),
        steps=tuple(
            _step(n) for n in _nodes(node, "stepList") if _text(n, "stepType").lower() == STEP_TYPE
        ),
        parameters={k: str(v) for k, v in parameters.items()},
    )


def read_config(spark: SparkSession, path: str) -> str:
    """The text of a config file on any Hadoop filesystem."""
    return spark.read.text(path, wholetext=True).first()[0]
