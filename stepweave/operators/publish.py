"""Publication: partitioned Parquet with replacement by effective-time key.

A partitioned output is written whole to a staging folder of its own.  What it holds is
then recorded as an intent beside the data, and only after that the partitions are put in
place.  Whoever publishes next finishes an intent that was recorded, and clears staging
that was not; so a run may stop anywhere.  One run at a time may publish to a path.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.config import WRITE_FILES_DEFAULT
from stepweave.session import (
    delete_folder,
    file_names,
    matching_folders,
    move,
    partition_names,
    quoted,
    read_text,
    uncoalesced,
    write_text,
)

# The effective-time key, and how a null partition value is written.
EFFECTIVE_KEY = "business_effective_timestamp"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Beside the data; readers pass over names that start so.
_STAGING, _INTENTS = "_staging", "_intents"


class PublishError(ValueError):
    """An output that cannot be published."""


@dataclass(frozen=True)
class Manifest:
    """The partitions that a publication put in place and those that it removed."""

    columns: tuple[str, ...] = ()
    added: tuple[tuple[str | None, ...], ...] = ()
    removed: tuple[tuple[str | None, ...], ...] = ()

    def then(self, later: Manifest) -> Manifest:
        """What this publication and a later one did together."""
        added = dict.fromkeys(v for v in self.added if v not in set(later.removed))
        removed = dict.fromkeys(v for v in self.removed if v not in set(later.added))
        return Manifest(
            later.columns or self.columns,
            tuple(added | dict.fromkeys(later.added)),
            tuple(removed | dict.fromkeys(later.removed)),
        )


def distinct_effective_keys(df: DataFrame) -> DataFrame:
    """The effective-time keys that ``df`` holds, each once."""
    return df.select(EFFECTIVE_KEY).distinct()


def _checked(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """``df``, made to fail while it is written if a row has no effective-time key."""
    absent = [c for c in (EFFECTIVE_KEY, *partition_columns) if c not in df.columns]
    if absent:
        raise PublishError(f"not in the output: {', '.join(absent)}")
    if not isinstance(df.schema[EFFECTIVE_KEY].dataType, T.LongType):
        raise PublishError(f"{EFFECTIVE_KEY} must be bigint")
    missing = F.raise_error(F.lit(f"{EFFECTIVE_KEY} is null"))
    return df.withColumn(EFFECTIVE_KEY, F.coalesce(EFFECTIVE_KEY, missing))


def _check_layout(df: DataFrame, path: str, partition_columns: Sequence[str]) -> None:
    """Before anything is written: another partition list would leave old rows behind."""
    there = partition_names(df.sparkSession, path)
    if there is not None and there != list(partition_columns):
        raise PublishError(
            f"{path} is partitioned by ({', '.join(there)}), not by ({', '.join(partition_columns)})"
        )


def _laid_out(df: DataFrame, partition_columns: Sequence[str], files: int) -> DataFrame:
    """Rows of a partition brought together, so that it gets few and large files.

    There are at least ``files`` write tasks.  With partition columns there are as
    many as the session shuffles to, or a task would hold, and split, many
    partitions.  Adaptive execution splits a task above the advisory size, so one
    hot key is written by many tasks.
    """
    columns = [F.col(quoted(c)) for c in partition_columns]
    if columns:
        files = max(files, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.hint("rebalance", files, *columns)


def _write(df: DataFrame, path: str, mode: str, partition_columns: Sequence[str]) -> None:
    writer = df.write.mode(mode)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    with uncoalesced(df.sparkSession):
        writer.parquet(path)


def write_append(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = (),
    files: int = WRITE_FILES_DEFAULT,
) -> Manifest:
    """Append ``df`` to the dataset at ``path``, which must have the same partitions."""
    before = finish_intents(df.sparkSession, path)
    _check_layout(df, path, partition_columns)
    laid_out = _laid_out(df, partition_columns, files)
    if partition_columns:
        return before.then(_publish(laid_out, path, partition_columns, replace=False))
    _write(laid_out, path, "append", ())
    return before


def replace_by_key(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = (),
    files: int = WRITE_FILES_DEFAULT,
) -> Manifest:
    """Publish ``df`` so that a re-run leaves the same rows.

    Every effective-time key in ``df`` replaces all rows published under that key,
    in whatever other partitions they are; other keys stay.  Without the key among
    the partition columns nothing is replaced and the rows are appended.

    One pass over ``df``; readers see the old rows until all new ones are written.
    """
    df = _checked(df, partition_columns)
    if EFFECTIVE_KEY not in partition_columns:
        return write_append(df, path, partition_columns, files)
    before = finish_intents(df.sparkSession, path)
    _check_layout(df, path, partition_columns)
    laid_out = _laid_out(df, partition_columns, files)
    return before.then(_publish(laid_out, path, partition_columns, replace=True))


def _publish(
    df: DataFrame, path: str, partition_columns: Sequence[str], replace: bool
) -> Manifest:
    intent = stage(df, path, partition_columns, replace)
    return _apply(df.sparkSession, path.rstrip("/"), intent)


def stage(df: DataFrame, path: str, partition_columns: Sequence[str], replace: bool) -> dict:
    """Write the rows beside the data, and record what they are to become.

    From here on :func:`finish_intents` publishes them, should this run end.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = uuid.uuid4().hex
    staging = f"{path}/{_STAGING}/{name}"
    try:
        _write(df, staging, "errorifexists", partition_columns)
    except Exception:
        delete_folder(spark, staging)
        raise
    # Only what this run wrote is listed.
    pattern = "/".join([staging, *(f"{_globbed(c)}=*" for c in partition_columns)])
    folders = [_relative(f, len(partition_columns)) for f in matching_folders(spark, pattern)]
    intent = {
        "name": name,
        "columns": list(partition_columns),
        "replace": replace,
        "partitions": sorted(folders),
    }
    write_text(spark, f"{path}/{_INTENTS}/{name}.json", json.dumps(intent))
    return intent


def finish_intents(spark: SparkSession, path: str) -> Manifest:
    """Finish what runs that died had recorded, and clear what they had only staged."""
    path = path.rstrip("/")
    found = Manifest()
    for name in sorted(file_names(spark, f"{path}/{_INTENTS}")):
        if name.endswith(".json"):
            intent = json.loads(read_text(spark, f"{path}/{_INTENTS}/{name}"))
            found = found.then(_apply(spark, path, intent))
    for folder in matching_folders(spark, f"{path}/{_STAGING}/*"):
        delete_folder(spark, folder)
    return found


def _apply(spark: SparkSession, path: str, intent: dict) -> Manifest:
    """Put staged partitions in place; what an earlier attempt has done is left alone.

    A staged partition that is gone is in place already.  Partitions of the replaced keys
    that are not among the staged ones are stale; one listing finds them.
    """
    columns, kept = intent["columns"], set(intent["partitions"])
    staging = f"{path}/{_STAGING}/{intent['name']}"
    stale = _of_keys(spark, path, columns, kept) - kept if intent["replace"] else set()
    for folder in sorted(stale):
        delete_folder(spark, f"{path}/{folder}")
    pattern = "/".join([staging, *(f"{_globbed(c)}=*" for c in columns)])
    for staged in matching_folders(spark, pattern):
        target = f"{path}/{_relative(staged, len(columns))}"
        if intent["replace"]:
            delete_folder(spark, target)
            move(spark, staged, target)
        else:  # names of files are never used twice
            for file in file_names(spark, staged):
                move(spark, f"{staged}/{file}", f"{target}/{file}")
    delete_folder(spark, staging)
    delete_folder(spark, f"{path}/{_INTENTS}/{intent['name']}.json")
    return Manifest(
        tuple(columns), tuple(map(_values, sorted(kept))), tuple(map(_values, sorted(stale)))
    )


def _of_keys(spark: SparkSession, path: str, columns: Sequence[str], folders: set[str]) -> set[str]:
    """All partitions there are under the keys of these partitions."""
    if not folders:
        return set()
    place = list(columns).index(EFFECTIVE_KEY)
    keys = sorted({folder.split("/")[place].split("=", 1)[1] for folder in folders})
    levels = [f"{_globbed(c)}={'{' + ','.join(keys) + '}' if i == place else '*'}" for i, c in enumerate(columns)]
    found = matching_folders(spark, "/".join([path, *levels]))
    return {_relative(folder, len(columns)) for folder in found}


def _globbed(column: str) -> str:
    """A column's name in a pattern of paths; odd characters match any one."""
    return "".join(c if c.isalnum() or c == "_" else "*" for c in column)


def _relative(folder: str, levels: int) -> str:
    return "/".join(folder.rsplit("/", levels)[1:])


def _values(folder: str) -> tuple[str | None, ...]:
    """The partition's values as text; None for the one that stands for null."""
    values = (unquote(level.split("=", 1)[1]) for level in folder.split("/"))
    return tuple(None if value == NULL_PARTITION else value for value in values)
