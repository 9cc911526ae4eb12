"""Text objects and file listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.operators.lookup_index import reachable
from stepweave.session import ship_package
from stepweave.sources.inventory import NAME, Inventory

# Headers of objects are broadcast up to this many.
BROADCAST_OBJECTS = 100_000


def file_inventory(
    spark: SparkSession, path: str, start_after: str | None = None, limit: int | None = None
) -> DataFrame:
    """Data files under ``path`` as (path, modified, size); contents are not read.

    ``start_after`` leaves out paths up to and including that one; ``limit`` keeps
    the first files in path order.  Folders that lie before the start, or behind the
    last file of a limit, are not listed.
    """
    if not reachable(path, create=False):  # Spark lists all, then leaves out
        return _listed(spark, path, start_after, limit)
    ship_package(spark)
    spark.dataSource.register(Inventory)
    reader = spark.read.format(NAME).option("path", path)
    if start_after is not None:
        reader = reader.option("startAfter", start_after)
    if limit is not None:
        reader = reader.option("limit", str(limit))
    return reader.load()


def _listed(
    spark: SparkSession, path: str, start_after: str | None, limit: int | None
) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    )
    if start_after is not None:
        files = files.where(F.col("path") > start_after)
    return files if limit is None else files.orderBy("path").limit(limit)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text as one row per line."""
    return spark.read.text(path)


def read_whole(spark: SparkSession, path: str, newline: str | None = "\r\n") -> DataFrame:
    """Text as one row per file.

    Line ends become ``newline`` and the last one is dropped; ``None`` keeps the
    text as it is.
    """
    text = spark.read.text(path, wholetext=True)
    if newline is None:
        return text
    trimmed = F.regexp_replace("value", r"(\r\n|\r|\n)\z", "")
    return text.select(F.regexp_replace(trimmed, r"\r\n|\r|\n", newline).alias("value"))


def read_header_map(
    spark: SparkSession, path: str, delimiter: str = ",", object_column: str | None = None
) -> DataFrame:
    """Delimited text objects as one map per line, keyed by its object's first line.

    ``delimiter`` is a regular expression and there is no quoting.  Empty fields at
    the end of a line are dropped, short lines lack keys, and more fields than the
    header is an error.  An object's header is the first row of its first split,
    so a large object is still read in parallel.  Objects may have different headers;
    ``object_column`` names a column for their paths.  Empty objects give no rows, and
    nothing but empty ones is an error.
    """
    text = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("object"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    lines = text.withColumn("position", F.monotonically_increasing_id())
    shown = [] if object_column is None else [F.col("object").alias(object_column)]
    if len(text.inputFiles()) == 1:
        first = lines.select(_fields(F.col("value"), delimiter)).first()
        if first is None:
            raise ValueError(f"{path} has no header line")
        names = F.array(*map(F.lit, first[0])).cast("array<string>")
        below = lines.where("position > 0")
        return below.select(*shown, _attributes(names, delimiter).alias("attributes"))
    # Only first splits are read for the headers: a row of each object.
    headers = (
        lines.where("start = 0")
        .groupBy("object")
        .agg(F.min(F.struct("position", "value")).alias("first"))
        .select(
            "object",
            F.col("first.position").alias("header_position"),
            _fields(F.col("first.value"), delimiter).alias("names"),
        )
    )
    some = headers.limit(BROADCAST_OBJECTS + 1).count()
    if not some:
        raise ValueError(f"{path} has no header line")
    told = lines.join(F.broadcast(headers) if some <= BROADCAST_OBJECTS else headers, "object")
    below = told.where("position <> header_position")
    return below.select(*shown, _attributes(F.col("names"), delimiter).alias("attributes"))


def _attributes(names: Column, delimiter: str) -> Column:
    """A line's fields by the names of its header; of a name used twice the last field."""
    fields = _fields(F.col("value"), delimiter)
    count = F.size(fields)
    pairs = F.arrays_zip(F.slice(names, 1, count).alias("key"), fields.alias("value"))
    last = F.filter(
        pairs,
        lambda pair, i: ~F.array_contains(F.slice(names, i + 2, count - i - 1), pair["key"]),
    )
    pairs = F.when(F.size(F.array_distinct(names)) < F.size(names), last).otherwise(pairs)
    surplus = F.raise_error(F.concat(F.lit("more fields than the header: "), F.col("value")))
    return F.when(count > F.size(names), surplus).otherwise(F.map_from_entries(pairs))


def _fields(value, delimiter: str):
    """Split; keep up to the last field that is not empty, or a lone empty field."""
    parts = F.split(value, delimiter, -1)
    kept = F.array_max(F.transform(parts, lambda part, i: F.when(part != "", i + 1).otherwise(0)))
    return F.when(F.size(parts) == 1, parts).otherwise(F.slice(parts, 1, kept))
