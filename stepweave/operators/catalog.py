"""External catalog tables over published Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stepweave.operators.publish import Manifest
from stepweave.session import hadoop_path, literal, quoted, quoted_table
from stepweave.sources.parquet import table_exists

# Partitions of one statement.
PARTITIONS_AT_ONCE = 500


class CatalogError(ValueError):
    """A catalog table that does not fit the output."""


def column_type(kind: T.DataType, partition: bool = False) -> str:
    """The catalog's name of a type; a timestamp partition is kept as text."""
    if partition and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "string"
    return kind.simpleString()


def _columns(schema: T.StructType, partition_columns: Sequence[str]) -> list[str]:
    """Data columns in schema order, then partition columns in config order."""
    return [n for n in schema.names if n not in partition_columns] + list(partition_columns)


def _definition(schema: T.StructType, name: str, partition_columns: Sequence[str]) -> str:
    kind = column_type(schema[name].dataType, name in partition_columns)
    return f"{quoted(name)} {kind}"


def create_external_table(
    spark: SparkSession,
    full_name: str,
    schema: T.StructType,
    path: str,
    partition_columns: Sequence[str] = (),
) -> None:
    """Create the table over ``path`` and register its partitions."""
    absent = [c for c in partition_columns if c not in schema.names]
    if absent:
        raise CatalogError(f"{full_name}: no such partition column: {', '.join(absent)}")
    table = quoted_table(full_name)
    names = _columns(schema, partition_columns)
    columns = ", ".join(_definition(schema, n, partition_columns) for n in names)
    by = f"PARTITIONED BY ({', '.join(map(quoted, partition_columns))})" if partition_columns else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING PARQUET {by} LOCATION {literal(path)}")
    if partition_columns:
        repair_partitions(spark, full_name)


def repair_partitions(spark: SparkSession, full_name: str) -> None:
    """Register new partition folders, and forget the ones that are gone.

    Lists all of the table; after a publication :func:`register_partitions` is enough.
    """
    spark.sql(f"MSCK REPAIR TABLE {quoted_table(full_name)} SYNC PARTITIONS")


def register_partitions(spark: SparkSession, full_name: str, manifest: Manifest) -> None:
    """Register the partitions that a publication put in place, and forget those that it
    removed; nothing is listed."""
    table = quoted_table(full_name)
    for verb, values in (
        ("DROP IF EXISTS", manifest.removed),
        ("ADD IF NOT EXISTS", manifest.added),
    ):
        between = ", " if verb.startswith("DROP") else " "
        for start in range(0, len(values), PARTITIONS_AT_ONCE):
            some = (_partition(manifest.columns, v) for v in values[start : start + PARTITIONS_AT_ONCE])
            spark.sql(f"ALTER TABLE {table} {verb} {between.join(some)}")


def _partition(columns: Sequence[str], values: Sequence[str | None]) -> str:
    pairs = zip(columns, values, strict=True)
    spec = (f"{quoted(c)}={'NULL' if v is None else literal(v)}" for c, v in pairs)
    return f"PARTITION ({', '.join(spec)})"


def check_table(
    spark: SparkSession,
    full_name: str,
    schema: T.StructType,
    path: str,
    partition_columns: Sequence[str] = (),
) -> bool:
    """Whether the table exists; an error if it is not one over these rows at this path.

    To be called before anything is written.  Another place, format, partition list or
    type of a column is an error; new data columns are not.
    """
    absent = [c for c in partition_columns if c not in schema.names]
    if absent:
        raise CatalogError(f"{full_name}: no such partition column: {', '.join(absent)}")
    if not table_exists(spark, full_name):
        return False
    table = quoted_table(full_name)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    details = {row.col_name: row.data_type for row in described}  # they come after the columns
    place, wanted = (_qualified(spark, p) for p in (details.get("Location", ""), path))
    if place != wanted:
        raise CatalogError(f"{full_name} lies at {place}, not at {wanted}")
    if details.get("Provider", "").lower() != "parquet":
        raise CatalogError(f"{full_name} is {details.get('Provider')}, not parquet")
    by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if [c.lower() for c in by] != [c.lower() for c in partition_columns]:
        raise CatalogError(
            f"{full_name} is partitioned by ({', '.join(by)}), not by ({', '.join(partition_columns)})"
        )
    known = _types(spark, table)
    changed = [
        n
        for n in schema.names
        if known.get(n.lower(), "") not in ("", column_type(schema[n].dataType, n in partition_columns))
    ]
    if changed:
        raise CatalogError(f"{full_name}: the type differs for {', '.join(changed)}")
    return True


def _types(spark: SparkSession, table: str) -> dict[str, str]:
    return {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema.fields}


def _qualified(spark: SparkSession, path: str) -> str:
    if not path:
        return ""
    fs, target = hadoop_path(spark, path)
    return fs.makeQualified(target).toString().rstrip("/")


def refresh_table(
    spark: SparkSession,
    full_name: str,
    schema: T.StructType,
    path: str,
    partition_columns: Sequence[str] = (),
    manifest: Manifest | None = None,
) -> None:
    """Bring the catalog up to date: create an absent table, add new columns to an
    existing one, and register partitions.

    With the ``manifest`` of a publication only its partitions are registered; without,
    all of the table is listed.
    """
    if not check_table(spark, full_name, schema, path, partition_columns):
        create_external_table(spark, full_name, schema, path, partition_columns)
        return
    table = quoted_table(full_name)
    known = _types(spark, table)
    new = [n for n in schema.names if n.lower() not in known]
    if new:
        columns = ", ".join(_definition(schema, n, partition_columns) for n in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    if partition_columns and manifest is not None:
        register_partitions(spark, full_name, manifest)
    elif partition_columns:
        repair_partitions(spark, full_name)
    spark.catalog.refreshTable(table)
