"""Identifier casts and derived columns, each as one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.config import OPEN_PARAMETERS, DerivedColumn
from stepweave.session import quoted

# Fixed value: the ending that marks an identifier column.
ID_SUFFIX = "_id"


class ColumnError(ValueError):
    """A column rule that the step's output cannot meet."""


def _id_column(field: T.StructField) -> Column:
    column = F.col(quoted(field.name))
    kind = field.dataType
    if not field.name.lower().endswith(ID_SUFFIX) or isinstance(kind, T.StringType):
        return column
    if not isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType, T.NullType)):
        raise ColumnError(f"{field.name}: {kind.simpleString()} cannot become bigint")
    return column.cast("bigint").alias(field.name)


def cast_id_columns(df: DataFrame) -> DataFrame:
    """Columns named ``*_id`` (any case) that are not text become BIGINT, in place."""
    return df.select([_id_column(field) for field in df.schema.fields])


def _derived(column: DerivedColumn, parameters: Mapping[str, str]) -> Column:
    expression = column.expression
    if column.source == "param":
        name = column.source_expression
        if name not in OPEN_PARAMETERS or parameters.get(name) is None:
            raise ColumnError(f'there is no parameter "{name}"')
        expression = expression.replace(name, str(parameters[name]))
    return F.expr(expression).alias(column.alias)


def derive_columns(
    df: DataFrame,
    pre: Sequence[DerivedColumn] = (),
    post: Sequence[DerivedColumn] = (),
    parameters: Mapping[str, str] | None = None,
) -> DataFrame:
    """Derived columns before and after the source columns, in one ``select``.

    A ``param`` column has every occurrence of the parameter's name in its
    expression replaced by the parameter's value.
    """
    taken = {name.lower() for name in df.columns}
    for column in (*pre, *post):
        if column.alias.lower() in taken:
            raise ColumnError(f"derived column {column.alias} exists already")
        taken.add(column.alias.lower())
    given = parameters or {}
    before = [_derived(column, given) for column in pre]
    after = [_derived(column, given) for column in post]
    return df.select(*before, "*", *after)
