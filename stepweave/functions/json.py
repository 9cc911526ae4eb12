"""JSON access for columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.functions.json_pieces import split_documents
from stepweave.session import quoted, ship_package

# Documents above this may not fit into a variant.
LARGE_BYTES = 64 * 1024 * 1024
# Fixed value: what a missing or null attribute reads as.
NULL_TEXT = "null_string"


def _path(path: str) -> str:
    return path if path.startswith("$") else f"$.{path}"


def json_attr(column: Column | str, path: str, null_text: str = NULL_TEXT) -> Column:
    """The value at ``path`` as text; missing, null and unreadable give ``null_text``."""
    source = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.get_json_object(source, _path(path)), F.lit(null_text))


def json_nodes(
    df: DataFrame, column: str, path: str, output: str = "node", large: bool = False
) -> DataFrame:
    """One row per node at ``path``, the node as JSON object text in ``output``.

    An array gives its elements, bare values wrapped as ``{"value": x}``; a lone
    object gives itself; nothing or blank text gives no row; any other bare value is
    an error.  So is a document that cannot be read: it is no JSON, or larger than a
    variant may be.  The keys of an object come in alphabetical order.

    With ``large`` documents above ``LARGE_BYTES`` are read too: their text is walked once
    and each element is read for itself.  The result then lacks ``column``, which every
    row of a large document would hold.
    """
    if large:
        size = F.coalesce(F.octet_length(column), F.lit(0))
        rest = [c for c in df.columns if c != column]
        usual = json_nodes(df.where(size <= LARGE_BYTES), column, path, output).drop(column)
        return usual.unionByName(_large_nodes(df.where(size > LARGE_BYTES), column, path, output, rest))
    document = F.try_parse_json(F.col(column))
    size = F.octet_length(column).cast("string")
    unread = F.raise_error(F.concat(F.lit("not JSON, or too large: bytes "), size))
    # Inside the path's input, so that no document is passed over unread.
    blank = F.col(column).isNull() | (F.trim(F.col(column)) == "")
    read = F.when(~blank, F.coalesce(document, unread.cast("variant")))
    parsed = F.try_variant_get(read, _path(path), "variant")
    # Columns of their own, so that each is computed once.
    found = df.withColumn("__found", parsed)
    found = found.withColumn("__kind", F.schema_of_variant("__found"))
    return found.withColumn(output, F.explode(_objects(F.col("__found"), F.col("__kind")))).drop(
        "__found", "__kind"
    )


def _large_nodes(
    df: DataFrame, column: str, path: str, output: str, names: list[str]
) -> DataFrame:
    ship_package(df.sparkSession)
    fields = [df.schema[name] for name in names]
    schema = T.StructType(
        [*fields, T.StructField("__piece", T.StringType()), T.StructField("__inside", T.BooleanType())]
    )
    split = df.select(*map(quoted, names), quoted(column)).mapInArrow(
        split_documents(column, path, names), schema
    )
    unread = F.raise_error(F.concat(F.lit("not JSON: "), F.substring("__piece", 1, 100)))
    element = F.coalesce(F.try_parse_json("__piece"), unread.cast("variant"))
    read = split.withColumn("__element", element)
    read = read.withColumn("__kind", F.schema_of_variant("__element"))
    lone = _objects(F.col("__element"), F.col("__kind"))
    nodes = F.when(F.col("__inside"), F.array(_as_object(F.col("__element")))).otherwise(lone)
    return read.select(*map(quoted, names), F.explode(nodes).alias(output))


def _objects(found: Column, kind: Column) -> Column:
    blank = (kind == "STRING") & (F.trim(found.cast("string")) == "")
    return (
        F.when(found.isNull() | (kind == "VOID") | blank, F.array().cast("array<string>"))
        .when(kind.startswith("ARRAY"), F.transform(found.cast("array<variant>"), _as_object))
        .when(kind.startswith("OBJECT"), F.array(F.to_json(found)))
        .otherwise(F.raise_error(F.concat(F.lit("no JSON object or array: "), F.to_json(found))))
    )


def _as_object(element: Column) -> Column:
    text = F.coalesce(F.to_json(element), F.lit("null"))
    wrapped = F.concat(F.lit('{"value":'), text, F.lit("}"))
    return F.when(F.schema_of_variant(element).startswith("OBJECT"), text).otherwise(wrapped)
