"""Lookups: build them, decode delimited cells with them, call them from SQL.

Three ways to decode, with the same results:

* *broadcast* - a lookup of proven small size is broadcast and each cell is decoded where
  it lies.  The facts are not shuffled at all.
* *sharded* - a larger one is written as sorted files to the shared folder, once; tasks
  open the files that their rows ask for.  The facts are not shuffled either.
* *joined* - where Python cannot open the shared folder, distinct cells are taken apart,
  joined and put together again, then joined back to the facts.

All lookups of a session together are broadcast up to one limit.
"""

from __future__ import annotations

import weakref
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.config import LookupSpec
from stepweave.functions import cells as arrow_cells
from stepweave.functions import codes
from stepweave.operators.lookup_index import MemoryIndex, build_shards, reachable
from stepweave.session import (
    drop_scratch,
    literal,
    quoted,
    scratch_path,
    shared_folder,
    ship_package,
)
from stepweave.sources.parquet import materialize, register_view, scan_parquet_merged

# The two kinds of lookup, with the type of their keys.
KEY_TYPES = {"id": "bigint", "user": "string"}
# The SQL names, by kind.
SQL_NAMES = {"id": "lookupValueByIdList", "user": "lookupValueByUserList"}

# The lookups of a session are broadcast up to this many bytes together, counting each
# row's index entry: every Python worker holds them.
BROADCAST_BYTES = 128 * 1024 * 1024
BROADCAST_SETTING = "spark.stepweave.lookup.broadcastBytes"
INDEX_ENTRY_BYTES = 200
# Cells that hold more than one in this many rows are hot; so there are fewer of them.
# The rows of a hot cell meet as many copies of its text as they are times as many.
HOT_SHARE = 20_000
# Rows without a cell are spread over this many keys.
SPREAD = 4096


class LookupBuildError(ValueError):
    """A lookup that cannot be built."""


class BroadcastBudget:
    """What a session may broadcast, and what its lookups have taken of it."""

    _of_sessions: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()

    def __init__(self) -> None:
        self.taken = 0

    @classmethod
    def of(cls, spark: SparkSession) -> BroadcastBudget:
        """The budget that all lookups of a session share."""
        context = spark.sparkContext
        if context not in cls._of_sessions:
            cls._of_sessions[context] = cls()
        return cls._of_sessions[context]

    def take(self, size: int, limit: int) -> bool:
        """Whether ``size`` more bytes fit; if so they are taken."""
        if self.taken + size > limit:
            return False
        self.taken += size
        return True

    def give_back(self, size: int) -> None:
        self.taken -= size


@dataclass(frozen=True, eq=False)
class Lookup:
    """Unique, non-null (key, label) rows, how large they are and how they are probed."""

    name: str
    kind: str
    frame: DataFrame
    rows: int
    size: int
    way: str  # broadcast, sharded or joined
    # The index, once it has been made: every use shares it.
    shared: list = field(default_factory=list, repr=False)
    # Folders of the shared folder that hold it.
    folders: list = field(default_factory=list, repr=False)

    @property
    def broadcast(self) -> bool:
        return self.way == "broadcast"

    def release(self) -> None:
        """Give back what the lookup holds: broadcast, files and cached rows.

        Nothing that decodes with it may run afterwards.
        """
        self.frame.unpersist()
        while self.shared:
            self.shared.pop().destroy()
        if self.broadcast and self.size:
            BroadcastBudget.of(self.frame.sparkSession).give_back(self.size)
            object.__setattr__(self, "size", 0)
        while self.folders:
            drop_scratch(self.frame.sparkSession, self.folders.pop())


def build_lookup(
    spark: SparkSession, spec: LookupSpec, broadcast_bytes: int | None = None, way: str = ""
) -> Lookup | None:
    """Read a lookup, expose it as a view and run its SQL; other kinds build nothing.

    The first column is the key, the second the label.  A key given twice keeps its
    greatest label.
    """
    register_view(scan_parquet_merged(spark, spec.path), spec.name)
    return lookup_from(spark.sql(spec.sql), spec.name, spec.kind, broadcast_bytes, way)


def lookup_from(
    df: DataFrame, name: str, kind: str, broadcast_bytes: int | None = None, way: str = ""
) -> Lookup | None:
    """The lookup that the first two columns of ``df`` describe.

    It is broadcast if it fits into what the session's lookups leave of the session's
    limit, or of ``broadcast_bytes``; else it is sharded, or joined where Python cannot
    open the shared folder.  ``way`` states the way instead.
    """
    spark = df.sparkSession
    if broadcast_bytes is None:
        broadcast_bytes = int(spark.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
    if kind.lower() not in KEY_TYPES:
        return None
    kind = kind.lower()
    if len(df.columns) < 2:
        raise LookupBuildError(f"lookup {name}: needs a key and a label column")
    if kind == "id" and not isinstance(df.schema[0].dataType, T.LongType):
        raise LookupBuildError(f"lookup {name}: the key must be bigint")
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    missing = F.raise_error(F.lit(f"lookup {name}: a key or a label is null"))
    unique = (
        plain.select(
            F.coalesce(F.col("c0").cast(KEY_TYPES[kind]), missing).alias("key"),
            F.coalesce(F.col("c1").cast("string"), missing).alias("label"),
        )
        .groupBy("key")
        .agg(F.max("label").alias("label"))
        .persist(StorageLevel.DISK_ONLY)
    )
    text = F.octet_length("label") + F.octet_length(F.col("key").cast("string"))
    rows, content = unique.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    size = content + rows * INDEX_ENTRY_BYTES
    if not way:
        fits = BroadcastBudget.of(spark).take(size, broadcast_bytes)
        way = "broadcast" if fits else "sharded" if reachable(shared_folder(spark)) else "joined"
    folders = []
    if way != "broadcast":
        cached = unique
        folders.append(scratch_path(spark, f"lookup/{name}"))
        unique = materialize(cached, folders[0])
        cached.unpersist()
    return Lookup(name, kind, unique, rows, size, way, folders=folders)


def _index(lookup: Lookup):
    """The broadcast of a lookup's index: all of it, or where its files are."""
    if not lookup.shared:
        spark = lookup.frame.sparkSession
        ship_package(spark)
        if lookup.broadcast:
            index = MemoryIndex(lookup.frame.toArrow())
            lookup.frame.unpersist()
        elif lookup.way == "sharded":
            lookup.folders.append(scratch_path(spark, f"lookup-index/{lookup.name}"))
            index = build_shards(lookup.frame, lookup.size, lookup.folders[-1])
        else:
            raise LookupBuildError(
                f"lookup {lookup.name}: too large to be broadcast, and Python cannot open "
                f"{shared_folder(spark)}; mount the shared folder, or raise {BROADCAST_SETTING}"
            )
        lookup.shared.append(spark.sparkContext.broadcast(index))
    return lookup.shared[0]


def _joined_labels(
    labels: pa.Array, keys: pa.ListArray, separator: pa.Array, missing: pa.Array
) -> pa.Array:
    """Labels of a list of keys as one text for each row."""
    labels = pc.coalesce(labels, missing.take(pc.list_parent_indices(keys)), "null")
    lengths = pc.fill_null(pc.list_value_length(keys), 0)
    ends = pc.cumulative_sum(lengths.cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    lists = pa.ListArray.from_arrays(offsets, labels)
    return pc.binary_join(lists, pc.fill_null(separator, "null"))


def _decoder(lookup: Lookup):
    """Keys to one string of labels; whole Arrow batches."""
    shared = _index(lookup)

    def decode(keys: pa.Array, separator: pa.Array, missing: pa.Array) -> pa.Array:
        text = _joined_labels(shared.value.labels(keys.flatten()), keys, separator, missing)
        return pc.if_else(keys.is_valid(), text, pa.scalar(None, pa.string()))

    return F.arrow_udf(decode, "string")


def decode_cells(
    df: DataFrame,
    cell: str,
    lookup: Lookup,
    split: str,
    separator: str,
    missing: str | None,
    output: str,
) -> DataFrame:
    """``df`` with ``output``: the labels of the codes in column ``cell``, in order."""
    way = _decode_joined if lookup.way == "joined" else _decode_indexed
    return way(df, cell, lookup, split, separator, missing, output)


def lookup_by_id(df, cell, lookup, split=",", separator=",", missing=None, output="label"):
    """Decode numeric codes."""
    return decode_cells(df, cell, _of_kind(lookup, "id"), split, separator, missing, output)


def lookup_by_user(df, cell, lookup, split=",", separator=",", missing=None, output="label"):
    """Decode text codes; they match exactly."""
    return decode_cells(df, cell, _of_kind(lookup, "user"), split, separator, missing, output)


def _of_kind(lookup: Lookup, kind: str) -> Lookup:
    """A lookup of the other kind has no key that could match."""
    if lookup.kind == kind:
        return lookup
    spark = lookup.frame.sparkSession
    none = spark.createDataFrame([], f"key {KEY_TYPES[kind]}, label string")
    return Lookup(lookup.name, kind, none, 0, 0, "broadcast")


def _with_codes(df: DataFrame, cell: str, delimiter: str) -> DataFrame:
    """``df`` and the cell's codes as an array column ``__codes``."""
    split = df.withColumn("__parts", F.expr(codes.parts(quoted(cell), literal(delimiter))))
    return split.withColumn("__codes", F.expr(codes.codes("__parts"))).drop("__parts")


def _decode_indexed(df, cell, lookup, split, separator, missing, output):
    labels = _decoder(lookup)
    keys = F.expr(codes.keys(lookup.kind, "__codes"))
    text = labels(keys, F.lit(separator), F.lit(missing).cast("string"))
    columns = (F.col(quoted(c)) for c in df.columns)
    return _with_codes(df, cell, split).select(*columns, text.alias(output))


def _decode_joined(df, cell, lookup, split, separator, missing, output):
    value = F.col(quoted(cell))
    # Cells and rows come from one evaluation, also where another would give other cells.
    path = scratch_path(df.sparkSession, "lookup/facts")
    df.write.parquet(path)  # as they lie: no exchange
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    given = df.where(value.isNotNull())
    cells = given.groupBy(value.alias("cell")).agg(F.count("*").alias("n"))
    miss = F.coalesce(F.lit(missing).cast("string"), F.lit("null"))

    def decoded(some: DataFrame) -> DataFrame:
        # Keys are a column of their own, so that they are compiled and read once.
        keys = F.expr(codes.keys(lookup.kind, "__codes"))
        read = _with_codes(some, "cell", split).select("cell", keys.alias("keys"))
        # A cell without parts comes through with a null position and joins to ''.
        codes_of = read.select("cell", F.posexplode_outer("keys").alias("position", "code"))
        # Codes that cannot be read have no partner and must not meet under the null key:
        # they are spread over places at which the lookup has nothing.
        unread = F.pmod(F.xxhash64("cell"), F.lit(SPREAD)) + 1
        coded = codes_of.withColumn("place", F.when(F.col("code").isNull(), unread).otherwise(0))
        names = lookup.frame.select("key", "label", F.lit(0).cast("long").alias("at"))
        none = F.lit(0 if lookup.kind == "id" else "").cast(KEY_TYPES[lookup.kind])
        same = (F.coalesce("code", none) == F.col("key")) & (F.col("place") == F.col("at"))
        label = F.when(F.col("position").isNotNull(), F.coalesce("label", miss))
        found = coded.join(names, same, "left").select("cell", "position", label.alias("label"))
        # A window sorts the codes once; collecting them by cell would sort them twice, as
        # groups of lists do not fit the hash aggregate.
        whole = Window.partitionBy("cell").orderBy("position").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        labels = found.withColumn("labels", F.collect_list("label").over(whole))
        first = labels.where(F.coalesce("position", F.lit(0)) == 0)
        return first.select("cell", F.array_join("labels", separator).alias("text"))

    # A hot cell must not gather its rows in one task: its text is there in several copies,
    # and its rows are dealt to them by their number.  The facts are files, in which a row
    # has the same number whenever its task is run again.  Cells are told by their hash, so
    # that only the numbers of a fixed share of them are broadcast, whatever their length;
    # other cells of the same hash are dealt alike.
    copies = F.ceil(F.col("n") * HOT_SHARE / given.agg(F.count(F.lit(1))).scalar()).cast("int")
    marks = cells.select(F.xxhash64("cell").alias("mark"), copies.alias("copies"))
    hot = F.broadcast(
        marks.where("copies > 1").groupBy("mark").agg(F.max("copies").alias("copies"))
    )
    row = F.monotonically_increasing_id()
    marked = df.withColumns({"__mark": F.xxhash64(value), "__row": row}).join(
        hot, F.col("__mark") == F.col("mark"), "left"
    )
    # Rows without a cell need no text; they are spread over all partitions.
    keyed = marked.withColumns(
        {
            "__cell": value,
            "__copy": F.when(value.isNull(), F.pmod("__row", F.lit(SPREAD)))
            .otherwise(F.pmod("__row", F.coalesce("copies", F.lit(1))))
            .cast("int"),
        }
    )
    # All cells; naming the number makes both uses of the cells one exchange.
    texts = decoded(cells.where("n > 0")).toDF("__of", "__text").join(
        hot, F.xxhash64("__of") == F.col("mark"), "left"
    )
    last = F.coalesce("copies", F.lit(1)) - 1
    texts = texts.select("__of", "__text", F.explode(F.sequence(F.lit(0), last)).alias("__number"))
    same = (F.col("__cell") == F.col("__of")) & (F.col("__copy") == F.col("__number"))
    joined = keyed.join(texts, same, "left")
    lost = F.raise_error(F.concat(F.lit("no text was decoded for the cell "), value))
    text = F.when(value.isNotNull(), F.coalesce("__text", lost.cast("string")))
    return joined.select(*(F.col(quoted(c)) for c in df.columns), text.alias(output))


def register_sql_functions(spark: SparkSession, lookups: Iterable[Lookup]) -> None:
    """Make the lookups callable from SQL, if there are any.

    ``lookupValueByIdList`` and ``lookupValueByUserList`` take the lookup's name, the
    cell, the split pattern, the output separator and the text for what is not found.
    Each is one function on Arrow batches, over the indexes of all lookups, so it may
    stand in any clause and works alike at every size.  Cells of other types are taken
    as the text that Spark casts them to.
    """
    by_name = {lookup.name: (lookup.kind, _index(lookup)) for lookup in lookups}
    if not by_name:
        return
    for kind, function in SQL_NAMES.items():
        spark.udf.register(function, F.arrow_udf(_sql_decoder(kind, by_name), "string"))


def _sql_decoder(kind: str, by_name: dict):
    """The function of one kind over the named indexes."""

    def one(name, index, rows, split, separator, missing):
        """Texts of cells that share a lookup and a split pattern."""
        if split is None:
            raise ValueError("Error: the split delimiter is null")
        coded = rows.dictionary_encode()
        parts = arrow_cells.cell_codes(coded.dictionary, split)
        found = parts.values
        if name not in by_name and len(found):
            raise ValueError(f"Error: no lookup named {name}")
        if index is None:  # no key can match
            labels = pa.nulls(len(found), pa.string())
        else:
            labels = index.labels(arrow_cells.code_keys(found, kind))
        # Each row takes its cell's labels: separators and texts may differ by row.
        lists = pa.ListArray.from_arrays(parts.offsets, labels).take(coded.indices)
        return _joined_labels(lists.flatten(), lists, separator, missing)

    def decode(names, rows, splits, separators, missing):
        rows, separators, missing = map(arrow_cells.as_text, (rows, separators, missing))
        names, splits = (arrow_cells.as_text(x).dictionary_encode() for x in (names, splits))
        # Most often all rows have one lookup and one pattern.
        of_name, of_split = (_positions(x) for x in (names, splits))
        settings = of_name * (len(splits.dictionary) + 1) + of_split
        settings[~rows.is_valid().to_numpy(zero_copy_only=False)] = -1
        found, order = [pa.array([], pa.string())], [np.zeros(0, np.int64)]
        for setting in np.unique(settings[settings >= 0]).tolist():
            at = np.flatnonzero(settings == setting)
            own = pa.array(at)
            name, split = (
                x.dictionary[i].as_py() if i < len(x.dictionary) else None
                for x, i in zip((names, splits), divmod(setting, len(splits.dictionary) + 1))
            )
            of_kind, shared = by_name.get(name, (None, None))
            index = shared.value if of_kind == kind else None
            given = (x.take(own) for x in (separators, missing))
            found.append(one(name, index, rows.take(own), split, *given))
            order.append(at)
        order = np.concatenate(order)
        places = np.full(len(rows), -1)
        places[order] = np.arange(len(order))
        return pa.concat_arrays(found).take(pa.array(places, mask=places < 0))

    return decode


def _positions(coded: pa.DictionaryArray) -> np.ndarray:
    """The place of each value in the dictionary; one beyond it for null."""
    return coded.indices.fill_null(len(coded.dictionary)).to_numpy().astype(np.int64)
