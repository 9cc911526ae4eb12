"""What several of the operators need."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stepweave.session import drop_scratch, quoted, scratch_path, shared_folder

# Fixed value: the characters that separate words, as a pattern for Spark.
SPACES = r"[\x20\x09-\x0D]"
# The same characters; SQL has no escape for some of them, so they are not written there.
EDGES = " \t\n\v\f\r"
# Identifiers are broadcast up to this many; beyond it they are joined.
BROADCAST_ROWS = 250_000
# Texts are hashed in pieces of about this many bytes.
PIECE_BYTES = 1 << 20
# Spark's setting: whether a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Where a stored table lies, as its attribute.
_STORED = "_stepweave_stored"


# Spark's setting: rows that Python gets at once; Spark holds as many for each task, too.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def _having(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _once(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Queries made within run once: their shuffle files go as they end, not when the driver
    happens to collect its garbage."""
    return _having(spark, SHUFFLE_CLEANUP, "true")


def few_rows(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """Queries that run within give Python so many rows at once, at most."""
    before = int(spark.conf.get(BATCH_ROWS))
    return _having(spark, BATCH_ROWS, str(min(rows, before) if before > 0 else rows))


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared folder, with its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    with _once(df.sparkSession):
        return df.select("*").checkpoint()  # a query of its own, made under the setting


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder: smaller than a checkpoint, and
    of some columns only those that are asked for are read."""
    path = scratch_path(df.sparkSession, "stored")
    with _once(df.sparkSession):
        df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.__dict__[_STORED] = path
    return found


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is a table that :func:`stored` made."""
    return _STORED in df.__dict__


def collected(df: DataFrame) -> list[Row]:
    """The rows of ``df``, of which no shuffle files stay."""
    with _once(df.sparkSession):
        return df.select("*").collect()


def is_short(df: DataFrame) -> bool:
    """Whether ``df`` may be broadcast; no shuffle files of the count stay."""
    with _once(df.sparkSession):
        return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


class Steps:
    """Tables that are settled on the way to a result, and can go once it is settled too."""

    def __init__(self) -> None:
        self._held: list[DataFrame] = []

    def settled(self, df: DataFrame) -> DataFrame:
        return self.hold(settled(df))

    def hold(self, df: DataFrame) -> DataFrame:
        """Have a settled table go with the others."""
        self._held.append(df)
        return df

    def release(self) -> None:
        """Delete the tables' files.  Nothing that reads them may run afterwards."""
        while self._held:
            release(self._held.pop())


def release(df: DataFrame) -> None:
    """Delete the files of a settled or stored table; one that is neither has none."""
    if path := df.__dict__.get(_STORED):
        return drop_scratch(df.sparkSession, path)
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() == "LogicalRDD":
        file = plan.rdd().getCheckpointFile()
        if file.isDefined():
            drop_scratch(df.sparkSession, file.get())


def fold(ident: str, parts: int) -> Column:
    """CRC-32 of a row's identifier as text, modulo ``parts``; 1 where it is null."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % parts, F.lit(1))


def having(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``wanted``; a short list is broadcast."""
    wanted = wanted.select(key).distinct()
    return df.join(F.broadcast(wanted) if is_short(wanted) else wanted, key, "left_semi")


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc`` of all rows, as a table in the shared folder.

    ``row`` is a number of its own for each row, whatever the row holds, and ``doc`` has
    all of its columns, so that no name can clash.
    """
    columns = F.struct(*(docs[quoted(c)] for c in docs.columns))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), columns.alias("doc"))
    path = scratch_path(docs.sparkSession, "numbered")
    rows.write.parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def without(rows: DataFrame, gone: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of numbered rows whose number is not in ``gone``; short lists are broadcast."""
    left = rows.join(F.broadcast(gone) if is_short(gone) else gone, "row", "left_anti")
    return left.select(*(F.col("doc")[c].alias(c) for c in columns))


def in_pieces(
    items: Iterable[tuple], size: Callable[[tuple], int], most: int
) -> Iterator[list[tuple]]:
    """Lists of items of about ``most`` in total; a larger item has its own list."""
    held: list[tuple] = []
    total = 0
    for item in items:
        n = size(item)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(item)
        total += n
    if held:
        yield held


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


class WindowHasher:
    """64-bit hashes of word sequences.

    A word is taken in lanes of eight bytes, which are mixed, each with its place, before
    they are added.  A window is mixed from the two halves that cover it, and so on down to
    words.  No step is linear in what goes in, so sequences cannot be made to cancel out,
    and hashers with other seeds are unrelated.
    """

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self._keys = random.integers(0, 1 << 64, 5, dtype=np.uint64)

    def load(self, words: list[bytes]) -> WindowHasher:
        """Take a list of words; windows are asked for by their numbers."""
        text = np.frombuffer(b" ".join(words) + b" " * 9, np.uint8)
        ends = np.flatnonzero(text == 32)[: len(words)]
        starts = np.concatenate([[0], ends[:-1] + 1])
        self._levels = [self._words(text, starts, ends - starts)]
        return self

    def _words(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        lanes = -(-sizes // 8)
        first = np.cumsum(lanes) - lanes
        number = np.arange(lanes.sum()) - np.repeat(first, lanes)
        at = np.repeat(starts, lanes) + 8 * number
        eight = np.lib.stride_tricks.sliding_window_view(text, 8)[at]
        values = np.ascontiguousarray(eight).view(np.uint64).ravel()
        rest = np.minimum(np.repeat(sizes, lanes) - 8 * number, 8).astype(np.uint64)
        values &= ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest)
        places = mixed(number.astype(np.uint64) + self._keys[0])
        values = mixed(mixed(values ^ self._keys[1]) + places)
        sums = np.add.reduceat(values, first) if len(first) else values
        return mixed(sums ^ mixed(sizes.astype(np.uint64) + self._keys[2]))

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return mixed(mixed(left ^ self._keys[3]) + self._keys[4] - right)

    def _level(self, number: int) -> np.ndarray:
        """Hashes of the windows of 2 ** number words, as far as there are so many."""
        while len(self._levels) <= number:
            below = self._levels[-1]
            step = 1 << (len(self._levels) - 1)
            self._levels.append(self._joined(below[: max(len(below) - step, 0)], below[step:]))
        return self._levels[number]

    def windows(self, first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of the windows of ``length`` words from word ``first`` on."""
        if np.ndim(length):
            found = np.zeros(len(first), np.uint64)
            for size in np.unique(length).tolist():
                own = length == size
                found[own] = self.windows(first[own], size)
            return found
        number = int(length).bit_length() - 1
        half = self._level(number)
        found = half[first]
        if rest := int(length) - (1 << number):
            found = self._joined(found, half[first + rest])
        return mixed(found + np.uint64(length))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the differences of 64-bit values over all of their bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def summed_arrays(rows: DataFrame, dtype: str, tasks: int | None = None) -> DataFrame:
    """``key STRING, data BINARY`` rows added up by key, as arrays of ``dtype``.

    Two levels, so that no task adds more than about the square root of the number
    of partitions; each streams its rows and holds one array per key.  ``tasks`` is that
    number, if to ask for it would compute the rows.
    """
    ways = max(1, int(np.sqrt(tasks or rows.rdd.getNumPartitions())))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for key, data in zip(batch["key"].to_pylist(), batch["data"].to_pylist(), strict=True):
                got = np.frombuffer(data, dtype)
                if key in sums:
                    sums[key] += got
                else:
                    sums[key] = got.copy()
        for key, data in sums.items():
            yield pa.RecordBatch.from_pydict({"key": [key], "data": [data.tobytes()]})

    schema = "key string, data binary"
    spread = rows.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(ways)))
    once = spread.repartition("key", "way").select("key", "data").mapInArrow(add, schema)
    return once.repartition("key").mapInArrow(add, schema)


def components(edges: DataFrame, steps: Steps | None = None) -> DataFrame:
    """``node, component`` for the ends of the edges ``a, b``: the least node reachable.

    Least labels go over the edges and then to the label's own label, until nothing
    changes.  Every round is settled, and the round before it goes; the last one goes
    with ``steps``, if given.
    """
    edges = edges.select("a", "b").where("a <> b")
    both = settled(edges.union(edges.select("b", "a")).distinct())
    round_ = settled(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("component")
        )
    )
    while True:
        labels = round_.select("node", "component")
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        closer = labels.join(near, "node").select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("was")
        )
        parent = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = settled(
            closer.join(parent, "component").select(
                "node", F.least("component", "up").alias("component"), "was"
            )
        )
        release(round_)
        round_ = jumped
        if jumped.where("component <> was").isEmpty():
            release(both)
            if steps is not None:
                steps.hold(jumped)
            return jumped.select("node", "component")
