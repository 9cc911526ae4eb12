"""Indexes of lookups that tasks probe in place: one in memory, one in sorted files.

A sharded index is a folder of Arrow files.  Every file has the rows of one range of an
order: of the keys themselves where they are numbers, of a hash of the key where they are
texts.  A worker opens the files that its batches ask for, mapped into memory where the
folder is mounted, and keeps a bounded number of them open.
"""

from __future__ import annotations

import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About so many bytes of a lookup are in a shard.
SHARD_BYTES = 32 * 1024 * 1024
# So many shards are kept open by a worker; and so many bytes of those that must be read.
OPEN_SHARDS = 256
READ_BYTES = 256 * 1024 * 1024


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder as Python sees it, and the folder's path there."""
    if path.startswith("file:"):
        path = path[len("file:") :]
        path = "/" + path.lstrip("/")
    if "://" not in path:
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def reachable(path: str, create: bool = True) -> bool:
    """Whether Python can open a folder that Spark names, and by default write there."""
    try:
        store, base = file_system(path)
        if create:
            store.create_dir(base, recursive=True)
            return True
        return store.get_file_info(base).type != pyarrow.fs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return False


def hashes(keys: pa.Array) -> np.ndarray:
    """The place of text keys in the order of a sharded index."""
    return np.array([zlib.crc32(key.encode()) for key in keys.to_pylist()], np.int64)


class MemoryIndex:
    """Unique keys and their labels; numbers are in order."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("key")
        self.keys, self.values = (table.column(c).combine_chunks() for c in ("key", "label"))
        self._places: dict[str, int] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_places": None}

    def labels(self, wanted: pa.Array) -> pa.Array:
        """The label of each wanted key; null where there is none."""
        if pa.types.is_integer(wanted.type):
            keys = self.keys.to_numpy()
            asked = wanted.fill_null(0).to_numpy()
            at = np.searchsorted(keys, asked)
            hit = at < len(keys)
            hit[hit] = keys[at[hit]] == asked[hit]
            hit &= wanted.is_valid().to_numpy(zero_copy_only=False)
            return self.values.take(pa.array(at, mask=~hit))
        if self._places is None:  # once per worker process
            self._places = {key: i for i, key in enumerate(self.keys.to_pylist())}
        coded = wanted.dictionary_encode()
        found = [self._places.get(key) for key in coded.dictionary.to_pylist()]
        return self.values.take(pa.array(found, pa.int64())).take(coded.indices)


@dataclass
class ShardedIndex:
    """The files of a lookup, by the least place in the order that each holds."""

    base: str
    names: list[str]
    lows: np.ndarray
    _open: OrderedDict = field(default_factory=OrderedDict, repr=False)

    def __getstate__(self) -> dict:
        return {"base": self.base, "names": self.names, "lows": self.lows, "_open": OrderedDict()}

    def _shard(self, number: int) -> tuple[np.ndarray, pa.Array | None, pa.Array]:
        """(places, keys or None, labels) of one file, in the order of the places."""
        if number in self._open:
            self._open.move_to_end(number)
            return self._open[number][0]
        store, base = file_system(self.base)
        path = f"{base}/{self.names[number]}"
        local = isinstance(store, pyarrow.fs.LocalFileSystem)
        source = pa.memory_map(path) if local else store.open_input_file(path)
        table = pa.ipc.open_file(source).read_all()  # mapped, or read as a whole
        rows = [table.column(c).combine_chunks() for c in table.column_names]
        keys = rows[1] if len(rows) == 3 else None
        shard = rows[0].to_numpy(), keys, rows[-1]
        self._open[number] = shard, 0 if local else table.nbytes
        while len(self._open) > 1 and (
            len(self._open) > OPEN_SHARDS or sum(n for _, n in self._open.values()) > READ_BYTES
        ):
            self._open.popitem(last=False)
        return shard

    def labels(self, wanted: pa.Array) -> pa.Array:
        """The label of each wanted key; null where there is none."""
        coded = wanted.dictionary_encode()
        asked = coded.dictionary
        if not len(asked) or not self.names:
            return pa.nulls(len(wanted), pa.string())
        numeric = pa.types.is_integer(asked.type)
        places = asked.to_numpy() if numeric else hashes(asked)
        shards = np.searchsorted(self.lows, places, side="right") - 1
        order = np.argsort(shards, kind="stable")
        cuts = np.flatnonzero(np.diff(shards[order], prepend=-2))
        found = []
        for own in np.split(order, cuts[1:]):
            number = int(shards[own[0]])
            if number < 0:  # before the first shard
                found.append(pa.nulls(len(own), pa.string()))
                continue
            there, keys, labels = self._shard(number)
            at = _found(there, places[own], keys, asked.take(pa.array(own)))
            found.append(labels.take(pa.array(at, mask=at < 0)).cast(pa.string()))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        labels = pa.concat_arrays(found).take(pa.array(back))
        return labels.take(coded.indices)


def _found(
    there: np.ndarray, places: np.ndarray, keys: pa.Array | None, asked: pa.Array
) -> np.ndarray:
    """Where each asked key is in a shard; -1 where it is not."""
    at = np.searchsorted(there, places)
    hit = np.full(len(places), -1, np.int64)
    left = np.arange(len(places))
    while len(left):  # texts whose hashes are equal lie side by side
        same = at[left] < len(there)
        same[same] = there[at[left[same]]] == places[left[same]]
        left = left[same]
        if keys is None:
            hit[left] = at[left]
            break
        equal = pc.equal(
            keys.take(pa.array(at[left])).cast(pa.string()), asked.take(pa.array(left))
        ).to_numpy(zero_copy_only=False)
        hit[left[equal]] = at[left[equal]]
        left = left[~equal]
        at[left] += 1
    return hit


def _written(base: str, numeric: bool):
    """Write each partition as a file; gives its name and the least place in it.

    A task that is run again writes a file of another name; only those that it reports
    are used.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (batch for batch in batches if len(batch))
        first = next(batches, None)
        if first is None:
            return
        store, folder = file_system(base)
        store.create_dir(folder, recursive=True)
        name = f"{uuid.uuid4().hex}.arrow"
        fields = [("place", pa.int64())] + ([] if numeric else [("key", pa.large_string())])
        schema = pa.schema([*fields, ("label", pa.large_string())])
        low = first["place"][0].as_py()
        held = [first, *batches]  # about as much as a shard
        columns = []
        for field_ in schema:
            parts = [batch[field_.name].cast(field_.type) for batch in held]
            columns.append(pa.concat_arrays(parts))
        with store.open_output_stream(f"{folder}/{name}") as out:
            with pa.ipc.new_file(out, schema) as writer:
                writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
        yield pa.RecordBatch.from_pydict({"name": [name], "low": [low]})

    return write


def build_shards(unique: DataFrame, size: int, base: str) -> ShardedIndex:
    """Write unique ``key, label`` rows of about ``size`` bytes as sorted files.

    Only the files' names and where they begin come to the driver: a row for each
    ``SHARD_BYTES``.
    """
    numeric = dict(unique.dtypes)["key"] == "bigint"
    place = F.col("key") if numeric else F.crc32(F.col("key").cast("binary"))
    rows = unique.select(place.cast("long").alias("place"), "key", "label")
    shards = max(1, -(-size // SHARD_BYTES))
    ordered = rows.repartitionByRange(shards, "place").sortWithinPartitions("place", "key")
    told = ordered.mapInArrow(_written(base, numeric), "name string, low long")
    files = sorted((row.low, row.name) for row in told.collect())
    return ShardedIndex(
        base, [name for _, name in files], np.array([low for low, _ in files], np.int64)
    )
