"""A Spark data source that lists folders a page at a time, in the order of their paths.

With a limit one task walks the folders in order and stops; it never looks into a folder
that lies before the start or behind the last file it needs.  Without one, each folder at
the top is a partition of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stepweave.operators.lookup_index import file_system

NAME = "stepweave_inventory"
SCHEMA = "path string, modified timestamp, size long"


def hidden(name: str) -> bool:
    """Whether readers pass over a file or folder of that name."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


@dataclass
class Part(InputPartition):
    """A folder to be walked, or a file; ``path`` ends in ``/`` if it is a folder."""

    path: str
    modified: datetime | None = None
    size: int = 0

    def row(self) -> tuple:
        return self.path, self.modified, self.size


def _modified(info: pyarrow.fs.FileInfo) -> datetime | None:
    """To the millisecond, as Spark's own readers tell it."""
    if info.mtime is None:
        return None
    time = info.mtime.astimezone(UTC)
    return time.replace(microsecond=time.microsecond // 1000 * 1000)


class Lister:
    """Lists folders of one file system, as Spark names their paths."""

    def __init__(self, path: str):
        self.store, base = file_system(path)
        base = base.rstrip("/")
        local = isinstance(self.store, pyarrow.fs.LocalFileSystem)
        # Spark's name of a path begins with the scheme.
        self.before = "file:" if local else path.split("://", 1)[0] + "://"
        self.top = f"{self.before}{base}"
        self.pages = 0

    def entries(self, folder: str) -> list[Part]:
        """What lies directly in a folder, in the order of the paths below it."""
        self.pages += 1
        selector = pyarrow.fs.FileSelector(folder.removeprefix(self.before).rstrip("/"))
        found = []
        for info in self.store.get_file_info(selector):
            if hidden(info.base_name):
                continue
            path = self.before + info.path
            if info.type == pyarrow.fs.FileType.Directory:
                found.append(Part(path + "/"))
            else:
                found.append(Part(path, _modified(info), info.size))
        return sorted(found, key=lambda part: part.path)

    def files(self, parts: list[Part], start_after: str | None) -> Iterator[Part]:
        """The files of these parts behind ``start_after``, in order; folders are listed
        when it is their turn."""
        waiting = parts[::-1]
        while waiting:
            part = waiting.pop()
            if not part.path.endswith("/"):
                if start_after is None or part.path > start_after:
                    yield part
            elif start_after is None or part.path > start_after or start_after.startswith(part.path):
                waiting += self.entries(part.path)[::-1]

    def start(self) -> list[Part]:
        """The given path's entries, or itself if it is a file."""
        path = self.top.removeprefix(self.before)
        info = self.store.get_file_info(path)
        if info.type == pyarrow.fs.FileType.NotFound:
            raise FileNotFoundError(f"nothing lies at {path}")
        if info.type == pyarrow.fs.FileType.Directory:
            return self.entries(self.top)
        return [Part(self.top, _modified(info), info.size)]


class InventoryReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.start_after = options.get("startafter")
        self.limit = int(options["limit"]) if "limit" in options else None

    def partitions(self) -> list[Part]:
        lister = Lister(self.path)
        if self.limit is not None:
            return [Part(lister.top + "/")]
        parts = lister.start()
        # A folder is a partition; files at the top are read as they were listed.
        return parts or [Part("")]

    def read(self, partition: Part) -> Iterator[tuple]:
        lister = Lister(self.path)
        if self.limit is None:
            if partition.path:
                for part in lister.files([partition], self.start_after):
                    yield part.row()
            return
        left = self.limit
        found = lister.files(lister.start(), self.start_after) if left > 0 else iter(())
        for part in found:
            yield part.row()
            left -= 1
            if left <= 0:
                return


class Inventory(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> InventoryReader:
        return InventoryReader(self.options)
