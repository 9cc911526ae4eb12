"""Web archives in ZIP packages: write them, find their parts, read records by range.

A package holds a file of WARC records, each compressed on its own, an index of them,
and a table of contents, all *stored*, not compressed again, so that a record's place in
the package is known and only its bytes are read.  The reader parses the end record, the
ZIP64 records and the central directory by itself.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import BROADCAST_ROWS, settled
from stepweave.session import shared_folder

# Signatures and field values of the ZIP format.
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
EXTRA64 = 1
SMALL, LARGE = 0xFFFF, 0xFFFFFFFF
_LOCAL, _CENTRAL, _END = "<4s5H3I2H", "<4s6H3I5H2I", "<4s4H2IH"
_END64, _LOCATOR64 = "<4sQ2H2I4Q", "<4sIQI"
# Names of the package's members.
DATA, INDEX, CONTENTS = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
# Record profile for equal payloads, and the date of every record.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

#: A package is closed when its records exceed so many bytes.
PACKAGE_BYTES = 32 << 20
#: What a record counts for besides its body and address.
RECORD_BYTES = 512
#: Payloads of more than one in so many repeated pages are hot: there are fewer of them.
HOT_SHARE = 20_000
#: A task reads about so many packages, fewer where there are cores to spare.
PACKAGES_A_TASK = 4

RangeReader = Callable[[int, int], bytes]


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    """A stored member: where its bytes lie in the package."""

    name: str
    offset: int
    size: int


def write_package(
    members: list[tuple[str, bytes]], small: int = SMALL, large: int = LARGE
) -> bytes:
    """A ZIP file of stored members.

    Values from ``small`` and ``large`` on go to ZIP64 records; lower limits than the
    format's own make small packages with ZIP64 records.
    """
    out = io.BytesIO()
    directory = []
    for name, data in members:
        title, check, offset = name.encode(), zlib.crc32(data), out.tell()
        wide = len(data) >= large
        extra = struct.pack("<2H2Q", EXTRA64, 16, len(data), len(data)) if wide else b""
        shown = LARGE if wide else len(data)
        out.write(
            struct.pack(
                _LOCAL, LOCAL, 45, 0x800, 0, 0, 33, check, shown, shown, len(title), len(extra)
            )
            + title
            + extra
        )
        out.write(data)
        directory.append((title, check, len(data), offset))
    start = out.tell()
    for title, check, size, offset in directory:
        fields = [size, size] if size >= large else []
        fields += [offset] if offset >= large else []
        extra = struct.pack(f"<2H{len(fields)}Q", EXTRA64, 8 * len(fields), *fields)
        extra = extra if fields else b""
        shown = LARGE if size >= large else size
        at = LARGE if offset >= large else offset
        head = (CENTRAL, 45, 45, 0x800, 0, 0, 33, check, shown, shown, len(title), len(extra))
        out.write(struct.pack(_CENTRAL, *head, 0, 0, 0, 0, at) + title + extra)
    n, length = len(directory), out.tell() - start
    if n >= small or start >= large or length >= large:
        end = out.tell()
        out.write(struct.pack(_END64, END64, 44, 45, 45, 0, 0, n, n, length, start))
        out.write(struct.pack(_LOCATOR64, LOCATOR64, 0, end, 1))
        n, length, start = min(n, SMALL), LARGE, LARGE
    out.write(struct.pack(_END, END, 0, 0, n, n, length, start, 0))
    return out.getvalue()


def members_of(read: RangeReader, size: int) -> list[Member]:
    """The stored members of a package of ``size`` bytes, from its central directory."""
    tail_at = max(0, size - struct.calcsize(_END) - SMALL)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP package: no end record")
    *_, count, length, start, _ = struct.unpack_from(_END, tail, at)
    locator = at - struct.calcsize(_LOCATOR64)
    if locator >= 0 and tail[locator : locator + 4] == LOCATOR64:
        _, _, end64, _ = struct.unpack_from(_LOCATOR64, tail, locator)
        record = read(end64, struct.calcsize(_END64))
        *_, count, length, start = struct.unpack(_END64, record)
    directory = read(start, length)
    members, at = [], 0
    for _ in range(count):
        (mark, _, _, _, method, _, _, _, packed, plain, names, extras, notes, _, _, _, offset) = (
            struct.unpack_from(_CENTRAL, directory, at)
        )
        if mark != CENTRAL:
            raise ValueError("broken central directory")
        at += struct.calcsize(_CENTRAL)
        name = directory[at : at + names].decode()
        wide = _wide_fields(directory[at + names : at + names + extras])
        plain, packed, offset = (
            wide.pop(0) if value == LARGE and wide else value for value in (plain, packed, offset)
        )
        at += names + extras + notes
        if method:
            continue  # compressed: its records cannot be read by range
        head = read(offset, struct.calcsize(_LOCAL))
        *_, names, extras = struct.unpack(_LOCAL, head)
        members.append(Member(name, offset + len(head) + names + extras, plain))
    return members


def _wide_fields(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == EXTRA64:
            return [x for (x,) in struct.iter_unpack("<Q", extra[at + 4 : at + 4 + size])]
        at += 4 + size
    return []


# --- WARC ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Record:
    """One archived page.  ``payload`` is empty in a revisit."""

    ident: str
    url: str
    kind: str
    digest: str
    length: int
    refers_to: str | None
    payload: bytes


def _urn(ident: str) -> str:
    return f"<urn:page:{ident}>"


def _ident(urn: str | None) -> str | None:
    return urn[len("<urn:page:") : -1] if urn else None


def encode_record(record: Record) -> bytes:
    """A WARC record, compressed on its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + record.payload
    url = "".join(c if c > " " else f"%{ord(c):02X}" for c in record.url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {record.kind}",
        f"WARC-Record-ID: {_urn(record.ident)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{record.digest}",
        f"WARC-Payload-Length: {record.length}",  # a field of our own: revisits have none
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if record.refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(record.refers_to)}"]
    text = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(text, 1, mtime=0)


def decode_record(data: bytes) -> Record:
    """The record in one compressed piece; a payload that fails its digest is an error."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload fails its digest")
    return Record(
        _ident(fields["WARC-Record-ID"]),
        fields["WARC-Target-URI"],
        kind,
        digest,
        int(fields["WARC-Payload-Length"]),
        _ident(fields.get("WARC-Refers-To")),
        payload,
    )


def pack_records(records: Iterable[Record]) -> bytes:
    """A package of records with their index."""
    data, index = io.BytesIO(), []
    for record in records:
        piece = encode_record(record)
        index.append({"offset": data.tell(), "length": len(piece), "digest": record.digest})
        data.write(piece)
    lines = "".join(json.dumps(entry) + "\n" for entry in index)
    contents = json.dumps({"profile": "data-package", "resources": [DATA, INDEX]})
    return write_package(
        [(DATA, data.getvalue()), (INDEX, lines.encode()), (CONTENTS, contents.encode())]
    )


def records_of(read: RangeReader, size: int) -> Iterator[Record]:
    """The records of one package, each read by its range."""
    places = {member.name: member for member in members_of(read, size)}
    index, data = places[INDEX], places[DATA]
    for line in read(index.offset, index.size).splitlines():
        entry = json.loads(line)
        yield decode_record(read(data.offset + entry["offset"], entry["length"]))


# --- Spark -----------------------------------------------------------------------------


def _file_system(path: str):
    """The store of a path, and the path within it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def write_archives(
    pages: DataFrame,
    folder: str,
    least_revisit: int = 0,
    package_bytes: int = PACKAGE_BYTES,
    ident: str = "page_id",
    url: str = "url",
    source: str = "html",
) -> DataFrame:
    """Archive pages in packages under ``folder``; returns a row per package.

    Of pages with equal payloads of at least ``least_revisit`` bytes the one with the
    largest identifier is a response and the others are revisits that refer to it.  A
    null page has an empty payload, a null address is empty.  Rows that repeat the
    largest identifier are all responses; pages with a null identifier cannot be
    referred to and are responses, unless an equal page has an identifier.  Other
    columns are ignored, whatever their names.

    Each task writes its own packages, under names that no other attempt uses; only the
    packages of the attempts that succeeded are in the result.
    """
    payload = F.coalesce(pages[source], F.lit("")).cast("binary")
    rows = pages.select(
        pages[ident].cast("string").alias("ident"),
        pages[ident].alias("order"),
        F.coalesce(pages[url].cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("same"),
    )
    groups = (
        rows.where(F.octet_length("payload") >= least_revisit)
        .groupBy("same")
        .agg(F.max("order").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and response is not null")
    )
    told = _with_response(rows, settled(groups)).select(
        "ident",
        "url",
        "payload",
        F.when(~F.col("order").eqNullSafe(F.col("response")), F.col("response").cast("string"))
        .alias("refers_to"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(folder)
        store.create_dir(base)
        held, size = [], 0
        for batch in batches:
            for ident, url, payload, refers_to in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                digest, length = payload_digest(payload), len(payload)
                kind = "response" if refers_to is None else "revisit"
                body = payload if refers_to is None else b""
                held.append(Record(ident or "", url, kind, digest, length, refers_to, body))
                # A revisit has no body, but its record and its line in the index.
                size += len(body) + len(held[-1].url) + RECORD_BYTES
                if size >= package_bytes:
                    yield _write(store, base, held)
                    held, size = [], 0
        if held:
            yield _write(store, base, held)

    return settled(told.mapInArrow(pack, "name string, bytes long, records long"))


def _with_response(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the identifier of their group's response, null outside of groups.

    Payloads stay where they are while the groups are few enough to be broadcast.  Beyond
    that only the rows of the largest groups do, so that no task gets all rows of one.
    """
    if groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups.drop("n")), "same", "left")
    hot = groups.where(F.col("n") * HOT_SHARE > groups.agg(F.sum("n")).scalar())
    marked = rows.join(F.broadcast(hot.select("same", F.col("response").alias("found"))), "same", "left")
    there = F.col("found").isNotNull()
    rest = marked.where(~there).drop("found").join(groups.drop("n"), "same", "left")
    hot_rows = marked.where(there).withColumnRenamed("found", "response")
    return hot_rows.unionByName(rest)


def _write(store, base: str, records: list[Record]) -> pa.RecordBatch:
    name = f"part-{uuid.uuid4().hex}.wacz"
    package = pack_records(records)
    with store.open_output_stream(f"{base}/{name}") as out:
        out.write(package)
    return pa.RecordBatch.from_pydict(
        {"name": [name], "bytes": [len(package)], "records": [len(records)]}
    )


RECORD_SCHEMA = (
    "ident string, url string, kind string, digest string, length long, refers_to string, "
    "payload binary"
)


def read_archives(packages: DataFrame, folder: str) -> DataFrame:
    """The records of the packages named by rows of ``name, bytes`` under ``folder``.

    One package after the other is open in a task, and only its directory, its index and
    the records asked for are read.  An empty list of packages gives no rows.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(folder)
        schema = pa.schema(
            [(field, pa.string()) for field in ("ident", "url", "kind", "digest")]
            + [("length", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for name, size in zip(
                batch["name"].to_pylist(), batch["bytes"].to_pylist(), strict=True
            ):
                with store.open_input_file(f"{base}/{name}") as file:
                    held, total = [], 0
                    for record in records_of(lambda at, n, f=file: f.read_at(n, at), size):
                        held.append(vars(record))
                        total += len(record.payload)
                        if total >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, total = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    # The list is short for what it stands for: a number of tasks that is stated is kept,
    # where adaptive execution would put the whole list into one task.
    count = packages.count()
    cores = packages.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-count // PACKAGES_A_TASK), min(count, cores))
    named = packages.select("name", "bytes").repartition(tasks, "name")
    return named.mapInArrow(read, RECORD_SCHEMA)


def archive_folder(spark) -> str:
    """A new folder for archives among the shared ones."""
    return f"{shared_folder(spark)}/stepweave/archives-{uuid.uuid4().hex}"
