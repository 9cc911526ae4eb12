"""Near-duplicate vectors by Euclidean p-stable hashing.

A table projects normalised vectors on random directions and cuts the projections into
steps of equal width; vectors with the same steps share a bucket.  Vectors that share a
bucket in some table are compared exactly, in blocks.  Equal vectors are one class, and
a pair is compared in the first table in which it meets, so links can be counted without
collecting pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import components, release, settled

#: Least cosine of a link.
COSINE = 0.95
#: Tables, projections in each, width of a step.  A pair at the least cosine meets with
#: a probability of 0.97, one at 0.97 with more than 0.999.
TABLES = 64
PROJECTIONS = 10
WIDTH = 1.0
SEED = 20_240_229
#: Vectors of a bucket that are compared at once.
BLOCK = 1024


def _planes(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([seed, size])
    directions = random.standard_normal((size, TABLES * PROJECTIONS))
    return directions, random.random(TABLES * PROJECTIONS) * WIDTH


def buckets(vectors: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A 32-bit bucket in each table, for unit vectors of one size."""
    directions, offsets = _planes(vectors.shape[1], seed)
    steps = np.floor((vectors @ directions + offsets) / WIDTH).astype(np.int64)
    steps = steps.reshape(len(vectors), TABLES, PROJECTIONS)
    random = np.random.default_rng(seed)
    factors = random.integers(1, 1 << 62, PROJECTIONS, dtype=np.int64) | 1
    mixed = (steps * factors).sum(2)
    return ((mixed ^ (mixed >> 29)) & 0x7FFFFFFF).astype(np.int32)


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch["vector"]
        sizes = np.array([len(v) for v in vectors])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            part = batch.take(pa.array(rows))
            values = part["vector"].flatten().to_numpy().astype(np.float64).reshape(-1, size)
            unit = values / np.linalg.norm(values, axis=1, keepdims=True)
            found = buckets(unit)
            yield pa.RecordBatch.from_arrays(
                [
                    part["node"],
                    part["copies"],
                    pa.array([row.tobytes() for row in unit], pa.binary()),
                    pa.array([row.tobytes() for row in found], pa.binary()),
                    pa.array(found.tolist(), pa.list_(pa.int32())),
                ],
                ["node", "copies", "unit", "signature", "buckets"],
            )


def linked_vectors(
    vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """Per row: ``ident, n_links, component_id, kept``.

    ``n_links`` counts the other rows whose vector was found to have a cosine of at least
    ``cosine``, computed in double precision.  ``component_id`` is the least identifier
    that links reach, and ``kept`` marks it.  A vector that is null, empty or zero, or
    has a null or non-finite component, has no links.  Vectors of different sizes are
    not compared.  Repeated rows count as others.  Identifiers are integers; rows that
    share one share a component.  A row with a null identifier is compared with nothing,
    has a null component and is kept.  Other columns are ignored, whatever their names.
    """
    value = vectors[vector].cast("array<double>")
    rows = vectors.select(vectors[ident].cast("long").alias("ident"), value.alias("vector"))
    # Zero comes in two forms; a class has one.
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    usable = (
        F.col("ident").isNotNull()
        & (F.size("vector") > 0)
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("vector", F.when(F.col("usable"), plain))
    classes = (
        rows.where("usable")
        .groupBy("vector")
        .agg(F.min("ident").alias("node"), F.count(F.lit(1)).alias("copies"))
    )
    hashed = settled(
        classes.mapInArrow(
            _hashed,
            "node long, copies long, unit binary, signature binary, buckets array<int>",
        )
    )
    found = settled(_compared(hashed, cosine))
    release(hashed)
    labels = components(found.where("b is not null").select(F.col("node").alias("a"), "b"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_class = classes.join(counts, "node", "left").join(labels, "node", "left")
    of_class = of_class.withColumnRenamed("vector", "same")
    told = rows.join(of_class, F.col("vector") == F.col("same"), "left")
    component = F.when(F.col("ident").isNotNull(), F.coalesce("component", "node", "ident"))
    links = F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0))
    return told.select(
        F.col("ident").alias(ident),
        links.cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("ident").eqNullSafe(component).alias("kept"),
    )


def _compared(hashed: DataFrame, cosine: float) -> DataFrame:
    """``node, links, b``: rows that link a class, and the least class that links reach."""
    size = F.octet_length("unit").alias("size")
    placed = hashed.select("node", size, F.posexplode("buckets").alias("table", "bucket"))
    at = ["size", "table", "bucket"]
    full = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = placed.join(full, at).select(
        "node", *at, blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).alias("own")
    )
    cells = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        *at,
        "node",
        "own",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
    )
    with_vectors = cells.join(hashed.drop("buckets"), "node").select(
        *_CELL, "node", "own", "copies", "unit", "signature"
    )
    ordered = with_vectors.repartition(*_CELL).sortWithinPartitions(*_CELL, "node")
    return ordered.mapInArrow(_links(cosine), "node long, links long, b long")


# What a cell is told by; all of its rows are compared with each other.
_CELL = ["size", "table", "bucket", "low", "high"]


@dataclass(frozen=True)
class _Rows:
    """Rows of whole cells, by cell and node; vectors of one size."""

    cells: np.ndarray  # [row, what tells a cell]
    nodes: np.ndarray
    own: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    signs: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> _Rows:
        unit, signs = (
            np.frombuffer(b"".join(rows[name].to_pylist()), kind).reshape(len(rows), -1)
            for name, kind in (("unit", np.float64), ("signature", np.int32))
        )
        cells = np.stack([rows[name].to_numpy().astype(np.int64) for name in _CELL], 1)
        nodes, own, copies = (rows[name].to_numpy() for name in ("node", "own", "copies"))
        return _Rows(cells, nodes, own, copies, unit, signs)

    def met_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pairs share a bucket in an earlier table than the one they are in."""
        earlier = np.arange(TABLES) < self.cells[a, 1][:, None]
        return ((self.signs[a] == self.signs[b]) & earlier).any(1)


def _whole_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[_Rows]:
    """Rows in the order of their cells, no cell of which goes on in the next ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        # Where the last cell, and the last size of vectors, begin.
        cells = np.stack([batch[name].to_numpy().astype(np.int64) for name in _CELL], 1)
        turns = np.flatnonzero((cells[1:] != cells[:-1]).any(1)) + 1
        if held:
            last = held[-1]
            if any(last[name][-1] != batch[name][0] for name in _CELL):
                yield from _by_size(held)
                held = []
            elif len(turns):
                yield from _by_size([*held, batch.slice(0, turns[0])])
                batch, turns, held = batch.slice(turns[0]), turns[1:] - turns[0], []
        if len(turns) and not held:
            yield from _by_size([batch.slice(0, turns[-1])])
            batch = batch.slice(turns[-1])
        held.append(batch)
    if held:
        yield from _by_size(held)


def _by_size(batches: list[pa.RecordBatch]) -> Iterator[_Rows]:
    rows = pa.Table.from_batches(batches)
    sizes = rows["size"].to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        yield _Rows.of(rows.slice(start, stop - start))


def _links(cosine: float):
    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            turns = (rows.cells[1:] != rows.cells[:-1]).any(1)
            starts = np.flatnonzero(np.append(True, turns))
            lengths = np.diff(np.append(starts, len(rows.nodes)))
            parts = [_pairs(rows, starts[lengths == 2], cosine)]
            for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
                if length > 2:
                    parts.append(_cell(rows, slice(start, start + length), cosine))
            columns = (np.concatenate(c) for c in zip(*parts, strict=True))
            nodes, found, least = columns
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(found), pa.array(least, mask=least == nodes)],
                ["node", "links", "b"],
            )

    return links


def _pairs(rows: _Rows, first: np.ndarray, cosine: float) -> tuple[np.ndarray, ...]:
    """(nodes, links, least nodes reached) of cells of two rows, all at once."""
    second = first + 1
    hit = np.einsum("ij,ij->i", rows.unit[first], rows.unit[second]) >= cosine
    inside = rows.cells[first, 3] == rows.cells[first, 4]
    hit &= inside | (rows.own[first] != rows.own[second])
    first, second = first[hit], second[hit]
    fresh = ~rows.met_before(first, second)
    first, second = first[fresh], second[fresh]
    both = np.concatenate([first, second])
    found = rows.copies[np.concatenate([second, first])].astype(np.int64)
    return rows.nodes[both], found, rows.nodes[np.concatenate([first, first])]


def _cell(rows: _Rows, part: slice, cosine: float) -> tuple[np.ndarray, ...]:
    """The same of one cell."""
    unit, own, nodes = rows.unit[part], rows.own[part], rows.nodes[part]
    hit = unit @ unit.T >= cosine
    if rows.cells[part.start, 3] != rows.cells[part.start, 4]:
        hit &= own[:, None] != own[None, :]  # the rest is in the blocks' own cells
    np.fill_diagonal(hit, False)
    first, second = np.nonzero(np.triu(hit))
    for start in range(0, len(first), 65536):
        a, b = first[start : start + 65536], second[start : start + 65536]
        met = rows.met_before(a + part.start, b + part.start)
        hit[a[met], b[met]] = hit[b[met], a[met]] = False
    some = np.flatnonzero(hit.any(1))
    found = (hit[some] * rows.copies[part]).sum(1).astype(np.int64)
    return nodes[some], found, nodes[_least_reached(hit)[some]]


def _least_reached(hit: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table the least row that its links reach."""
    labels = np.arange(len(hit))
    while True:
        near = np.where(hit, labels, len(hit)).min(1, initial=len(hit))
        lower = np.minimum(labels, near)
        lower = lower[lower]
        if (lower == labels).all():
            return labels
        labels = lower
