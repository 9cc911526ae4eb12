"""Ranked lexical search over treaps of a term-document grid.

Documents are indexed in blocks.  A block's grid has a row for each of its terms and a
column for each of its documents, in the order of their identifiers; a cell holds the
impact of the term there.  The grid is a quadtree: each node stands for a square that is
not empty and keeps the largest impact in it, as the difference from its parent's.  (Where
there are more rows than columns, the first levels halve the rows only, and the other way
round.)

Each item descends into a block along the paths of its terms' rows at once.  A range of
documents has one node per term; the sum of their maxima times the terms' weights bounds
every score in the range.  The ranges of the greatest bounds are halved first, and those
that cannot reach the item's best documents so far are never entered, so the results are
those of scoring every document.

The index is a table in the shared folder and can be searched again.  Weights of terms
depend on all documents: they are counted from the index, for the items' terms.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepweave.llm.common import byte_texts, few_rows, settled
from stepweave.session import scratch_path

#: Documents that an item gets.
BEST = 10
#: A block of the index has at most so many documents, and ends after so many bytes of text.
BLOCK_DOCS = 4096
BLOCK_BYTES = 1 << 22
#: Terms of the items that are searched for at once; further items in further rounds.
TERMS_AT_ONCE = 1 << 20
#: Ranges times terms that are opened in one step.
STEP_CELLS = 1 << 14
# Fixed values of the scores.
LENGTH_PERCENT = 90
IMPACT_SCALE, TERM_SCALE, LENGTH_SCALE, WEIGHT_SCALE = 10**9, 1000, 8, 1000
# A score of fewer terms is below 2^53, so that doubles add it up exactly.
_FEW_TERMS = 100_000
# Texts are taken apart in pieces of about so many bytes, and so many are objects at once.
_PIECE = 1 << 20
_TEXTS = 256
# Blocks that a reader of the index gets at once.
_BLOCKS = 1
# Blocks are large rows, so their sizes are looked at more often than small rows' are: what
# is written, or read, at once has about so many bytes.
_FILES = {
    "parquet.block.size": 1 << 23,
    "parquet.block.size.row.check.min": 1,
    "parquet.block.size.row.check.max": 4,
    "parquet.page.size.row.check.min": 1,
}

# A term's bytes as they are, A-Z lower-cased; all others become spaces.
_PLAIN = bytes(
    c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256)
)
# How many of a node's children there are, and how many before one of them.
_CHILDREN = np.array([x.bit_count() for x in range(16)], np.uint8)
_BEFORE = np.array([[(x & ((1 << d) - 1)).bit_count() for d in range(4)] for x in range(16)], np.uint8)


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    plain = (text or b"").translate(_PLAIN)
    start = 0
    while len(plain) - start > _PIECE:
        stop = plain.rfind(b" ", start, start + _PIECE) + 1 or plain.find(b" ", start) + 1
        if not stop:
            break
        yield plain[start:stop].split()
        start = stop
    yield plain[start:].split()


def _few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows, a few at a time."""
    for batch in batches:
        for start in range(0, len(batch), _TEXTS):
            yield batch.slice(start, _TEXTS)


def _count_lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in _few(batches):
        for text in byte_texts(batch["text"]):
            if n := sum(map(len, terms_of(text))):
                docs += 1
                terms += n
    yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})


@dataclass
class Treap:
    """A block's quadtree; of each level the nodes' children, as bits, and what their
    largest impact lacks of their parent's.  The root is the only node of level 0."""

    row_levels: int  # how often rows are halved
    column_levels: int
    bits: list[np.ndarray] = field(default_factory=list)
    lacks: list[np.ndarray] = field(default_factory=list)


def _splits(row_levels: int, column_levels: int) -> list[tuple[bool, bool]]:
    """For each level, whether rows and columns are halved there."""
    levels = max(row_levels, column_levels)
    return [(levels - i <= row_levels, levels - i <= column_levels) for i in range(levels)]


def build_treap(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, shape) -> Treap:
    """The quadtree of the cells; each is given once, and there is one at least."""
    treap = Treap(*(max(int(n) - 1, 0).bit_length() for n in shape))
    splits = _splits(treap.row_levels, treap.column_levels)
    keys = np.zeros(len(rows), np.int64)
    row_bit, column_bit = treap.row_levels, treap.column_levels
    widths = []
    for by_row, by_column in splits:
        if by_row:
            row_bit -= 1
            keys = keys << 1 | rows >> row_bit & 1
        if by_column:
            column_bit -= 1
            keys = keys << 1 | columns >> column_bit & 1
        widths.append(by_row + by_column)
    order = np.argsort(keys)
    keys, largest = keys[order], impacts[order].astype(np.int32)
    del order
    for width in reversed(widths):
        parents = keys >> width
        first = np.flatnonzero(np.diff(parents, prepend=-1))
        above = np.maximum.reduceat(largest, first)
        child = np.left_shift(np.uint8(1), (keys & ((1 << width) - 1)).astype(np.uint8))
        treap.bits.append(np.add.reduceat(child, first, dtype=np.uint8))
        treap.lacks.append(np.repeat(above, np.diff(np.append(first, len(parents)))) - largest)
        keys, largest = parents[first], above
    treap.lacks.append(largest)  # the root's, of nothing
    treap.bits.reverse()
    treap.lacks.reverse()
    return treap


class Descent:
    """A treap made ready: of each level the largest impacts, the children's bits and the
    first child.  The last node of every level stands for emptiness."""

    def __init__(self, treap: Treap):
        self.splits = _splits(treap.row_levels, treap.column_levels)
        self.largest = [np.append(treap.lacks[0], 0).astype(np.int32)]
        self.bits, self.first = [], []
        for bits, lacks in zip(treap.bits, treap.lacks[1:], strict=True):
            counts = _CHILDREN[bits].astype(np.int64)
            self.bits.append(np.append(bits, 0).astype(np.uint8))
            self.first.append(np.append(np.cumsum(counts) - counts, len(lacks)))
            above = np.repeat(self.largest[-1][:-1], counts)
            self.largest.append(np.append(above - lacks, 0).astype(np.int32))

    def child(self, level: int, nodes: np.ndarray, digit: np.ndarray | int) -> np.ndarray:
        """The nodes' children with that digit; the node of emptiness where there is none."""
        bits = self.bits[level][nodes]
        found = self.first[level][nodes] + _BEFORE[bits, digit]
        return np.where(bits >> digit & 1, found, len(self.largest[level + 1]) - 1)

    def search(
        self, rows: np.ndarray, weights: np.ndarray, least: int, best: int, columns: int
    ) -> list[tuple[int, int]]:
        """(score, column) of the documents with the greatest scores, ``best`` at least if
        so many have a score from ``least`` on; a few more may be among them.

        Scores are exact; of equal ones none is left out.
        """
        if len(rows) < _FEW_TERMS:
            weights = weights.astype(np.float64)
        wide = max(1, STEP_CELLS // max(len(rows), 1))
        found: list[int] = []  # the greatest scores, a heap
        hits: list[tuple[int, int]] = []
        start = np.zeros((1, len(rows)), np.int64)
        bound = self.largest[0][start] @ weights
        groups: list[tuple] = [(-bound[0], 0, 0, bound, np.zeros(1, np.int64), start)]
        number = 0
        while groups and -groups[0][0] >= least:
            _, _, level, bounds, places, nodes = heapq.heappop(groups)
            fit = bounds >= least
            # First a few ranges down to their documents; these rule out most others.
            together = wide if least > 1 else min(wide, 2 * best)
            if len(bounds) > together:
                rest = np.argpartition(-bounds, together)
                some, rest = rest[:together], rest[together:]
                rest = rest[fit[rest]]
                if len(rest):
                    number += 1
                    top = bounds[rest].max()
                    heapq.heappush(
                        groups, (-top, number, level, bounds[rest], places[rest], nodes[rest])
                    )
                fit = some[fit[some]]
            bounds, places, nodes = bounds[fit], places[fit], nodes[fit]
            if level == len(self.splits):
                for score, place in zip(bounds.astype(np.int64).tolist(), places.tolist(), strict=True):
                    hits.append((score, place))
                    heapq.heappush(found, score)
                    if len(found) > best:
                        heapq.heappop(found)
                if len(found) == best:
                    least = max(least, found[0])
                continue
            by_row, by_column = self.splits[level]
            digit = rows >> self._row_shift(level) & 1 if by_row else np.zeros_like(rows)
            opened = []
            for half in (0, 1) if by_column else (0,):
                within = digit << 1 | half if by_row and by_column else digit | half
                child = self.child(level, nodes, within)
                bound = self.largest[level + 1][child] @ weights
                opened.append((bound, places << 1 | half if by_column else places, child))
            bounds, places, nodes = (np.concatenate(x) for x in zip(*opened, strict=True))
            fit = bounds >= least
            if fit.any():
                number += 1
                bounds = bounds[fit]
                heapq.heappush(
                    groups, (-bounds.max(), number, level + 1, bounds, places[fit], nodes[fit])
                )
        return [hit for hit in hits if hit[0] >= least and hit[1] < columns]

    def _row_shift(self, level: int) -> int:
        return len(self.splits) - 1 - level

    def filled(self, rows: np.ndarray) -> np.ndarray:
        """How many documents each of the rows has."""
        nodes, owner = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for level, (by_row, by_column) in enumerate(self.splits):
            digit = rows[owner] >> self._row_shift(level) & 1 if by_row else 0 * owner
            parts = []
            for half in (0, 1) if by_column else (0,):
                within = digit << 1 | half if by_row and by_column else digit | half
                child = self.child(level, nodes, within)
                there = child < len(self.largest[level + 1]) - 1
                parts.append((child[there], owner[there]))
            nodes, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        return np.bincount(owner, minlength=len(rows))


def impact(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The impacts of terms by their occurrences and their documents' length measures."""
    return (IMPACT_SCALE * tf) // (TERM_SCALE * tf + LENGTH_SCALE * length)


def _length_measure(n: int, docs: int, terms: int) -> int:
    return 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * docs // terms


class _Gathered:
    """Documents on their way into a block: their terms as numbers, not as texts."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.idents: list = []
        self.measures: list[int] = []
        self.rows: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, ident: object, text: bytes | None, docs: int, terms: int) -> None:
        counts: Counter[bytes] = Counter()
        for some in terms_of(text):
            counts.update(some)
        if not counts:
            return
        numbers = self.numbers
        own = (numbers.setdefault(term, len(numbers)) for term in counts)
        self.rows.append(np.fromiter(own, np.int32, len(counts)))
        self.counts.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.idents.append(ident)
        self.measures.append(_length_measure(counts.total(), docs, terms))
        self.size += len(text or b"")

    def full(self) -> bool:
        return len(self.idents) >= BLOCK_DOCS or self.size >= BLOCK_BYTES

    def block(self, kind: pa.DataType) -> pa.RecordBatch:
        """A row of the index: identifiers by column, terms by row, and the treap."""
        by_ident = sorted(range(len(self.idents)), key=lambda i: _place((0, self.idents[i])))
        column = np.empty(len(by_ident), np.int32)
        column[by_ident] = np.arange(len(by_ident))
        sizes = [len(own) for own in self.rows]
        rows = np.concatenate(self.rows)
        measures = np.repeat(np.array(self.measures, np.int64), sizes)
        impacts = impact(np.concatenate(self.counts), measures).astype(np.int32)
        del measures
        # Rows of like frequency lie together, so that squares are full or empty.
        order = np.argsort(-np.bincount(rows, minlength=len(self.numbers)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        shape = len(order), len(by_ident)
        treap = build_treap(place[rows], np.repeat(column, sizes), impacts, shape)
        names = pa.array(list(self.numbers), pa.binary()).take(pa.array(order))
        packed = {
            "row_levels": treap.row_levels,
            "column_levels": treap.column_levels,
            "bits": [x.tobytes() for x in treap.bits],
            "lacks": [_narrow(x) for x in treap.lacks],
        }
        return pa.RecordBatch.from_arrays(
            [
                pa.array([[self.idents[i] for i in by_ident]], pa.list_(kind)),
                pa.array([b" ".join(names.to_pylist())]),
                pa.array([packed], _TREAP),
            ],
            ["idents", "terms", "treap"],
        )


_TREAP = pa.struct(
    [
        ("row_levels", pa.int32()),
        ("column_levels", pa.int32()),
        ("bits", pa.list_(pa.binary())),
        ("lacks", pa.list_(pa.binary())),
    ]
)


def _index(docs: int, terms: int):
    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = _Gathered(), None
        for batch in _few(batches):
            kind = batch["ident"].type
            for ident, text in zip(batch["ident"].to_pylist(), byte_texts(batch["text"]), strict=True):
                held.add(ident, text, docs, terms)
                if held.full():
                    yield held.block(kind)
                    held = _Gathered()
        if held.idents:
            yield held.block(kind)

    return index


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers below 2^24 in three bytes."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _wide(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8).reshape(-1, 3)
    found = np.zeros((len(parts), 4), np.uint8)
    found[:, :3] = parts
    return found.view("<i4").ravel()


def _descent(packed: dict) -> Descent:
    bits = [np.frombuffer(x, np.uint8) for x in packed["bits"]]
    lacks = [_wide(x) for x in packed["lacks"]]
    return Descent(Treap(packed["row_levels"], packed["column_levels"], bits, lacks))


@dataclass(frozen=True)
class Index:
    """A table of blocks, and the numbers of documents with terms and of their terms."""

    blocks: DataFrame
    docs: int
    terms: int


def build_index(rows: DataFrame, ident: str = "doc_id", text: str = "text") -> Index:
    """Index all texts; the table lies in the shared folder.

    Null texts and those without a term have no place in it.  Rows that repeat an
    identifier, or have none, are documents of their own.  Texts of any length are read
    whole.  Other columns are ignored, whatever their names.
    """
    texts = rows.select(rows[ident].alias("ident"), rows[text].alias("text"))
    counted = texts.select("text").mapInArrow(_count_lengths, "docs long, terms long")
    spark = rows.sparkSession
    with few_rows(spark, _TEXTS):
        docs, terms = counted.agg(
            F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))
        ).first()
    kind = texts.schema["ident"].dataType.simpleString()
    schema = (
        f"idents array<{kind}>, terms binary, "
        "treap struct<row_levels: int, column_levels: int, bits: array<binary>, lacks: array<binary>>"
    )
    path = scratch_path(spark, "lexical-index")
    with few_rows(spark, _TEXTS):
        texts.mapInArrow(_index(docs, terms), schema).write.options(**_FILES).parquet(path)
    return Index(spark.read.schema(schema).parquet(path), docs, terms)


@dataclass(frozen=True)
class _Queries:
    """Items' terms, as numbers, and the weight of each number."""

    items: list[tuple[int, np.ndarray]]  # number of the item, its terms
    terms: pa.Array
    weights: np.ndarray


def _rows_of(block_terms: bytes, wanted: pa.Array) -> np.ndarray:
    """The row of each wanted term in a block; -1 where it has none."""
    names = pa.array(block_terms.split(b" "), pa.binary())
    found = pc.index_in(wanted, value_set=names)
    return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _frequencies(shared):
    """How many documents of all blocks have each of the items' terms."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                rows = _rows_of(batch["terms"][i].as_py(), wanted)
                there = np.flatnonzero(rows >= 0)
                if len(there):
                    total[there] += _descent(batch["treap"][i].as_py()).filled(rows[there])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some), "n": pa.array(total[some])})

    return count


def _search(shared, best: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: _Queries = shared.value
        tops: list[list[tuple]] = [[] for _ in queries.items]
        kind = None
        for batch in batches:
            kind = batch["idents"].type.value_type
            for i in range(len(batch)):
                rows = _rows_of(batch["terms"][i].as_py(), queries.terms)
                idents = batch["idents"][i].as_py()
                descent = _descent(batch["treap"][i].as_py())
                for at, (_, terms) in enumerate(queries.items):
                    own = terms[rows[terms] >= 0]
                    own = own[queries.weights[own] > 0]
                    if not len(own):
                        continue
                    top = tops[at]
                    least = top[best - 1][0] if len(top) >= best else 1
                    hits = descent.search(
                        rows[own], queries.weights[own], least, best, len(idents)
                    )
                    if hits:
                        top += [(score, idents[column]) for score, column in hits]
                        top.sort(key=_place)
                        del top[best:]
        if kind is not None:
            found = [
                (number, score, ident)
                for (number, _), top in zip(queries.items, tops, strict=True)
                for score, ident in top
            ]
            numbers, scores, idents = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(scores, pa.int64()), pa.array(idents, kind)],
                ["item", "score", "ident"],
            )

    return search


def _place(hit: tuple) -> tuple:
    score, ident = hit
    return -score, ident is None, 0 if ident is None else ident


def _weights(counts: np.ndarray, docs: int) -> np.ndarray:
    """The terms' weights by the numbers of documents that have them."""
    return np.array(
        [math.floor(WEIGHT_SCALE * math.log((2 * docs + 2) / (2 * n + 1))) for n in counts.tolist()],
        np.int64,
    )


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [sum(map(len, terms_of(text))) for text in byte_texts(batch["text"])]
        yield pa.RecordBatch.from_pydict({"n": pa.array(counts, pa.int64())})


def search(
    index: Index,
    items: DataFrame,
    item: str = "item_id",
    text: str = "text",
    ident: str = "doc_id",
    best: int = BEST,
) -> DataFrame:
    """``item, rank, ident, score`` of each item's best documents, ``best`` at most.

    Only scores above 0; equal ones by ascending identifier, nulls last.  Items that are
    null, empty or share no term with a document get no rows; repeated items get theirs
    each.  Of an item's repeated terms one counts.  An item of any length is read whole.
    Items are searched in rounds of about ``TERMS_AT_ONCE`` terms, by their hash.  Other
    columns are ignored, whatever their names.
    """
    given = items.select(items[item].alias("item"), items[text].alias("text"))
    # Items that are the same text are searched once.
    texts = given.where("text is not null").select("text").distinct()
    counted = texts.mapInArrow(_count_terms, "n long").agg(F.sum("n")).first()[0] or 0
    rounds = -(-counted // TERMS_AT_ONCE)
    spark = items.sparkSession
    number, rank = F.col("number"), F.col("rank")
    kind = index.blocks.schema["idents"].dataType.elementType.simpleString()
    schema = f"item long, score long, ident {kind}"
    found = None
    for turn in range(rounds):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn)
        some = [row.text for row in part.collect()]
        numbers: dict[bytes, int] = {}
        asked = []
        for i, words in enumerate(terms_of(x.encode()) for x in some):
            own = {numbers.setdefault(term, len(numbers)) for terms in words for term in terms}
            asked.append((i, np.array(sorted(own), np.int64)))
        wanted = pa.array(list(numbers), pa.binary())
        counts = np.zeros(len(wanted), np.int64)
        if len(wanted):
            shared = spark.sparkContext.broadcast(wanted)
            seen = index.blocks.select("terms", "treap").mapInArrow(
                _frequencies(shared), "term long, n long"
            )
            with few_rows(spark, _BLOCKS):
                for row in seen.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
                    counts[row.term] = row.n
            shared.destroy()
        queries = _Queries([x for x in asked if len(x[1])], wanted, _weights(counts, index.docs))
        hits = index.blocks.mapInArrow(_search(spark.sparkContext.broadcast(queries), best), schema)
        names = spark.createDataFrame(list(enumerate(some)), "number long, text string")
        with few_rows(spark, _BLOCKS):
            top = settled(_best(hits, best))
        top = top.join(F.broadcast(names), F.col("item") == number).select(
            "text", "rank", "score", "ident"
        )
        found = top if found is None else found.unionByName(top)
    if found is None:
        found = spark.createDataFrame([], f"text string, rank int, score long, ident {kind}")
    return given.join(found, "text").select(
        F.col("item").alias(item), rank, F.col("ident").alias(ident), "score"
    )


def _best(hits: DataFrame, best: int) -> DataFrame:
    """The best hits of each item; first of some tasks together, then of all."""
    ways = max(1, math.isqrt(hits.rdd.getNumPartitions()))
    order = [F.col("score").desc(), F.col("ident").asc_nulls_last()]
    some = Window.partitionBy("item", "way").orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    near = hits.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(ways)))
    near = near.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= best)
    last = near.drop("way").withColumn("rank", F.row_number().over(every))
    return last.where(F.col("rank") <= best)
