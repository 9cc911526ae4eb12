"""Compress vectors to codes: k-means per part, sped up by anchors-hierarchy metric trees.

Vectors become integers and are cut into equal parts.  Blocks of rows are made once; in a
block each part position has a metric tree, built middle-out: anchors take over the points
that are nearest to them, near anchors are merged upwards to the root, and what an anchor
owns is built downwards in the same way.  A ball caches the sum and the count of its points.

A round walks the trees with the codebook's entries as candidates.  Of the entries that a
ball inherits, those that are nowhere in the ball the nearest ones drop out; once a single
one is left it owns the ball, whose cached sum is added without a look at its points.  All
arithmetic is on integers, and a ball's bound errs on the side of keeping an entry, so the
codes are those of comparing every part with every entry.

Trees stay in the shared folder between the rounds.  Between rounds only sums of fixed size
(entries x components) leave the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import BROADCAST_ROWS, release, settled, summed_arrays

#: Parts of a vector, entries of a codebook, rounds, and steps of a component per unit.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Components of a block of rows; its trees are in memory together.
BLOCK_VALUES = 1 << 18
#: A ball of so many points or fewer is a leaf.
LEAF = 48
#: Labels with more than one in so many rows are hot: there are fewer of them than this.
HOT_SHARE = 20_000

# Numbers up to this are exact in double precision.
_EXACT = 1 << 53


@dataclass
class Tree:
    """Balls by number, the root last; a ball's points lie together in ``points``."""

    points: np.ndarray  # [point, component]
    order: np.ndarray  # row of each point
    pivots: np.ndarray  # [ball, component]
    radii: np.ndarray  # at least the distance of any point
    sums: np.ndarray  # [ball, component]
    spans: np.ndarray  # [ball, 2]: first point, and the one after the last
    children: np.ndarray  # [ball, 2]; -1 in leaves


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """Squared distances; points and pivots are whole numbers."""
    away = points - pivot
    return np.einsum("ij,ij->i", away, away)


def _anchors(points: np.ndarray, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(pivot's row, rows that it owns) of about the square root of so many anchors.

    Each new anchor is the point farthest from its own, and takes over the points that
    are nearer to it.  An anchor's points are in the order of falling distance, so what
    lies within half the way to the new anchor need not be asked.
    """
    wanted = max(2, int(np.sqrt(len(rows))))
    squares = _distances(points[rows], points[rows[0]])
    order = np.argsort(-squares, kind="stable")
    pivots, owned, far = [int(rows[0])], [rows[order]], [squares[order]]
    while len(pivots) < wanted:
        widest = max(range(len(pivots)), key=lambda i: far[i][0])
        if far[widest][0] == 0:
            break
        new = int(owned[widest][0])
        between = _distances(points[pivots], points[new])
        taken, taken_squares = [], []
        for i, gap in enumerate(between.tolist()):
            # sqrt(square) < sqrt(gap) / 2 is left alone.
            n = int(np.searchsorted(-4 * far[i], -gap, side="right"))
            if not n:
                continue
            asked = owned[i][:n]
            to_new = _distances(points[asked], points[new])
            goes = to_new < far[i][:n]
            if goes.any():
                taken.append(asked[goes])
                taken_squares.append(to_new[goes])
                owned[i] = np.concatenate([asked[~goes], owned[i][n:]])
                far[i] = np.concatenate([far[i][:n][~goes], far[i][n:]])
        squares = np.concatenate(taken_squares)
        order = np.argsort(-squares, kind="stable")
        pivots.append(new)
        owned.append(np.concatenate(taken)[order])
        far.append(squares[order])
    return list(zip(pivots, owned, strict=True))


class _Builder:
    def __init__(self, points: np.ndarray):
        self.points = points
        self.balls: list[tuple] = []  # pivot, radius, sum, children, rows of a leaf

    def leaf(self, pivot: np.ndarray, rows: np.ndarray) -> int:
        own = self.points[rows]
        radius = np.sqrt(float(_distances(own, pivot).max()))
        self.balls.append((pivot, radius, own.sum(0), (-1, -1), rows, len(rows)))
        return len(self.balls) - 1

    def merged(self, left: int, right: int) -> int:
        a, b = self.balls[left], self.balls[right]
        total, count = a[2] + b[2], a[5] + b[5]
        pivot = total // count
        radius = max(np.sqrt(float(_distances(x[0][None], pivot)[0])) + x[1] for x in (a, b))
        self.balls.append((pivot, radius, total, (left, right), None, count))
        return len(self.balls) - 1

    def built(self, pivot: np.ndarray, rows: np.ndarray) -> int:
        """The root ball of these rows."""
        if len(rows) <= LEAF:
            return self.leaf(pivot, rows)
        anchors = _anchors(self.points, rows)
        if len(anchors) == 1:
            return self.leaf(pivot, rows)
        return self.up([self.built(self.points[at], own) for at, own in anchors])

    def up(self, roots: list[int]) -> int:
        """Merge the two balls that fit into the smallest one, until one is left."""
        pivots = np.array([self.balls[i][0] for i in roots])
        radii = np.array([self.balls[i][1] for i in roots])
        alive = np.array(roots)
        away = pivots[:, None] - pivots[None]
        widths = np.sqrt(np.einsum("ijk,ijk->ij", away, away).astype(np.float64))
        widths += radii[:, None] + radii[None]
        np.fill_diagonal(widths, np.inf)
        for _ in range(len(roots) - 1):
            i, j = np.unravel_index(widths.argmin(), widths.shape)
            ball = self.merged(int(alive[i]), int(alive[j]))
            alive[i], pivots[i], radii[i] = ball, self.balls[ball][0], self.balls[ball][1]
            widths[j], widths[:, j] = np.inf, np.inf
            rest = np.isfinite(widths[i])
            new = np.sqrt(_distances(pivots[rest], pivots[i]).astype(np.float64))
            widths[i, rest] = widths[rest, i] = new + radii[rest] + radii[i]
        return ball


def build_tree(points: np.ndarray) -> Tree:
    """A metric tree over the rows of whole numbers."""
    builder = _Builder(points)
    root = builder.built(points[0], np.arange(len(points)))
    balls = builder.balls
    spans = np.zeros((len(balls), 2), np.int64)
    order: list[np.ndarray] = []
    filled, waiting = 0, [(root, False)]
    while waiting:
        ball, ended = waiting.pop()
        _, _, _, (left, right), rows, _ = balls[ball]
        if ended:
            spans[ball, 1] = filled
            continue
        spans[ball, 0] = filled
        waiting.append((ball, True))
        if rows is None:
            waiting += [(right, False), (left, False)]
        else:
            order.append(rows)
            filled += len(rows)
    places = np.concatenate(order)
    return Tree(
        points[places],
        places,
        np.array([b[0] for b in balls]),
        np.array([b[1] for b in balls], np.float64),
        np.array([b[2] for b in balls]),
        spans,
        np.array([b[3] for b in balls], np.int64),
    )


def _nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest entry, the first of equal ones, and its squared distance."""
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(largest) ** 2 * max(points.shape[1], 1) < _EXACT:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    squares = np.einsum("ij,ij->i", entries, entries) - 2 * (points @ entries.T)
    best = squares.argmin(1)
    least = squares[np.arange(len(points)), best] + np.einsum("ij,ij->i", points, points)
    return best, least.astype(np.int64)


def owners(tree: Tree, entries: np.ndarray) -> Iterator[tuple[int, int, np.ndarray | None]]:
    """(ball, entry, None) of balls that one entry owns, and (ball, -1, owners) of leaves
    whose points have several."""
    gaps = entries[:, None] - entries[None]
    apart = np.sqrt(np.einsum("ijk,ijk->ij", gaps, gaps).astype(np.float64))
    waiting = [(len(tree.radii) - 1, np.arange(len(entries)))]
    while waiting:
        ball, candidates = waiting.pop()
        squares = _distances(entries[candidates], tree.pivots[ball])
        near = int(squares.argmin())
        best = candidates[near]
        # How much farther a candidate is, at the point of the ball where it is least so;
        # a little less, as roots are rounded.
        slack = 2 * tree.radii[ball] * apart[best, candidates]
        least = (squares - squares[near]) - slack * (1 + 1e-9)
        kept = candidates[(least < 0) | (least == 0) & (candidates <= best)]
        if len(kept) == 1:
            yield ball, int(kept[0]), None
        elif tree.children[ball, 0] < 0:
            start, stop = tree.spans[ball]
            yield ball, -1, kept[_nearest(tree.points[start:stop], entries[kept])[0]]
        else:
            waiting += [(int(child), kept) for child in tree.children[ball]]


def entry_sums(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """[entry, component and count] of the points that each entry owns."""
    width = tree.points.shape[1]
    total = np.zeros((len(entries), width + 1), np.int64)
    for ball, entry, mixed in owners(tree, entries):
        start, stop = tree.spans[ball]
        if mixed is None:
            total[entry, :width] += tree.sums[ball]
            total[entry, width] += stop - start
        else:
            np.add.at(total[:, :width], mixed, tree.points[start:stop])
            total[:, width] += np.bincount(mixed, minlength=len(entries))
    return total


def assigned(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row: the entry that owns it, and the squared distance."""
    found = np.zeros(len(tree.order), np.int64)
    for ball, entry, mixed in owners(tree, entries):
        start, stop = tree.spans[ball]
        found[tree.order[start:stop]] = entry if mixed is None else mixed
    points = np.empty_like(tree.points)
    points[tree.order] = tree.points
    away = points - entries[found]
    return found, np.einsum("ij,ij->i", away, away)


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """[row, component]: floors of the scaled components; short vectors end in zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    # Beyond this a squared distance might not fit into a long.
    if len(values) and np.abs(values).max() >= np.sqrt((1 << 61) / max(width, 1)):
        raise ValueError("a component is too large for distances in whole numbers")
    found = np.zeros((len(lengths), width), np.int64)
    found[np.arange(width) < lengths[:, None]] = values.astype(np.int64)
    return found


def _blocks(width: int):
    """Rows of trees: a block's identifiers, labels and, for each part, its tree."""
    rows_at_once = max(1, BLOCK_VALUES // max(width, 1))

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for start in range(0, len(batch), rows_at_once):
                held.append(batch.slice(start, rows_at_once))
                if sum(map(len, held)) >= rows_at_once:
                    yield block(held)
                    held = []
        if sum(map(len, held)):
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(held)
        points = whole_numbers(rows["vector"], width)
        trees = [_packed(build_tree(part)) for part in np.split(points, PARTS, axis=1)]
        columns = [
            pa.array([rows["ident"].to_pylist()], pa.list_(rows["ident"].type)),
            pa.array([rows["label"].to_pylist()], pa.list_(rows["label"].type)),
            pa.array([trees], pa.list_(pa.list_(pa.binary()))),
        ]
        return pa.RecordBatch.from_arrays(columns, ["idents", "labels", "trees"])

    return blocks


_TREE_TYPES = ("int64", "int64", "int64", "float64", "int64", "int64", "int64")


def _packed(tree: Tree) -> list[bytes]:
    return [
        np.ascontiguousarray(array, dtype).tobytes()
        for array, dtype in zip(vars(tree).values(), _TREE_TYPES, strict=True)
    ]


def _unpacked(data: list[bytes]) -> Tree:
    arrays = [np.frombuffer(x, dtype) for x, dtype in zip(data, _TREE_TYPES, strict=True)]
    points, order, pivots, radii, sums, spans, children = arrays
    wide = (points.reshape(len(order), -1), pivots.reshape(len(radii), -1))
    return Tree(
        wide[0],
        order,
        wide[1],
        radii,
        sums.reshape(len(radii), -1),
        spans.reshape(-1, 2),
        children.reshape(-1, 2),
    )


def _summed(shared):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        totals = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in books]
        for batch in batches:
            for block in batch["trees"]:
                for book, total, tree in zip(books, totals, block.as_py(), strict=True):
                    total += entry_sums(_unpacked(tree), book)
        keys = [str(part) for part in range(len(books))]
        yield pa.RecordBatch.from_pydict({"key": keys, "data": [t.tobytes() for t in totals]})

    return add


def _coded(shared):
    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            for i in range(len(batch)):
                idents, labels = batch["idents"][i].values, batch["labels"][i].values
                codes = np.zeros((len(idents), PARTS), np.uint8)
                error = np.zeros(len(idents), np.int64)
                for part, tree in enumerate(batch["trees"][i].as_py()):
                    codes[:, part], squares = assigned(_unpacked(tree), books[part])
                    error += squares
                text = codes.tobytes().hex()
                step = 2 * PARTS
                yield pa.RecordBatch.from_arrays(
                    [
                        idents,
                        labels,
                        pa.array([text[at : at + step] for at in range(0, len(text), step)]),
                        pa.array(error),
                    ],
                    ["ident", "label", "code", "error"],
                )

    return code


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    numbers = (str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress_vectors(
    rows: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``ident, label, code, error, label_error`` per row, and the codebooks by part.

    Rows whose vector is null or has a null or non-finite component are left out.  A
    component x becomes floor(256 * x).  Codebooks start as the parts of the 64 rows with
    the least identifiers, nulls last, of equal ones those with the least vector; fewer
    rows give fewer entries.  Unused entries stay.  ``label_error`` is the error of all
    rows with an equal label, of which null is one.  Repeated rows come back as often.
    Vectors shorter than the longest, or than a multiple of 16 components, count as if
    they went on with zeros; an empty table gives no rows and no codebooks.  A component
    of which distances would not fit into a long is an error.  Other columns are ignored,
    whatever their names.
    """
    if ENTRIES > 256:
        raise ValueError("a code has two hex digits")
    values = F.col("vector")
    unfit = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select(
        rows[ident].alias("ident"), rows[vector].alias("vector"), rows[label].alias("label")
    ).where(values.isNotNull() & ~unfit)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    width = -(-(longest or 0) // PARTS) * PARTS
    first = kept.orderBy(F.col("ident").asc_nulls_last(), "vector").limit(ENTRIES)
    start = whole_numbers(first.select("vector").toArrow()["vector"].combine_chunks(), width)
    books = list(np.split(start, PARTS, axis=1)) if longest is not None else []
    schema = (
        f"idents array<{kinds['ident']}>, labels array<{kinds['label']}>, "
        "trees array<array<binary>>"
    )
    trees = settled(kept.mapInArrow(_blocks(width), schema))
    context = rows.sparkSession.sparkContext
    for _ in range(rounds if books else 0):
        shared = context.broadcast(books)  # entries x components
        sums = summed_arrays(trees.mapInArrow(_summed(shared), "key string, data binary"), "int64")
        found = {int(row.key): np.frombuffer(row.data, np.int64) for row in sums.collect()}
        books = [_moved(book, found[part]) for part, book in enumerate(books)]
        shared.destroy()
    schema = f"ident {kinds['ident']}, label {kinds['label']}, code string, error long"
    coded = settled(trees.mapInArrow(_coded(context.broadcast(books)), schema))
    release(trees)
    told = _with_label_error(coded)
    return told.withColumnsRenamed({"ident": ident, "label": label}), books


def _moved(book: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Entries at the floors of their points' means; unused ones stay."""
    sums = sums.reshape(len(book), -1)
    counts = sums[:, -1:]
    return np.where(counts > 0, sums[:, :-1] // np.maximum(counts, 1), book)


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Errors are added before any shuffle; rows of hot labels are not shuffled at all."""
    by_label = settled(
        coded.groupBy(F.col("label").alias("of")).agg(
            F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")
        )
    )
    same = F.col("label").eqNullSafe(F.col("of"))
    columns = ["ident", "label", "code", "error", "label_error"]
    if by_label.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return coded.join(F.broadcast(by_label), same).select(columns)
    hot = by_label.where(F.col("n") * HOT_SHARE > by_label.agg(F.sum("n")).scalar())
    marked = coded.join(
        F.broadcast(hot.select(F.col("of"), "label_error", F.lit(True).alias("hot"))), same, "left"
    )
    rest = marked.where("hot is null").drop("of", "label_error", "hot")
    return (
        marked.where("hot")
        .select(columns)
        .unionByName(rest.join(by_label, same).select(columns))
    )
