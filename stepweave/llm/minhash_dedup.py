"""Near-duplicate documents by bottom-k sketches.

One hash function; a document's sketch is the k least hashes of its word shingles.
Inverted lists of the retained values give candidates, a sketch of the union estimates
their similarity, and the full sets decide.

* Equal sets are one class, compared once.
* Similar sets share many retained values, so a pair meets in a list of one of its
  rarest values: only these are listed (a prefix filter), and values of one class never.
* In each list every class is first compared with one leader.  That settles groups of
  copies without forming their pairs.  Where a list still spans several components, those
  that differ from most of its members are compared with all, in cells of bounded size,
  which give out only links that join components.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import (
    PIECE_BYTES,
    Steps,
    WindowHasher,
    byte_texts,
    components,
    having,
    in_pieces,
    is_short,
)

#: Words of a shingle, percent of similarity, retained values.
SHINGLE = 5
PERCENT = 85
SKETCH = 64
#: How many standard deviations estimates may be off.
DEVIATIONS = 6.0
#: Classes of a list that are compared at once.
BLOCK = 512
#: A cell of a list has sets of about so many bytes together; a member counts as this many
#: more, so that members are not too many either.
CELL_BYTES = 1 << 23
MEMBER_BYTES = 1 << 11
#: Lists that are a class's homes; and sets of homes of a list that are told apart.
HOMES, KINDS = 3, 64
_COLUMNS_AT_ONCE = 4096


def shingle_sets(
    texts: Iterable[bytes | None], size: int = SHINGLE
) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ordered distinct hashes of its shingles) of each text with words.

    A-Z count as a-z.  A text of fewer words has one shingle, the whole.
    """
    hasher = WindowHasher(5)
    split = ((row, text.lower().split()) for row, text in enumerate(texts) if text)
    rows = ((row, words) for row, words in split if words)
    for piece in in_pieces(rows, lambda item: sum(map(len, item[1])) + len(item[1]), PIECE_BYTES):
        hasher.load([word for _, words in piece for word in words])
        begin = 0
        for row, words in piece:
            length = min(size, len(words))
            first = np.arange(begin, begin + len(words) - length + 1)
            yield row, np.unique(hasher.windows(first, length))
            begin += len(words)


def _sketches(size: int, k: int):
    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(len(batch), np.int64)
            least: list[np.ndarray | None] = [None] * len(batch)
            # Texts without words have a class of their own.
            classes = [b"none:%d" % (ident or 0) for ident in batch["ident"].to_pylist()]
            for row, hashes in shingle_sets(byte_texts(batch["text"]), size):
                counts[row] = len(hashes)
                least[row] = hashes[:k].view(np.int64)
                classes[row] = xxhash.xxh3_128_digest(hashes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["ident"],
                    pa.array(classes, pa.binary()),
                    pa.array(counts),
                    pa.array(least, pa.list_(pa.int64())),
                ],
                ["ident", "class", "n_shingles", "sketch"],
            )

    return sketch


def _full_sets(size: int):
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found, total = [], [], 0
            for row, hashes in shingle_sets(byte_texts(batch["text"]), size):
                nodes.append(batch["node"][row].as_py())
                found.append(hashes.tobytes())
                total += len(found[-1])
                if total >= 8 * PIECE_BYTES:
                    yield _node_sets(nodes, found)
                    nodes, found, total = [], [], 0
            if nodes:
                yield _node_sets(nodes, found)

    return sets


def _node_sets(nodes: list, sets: list) -> pa.RecordBatch:
    columns = [pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["node", "set"])


def least_shared(size: Column, k: int = SKETCH, percent: int = PERCENT) -> Column:
    """How many retained values at least a similar pair shares, by the size of a sketch.

    A full sketch is a random sample of the union: fewer by so many deviations do not
    happen.  A sketch with room is the whole set, of which ``percent`` are shared; the
    other set may be a little larger and have lost some.
    """
    share = percent / 100
    sampled = math.floor(k * share - DEVIATIONS * math.sqrt(k * share * (1 - share)))
    lost = F.greatest(F.floor(size / share) - k, F.lit(0))
    return F.when(size >= k, max(1, sampled)).otherwise(
        F.greatest(F.ceil(size * share - 1e-9) - lost, F.lit(1))
    )


def near_duplicates(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
    k: int = SKETCH,
    held: Steps | None = None,
) -> DataFrame:
    """Per row: ``ident, n_shingles, component_id, kept``.

    Two texts are linked if 100 times their common shingles are at least ``percent``
    times all of theirs.  ``component_id`` is the least identifier that links reach and
    ``kept`` marks it.  A null text or one without words has no shingles and no links.
    Identifiers are integers; rows that share one share a component.  A row with a null
    identifier is compared with nothing, has a null component and is kept.  Repeated rows
    come back as often.  Other columns are ignored, whatever their names.
    """
    held = Steps() if held is None else held  # what the result reads stays with it
    texts = docs.select(docs[ident].cast("long").alias("ident"), docs[text].alias("text"))
    schema = "ident long, class binary, n_shingles long, sketch array<long>"
    rows = held.settled(texts.mapInArrow(_sketches(size, k), schema))
    classes = held.settled(
        rows.where("ident is not null and n_shingles > 0")
        .groupBy("class")
        .agg(
            F.min("ident").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        )
    )
    steps = Steps()
    lists = steps.settled(_lists(classes, k, percent, steps))
    members = lists.select("node").distinct()
    named = texts.withColumnRenamed("ident", "node")
    sets = steps.settled(
        having(named, "node", members).mapInArrow(_full_sets(size), "node long, set binary")
    )
    first = steps.settled(_leader_links(lists, classes, sets, k, percent))
    labels = components(first, held)
    later = steps.settled(_block_links(lists, classes, labels, sets, k, percent, steps))
    if not later.isEmpty():
        labels = components(first.union(later), held)
    steps.release()  # what is left are rows, classes and labels
    placed = rows.join(classes.select("class", "node"), "class", "left").join(
        labels.withColumnRenamed("component", "linked"), "node", "left"
    )
    component = F.when(F.col("ident").isNotNull(), F.coalesce("linked", "node", "ident"))
    return placed.select(
        F.col("ident").alias(ident),
        "n_shingles",
        component.alias("component_id"),
        F.col("ident").eqNullSafe(component).alias("kept"),
    )


def _lists(classes: DataFrame, k: int, percent: int, steps: Steps) -> DataFrame:
    """``value, node, leader`` of the inverted lists of rare shared values.

    Lists of the same members are one.
    """
    retained = classes.select(
        "node", F.size("sketch").alias("size"), F.explode("sketch").alias("value")
    )
    shared = retained.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    known = retained.join(shared, "value")
    ordered = known.groupBy("node").agg(
        F.first("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("n", "value"))).alias("values"),  # at most k
    )
    # Of the sketch's values in this order, those of one class come first.
    prefix = F.col("size") - least_shared(F.col("size"), k, percent) + 1
    room = prefix - (F.col("size") - F.size("values"))
    listed = ordered.where(room > 0).select(
        "node",
        F.size("values").alias("central"),
        F.explode(F.slice("values", F.lit(1), room.cast("int"))).alias("entry"),
    )
    listed = steps.settled(listed.select("node", "central", "entry.value"))
    by_value = listed.groupBy("value").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("mark2"),
        F.max_by("node", F.struct("central", -F.col("node"))).alias("leader"),
    )
    one_each = (
        by_value.where("n > 1")
        .groupBy("n", "mark", "mark2")
        .agg(F.min(F.struct("value", "leader")).alias("kept"))
        .select("kept.value", "kept.leader", "n")
    )
    return listed.join(one_each, "value").select("value", "node", "leader", "n")


def _leader_links(
    lists: DataFrame, classes: DataFrame, sets: DataFrame, k: int, percent: int
) -> DataFrame:
    """Links ``a, b`` between leaders and members of their lists."""
    pairs = lists.where("node <> leader").select("leader", "node").distinct()
    sketch = classes.select("node", "n", "sketch")
    theirs = sketch.toDF("leader", "leader_n", "leader_sketch")
    both = pairs.join(sketch, "node").join(theirs, "leader")
    union = F.slice(F.array_sort(F.array_union("sketch", "leader_sketch")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("sketch", "leader_sketch")))
    share = percent / 100
    slack = DEVIATIONS * F.sqrt(F.lit(share * (1 - share)) / F.size(union))
    alike = (common / F.size(union) >= share - slack) & (
        F.least("n", "leader_n") * 100 >= F.greatest("n", "leader_n") * percent
    )
    likely = both.where(alike).select("leader", "node")
    with_sets = likely.join(sets, "node").join(sets.toDF("leader", "leader_set"), "leader")
    similar = F.arrow_udf(_similar(percent), "boolean")
    return with_sets.where(similar("set", "leader_set")).select(
        F.col("leader").alias("a"), F.col("node").alias("b")
    )


def _similar(percent: int):
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        found = []
        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            found.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(found)

    return similar


def _block_links(
    lists: DataFrame,
    classes: DataFrame,
    labels: DataFrame,
    sets: DataFrame,
    k: int,
    percent: int,
    steps: Steps,
) -> DataFrame:
    """Links between members of a list that are still in different components.

    A class's homes are the longest of its open lists.  Classes that share a home are
    compared there; other lists need those only that have a class without a common home
    beside them, which is seen from the few sets of homes that their members have.  So the
    rows stay in proportion to the classes, though copies meet in many lists.

    In a list, members of one component need no comparison.  As a rule one component has
    nearly all; it is dealt to cells once, and the few others go to each of them.  Only if
    these fill more than a cell themselves, all members are dealt to pairs of blocks.
    """
    told = lists.where("n > 2").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    spanning = (
        told.groupBy("value")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("value")
    )
    # With two members the leader has been compared with the other one.
    members = steps.settled(having(told, "value", spanning))
    longest = F.sort_array(F.collect_list(F.struct("n", "value")), asc=False)
    homes = members.groupBy("node").agg(F.slice(longest, 1, HOMES).getField("value").alias("homes"))
    members = members.join(homes, "node").select("value", "node", "component", "homes")
    members = steps.settled(members)
    kinds = members.groupBy("value", "homes").agg(F.count(F.lit(1)).alias("n"))
    many = kinds.groupBy("value").agg(F.count(F.lit(1)).alias("kinds")).where(f"kinds > {KINDS}")
    few_kinds = kinds.join(many, "value", "left_anti").groupBy("value").agg(
        F.collect_list("homes").alias("all")
    )
    alone = F.filter(
        "all", lambda x: F.exists("all", lambda y: ~F.arrays_overlap(x, y))
    )
    apart = few_kinds.select("value", F.explode(alone).alias("homes"))
    asked = apart.unionByName(kinds.join(many, "value", "left_semi").select("value", "homes"))
    asked = asked.withColumn("asked", F.lit(True))
    at_home = F.array_contains("homes", F.col("value"))
    weights = classes.select("node", (F.col("n") * 8 + MEMBER_BYTES).alias("weight"))
    shipped = (
        members.join(asked, ["value", "homes"], "left")
        .where(at_home | F.col("asked"))
        .drop("asked")
        .join(weights, "node")
    )
    members = steps.settled(shipped)
    parts = members.groupBy("value", "component").agg(F.sum("weight").alias("weight"))
    plan = (
        parts.groupBy("value")
        .agg(
            F.max(F.struct("weight", "component")).alias("most"),
            F.sum("weight").alias("all"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .withColumn("star", F.col("all") - F.col("most.weight") <= CELL_BYTES)
    )
    dealt_bytes = F.when(F.col("star"), F.col("most.weight")).otherwise(F.col("all"))
    plan = plan.withColumn("cells", F.ceil(dealt_bytes / CELL_BYTES).cast("int"))
    planned = members.join(F.broadcast(plan) if is_short(plan) else plan, "value")
    star, main = F.col("star"), F.col("component") == F.col("most.component")
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    every = F.sequence(F.lit(0), F.col("cells") - 1)
    dealt = planned.withColumns({"own": own, "main": main}).withColumn(
        "to", F.explode(F.when(star & F.col("main"), F.array("own")).otherwise(every))
    )
    cells = dealt.select(
        "value",
        F.when(star, F.lit(-1)).otherwise(F.least("own", "to")).alias("low"),
        F.when(star, F.col("to")).otherwise(F.greatest("own", "to")).alias("high"),
        F.when(star, (~F.col("main")).cast("int")).otherwise(F.col("own")).alias("side"),
        # The side whose members are also compared with each other in this cell.
        F.when(star, F.when(F.col("to") == 0, 1).otherwise(-1))
        .otherwise(F.when(F.col("own") == F.col("to"), F.col("own")).otherwise(-1))
        .alias("inner"),
        "node",
        "component",
        "homes",
    )
    return (
        cells.join(sets, "node")
        .groupBy("value", "low", "high")
        .applyInArrow(_linked(k, percent), "a long, b long")
        .distinct()
    )


def _least_shared(sizes: np.ndarray, k: int, percent: int) -> np.ndarray:
    """:func:`least_shared` of numbers."""
    share = percent / 100
    sampled = math.floor(k * share - DEVIATIONS * math.sqrt(k * share * (1 - share)))
    lost = np.maximum(np.floor(sizes / share) - k, 0)
    some = np.maximum(np.ceil(sizes * share - 1e-9) - lost, 1)
    return np.where(sizes >= k, max(1, sampled), some)


def _linked(k: int, percent: int):
    def linked(cell: pa.Table) -> pa.Table:
        """Links across components in one cell; a link that joins nothing is left out."""
        names = ("node", "component", "side", "inner")
        nodes, labels, side, inner = (cell[name].to_numpy() for name in names)
        # Pairs with a common home are compared there; here, if this list is one.
        value, here = cell["value"][0].as_py(), cell["homes"].to_pylist()
        at_home = np.array([value in homes for homes in here])
        kinds = {kind: i for i, kind in enumerate(dict.fromkeys(map(tuple, here)))}
        kind = np.array([kinds[tuple(homes)] for homes in here])
        strangers = _strangers(list(kinds))
        sets = [np.frombuffer(s, np.uint64) for s in cell["set"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        sketches = [s[:k] for s in sets]  # sets are in order
        shared = _least_shared(np.minimum(sizes, k), k, percent)
        roots = labels.copy()
        links = []
        # Alike lie together, so that most blocks of pairs are soon in one component.
        order = np.lexsort((sizes, labels))
        blocks = [order[at : at + BLOCK] for at in range(0, len(order), BLOCK)]
        for i, rows in enumerate(blocks):
            for columns in blocks[i:]:
                ask = side[rows][:, None] != side[columns][None]
                ask |= (side[rows] == inner[rows])[:, None] & (side[columns] == inner[columns])[None]
                ask &= (at_home[rows][:, None] & at_home[columns][None]) | strangers[
                    kind[rows][:, None], kind[columns][None]
                ]
                ask &= roots[rows][:, None] != roots[columns][None]
                least = np.minimum(sizes[rows][:, None], sizes[columns][None])
                most = np.maximum(sizes[rows][:, None], sizes[columns][None])
                ask &= 100 * least >= percent * most
                if not ask.any():
                    continue
                # Of the rest, those whose sketches share enough.
                ask[ask] = (
                    _common([sketches[x] for x in rows], [sketches[x] for x in columns])[ask]
                    >= np.maximum(shared[rows][:, None], shared[columns][None])[ask]
                )
                x, y = (np.flatnonzero(ask.any(axis)) for axis in (1, 0))
                if not len(x):
                    continue
                common = _common([sets[rows[at]] for at in x], [sets[columns[at]] for at in y])
                union = sizes[rows[x]][:, None] + sizes[columns[y]][None] - common
                hit = ask[np.ix_(x, y)] & (100 * common >= percent * union)
                for at_x, at_y in np.argwhere(hit).tolist():
                    one, other = rows[x[at_x]], columns[y[at_y]]
                    if roots[one] != roots[other]:
                        links.append((nodes[one], nodes[other]))
                        joined = roots == roots[other]
                        roots[joined] = roots[one]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return linked


def _strangers(kinds: list[tuple[int, ...]]) -> np.ndarray:
    """Which sets of homes have none in common."""
    homes, there = np.zeros((len(kinds), HOMES), np.int64), np.zeros((len(kinds), HOMES), bool)
    for i, kind in enumerate(kinds):
        homes[i, : len(kind)], there[i, : len(kind)] = kind, True
    shared = np.zeros((len(kinds), len(kinds)), bool)
    for i in range(HOMES):
        for j in range(HOMES):
            same = homes[:, i, None] == homes[None, :, j]
            shared |= same & there[:, i, None] & there[None, :, j]
    return ~shared


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from products of membership tables."""
    sizes = np.array([len(s) for s in (*left, *right)])
    values, places = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    members = np.repeat(np.arange(len(sizes)), sizes)
    several = np.bincount(places)[places] > 1
    places, members = places[several], members[several]
    _, places = np.unique(places, return_inverse=True)
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(places, kind="stable")
    places, members = places[order], members[order]
    count = places[-1] + 1 if len(places) else 0
    for start in range(0, count, _COLUMNS_AT_ONCE):
        low, high = np.searchsorted(places, [start, start + _COLUMNS_AT_ONCE])
        table = np.zeros((len(sizes), _COLUMNS_AT_ONCE), np.float32)
        table[members[low:high], places[low:high] - start] = 1
        common += table[: len(left)] @ table[len(left) :].T
    return np.rint(common).astype(np.int64)
