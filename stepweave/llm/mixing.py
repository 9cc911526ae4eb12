"""Mix sources to target weights by Pareto order sampling.

A source's target over its size is how often each of its documents is expected in the
mix.  The whole part of that number is taken as certain copies.  For the fraction, each
document draws a random number; its odds over the odds of the fraction rank the
source's documents, and the first ones are taken as long as they fit into the words that
are missing; the largest other document that fits fills the gap.  Only built-in functions
are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.llm.common import EDGES, SPACES, numbered, release, settled
from stepweave.session import literal, quoted

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is used at most so many times over.
MOST_COPIES = 3
#: A source's ranks are cut into so many ranges; only one range is ever sorted.
RANGES = 4096
# Sources are broadcast up to this many rows; beyond it they are joined.
BROADCAST_SOURCES = 100_000
_HEX_DIGITS = 13
# Between a name and the number of a row that repeats it.
_NUMBER = "\x1f"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    inner = F.btrim(text, F.lit(EDGES))
    words = F.size(F.split(inner, SPACES + "+"))
    return F.when(F.length(inner) > 0, words).otherwise(0)


def draw(seed: str, name: Column) -> Column:
    """A number between 0 and 1 that depends on the seed and the name only."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), name).cast("binary")), 1, _HEX_DIGITS)
    number = F.conv(digits, 16, 10).cast("long")
    return (number.cast("double") + 0.5) / float(16**_HEX_DIGITS)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Shares of all sizes by weight; what a source cannot take, being above ``most`` times
    its size, is shared by weight among the others.  All end at one level, the target
    per weight, that those who are not full reach: sources are filled in the order of
    the level at which they are full.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    sources = sources.withColumn("weight", F.get(cycle, place))
    sources = sources.withColumn("most", (F.col("source_size") * most).cast("double"))
    fills = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    onward = fills.rowsBetween(0, Window.unboundedFollowing)
    everything = fills.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(onward)
    sources = sources.withColumn("level", level)
    full = F.col("level") * F.col("weight") > F.col("most")
    # From the first source on that is not full none is, and later levels are not higher.
    common = F.max(F.when(~full, F.col("level"))).over(everything)
    target = F.least("most", F.col("weight") * common)
    return sources.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    seed: str = "mix",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies``.

    A document's size is its words (null: 0); ``mix_copies`` says how many times the mix
    takes it, from 0 to ``most``.  Per source, the words taken stay below the target by
    less than any document that is not taken once more.  The draw depends on the seed and
    the identifier (or the text, if that is null), so reruns agree.  Rows that share an
    identifier are numbered in the order of size and text, and each has a draw of its own.
    A null source is a source, the last one.  A source without words has the target 0 and
    nothing is taken.  The input's columns are kept, whatever their names; the new ones
    must not be among them.
    """
    new = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    if clash := {c.lower() for c in docs.columns} & set(new):
        raise ValueError(f"columns of the mix already exist: {sorted(clash)}")
    columns = F.struct(*(docs[quoted(c)] for c in docs.columns))
    rows = _measured(docs.select(columns.alias("doc")), ident, text, source)
    names = rows.groupBy("source", "name").agg(F.count(F.lit(1)).alias("n"))
    repeated = settled(names.where("n > 1").select("source", "name"))
    if not repeated.isEmpty():
        rows = _told_apart(_measured(numbered(docs), ident, text, source), repeated)
    rows = rows.withColumn("draw", draw(seed, F.col("name")))
    sizes = settled(rows.select("source", "size", "draw", "name"))
    cuts = settled(_cuts(sizes, source_targets(sizes, weights, most)))
    release(sizes)
    few = cuts.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    told = rows.join(
        F.broadcast(cuts) if few else cuts, F.col("source").eqNullSafe(F.col("cut_source"))
    )
    place = F.struct(
        _rank(F.col("draw"), F.col("cut_fraction")).alias("rank"), F.col("name"), F.col("size")
    )
    more = (place <= F.col("cut_last")) | place.eqNullSafe(F.col("cut_extra"))
    more = F.coalesce(more, F.lit(False)).cast("int")
    return told.select(
        *(F.col("doc")[c].alias(c) for c in docs.columns),
        F.col("size").alias("mix_size"),
        F.col("cut_source_size").alias("mix_source_size"),
        F.col("cut_target").alias("mix_target"),
        (F.col("cut_whole") + more).cast("int").alias("mix_copies"),
    )


def _measured(rows: DataFrame, ident: str, text: str, source: str) -> DataFrame:
    """``rows`` of documents as structs, with their source, size, name and text's digest."""
    doc = F.col("doc")
    digest = F.md5(doc[text].cast("binary"))
    return rows.select(
        "*",
        doc[source].alias("source"),
        word_count(doc[text]).cast("long").alias("size"),
        F.coalesce(doc[ident].cast("string"), digest, F.lit("")).alias("name"),
        digest.alias("digest"),
    )


def _told_apart(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Numbered rows whose name comes twice in a source get names of their own.

    They are sorted over all tasks and counted by task, so that no task gets all rows of
    a name, however many they are.
    """
    of = [F.col("source").eqNullSafe(F.col("of_source")), F.col("name") == F.col("of_name")]
    wanted = repeated.toDF("of_source", "of_name")
    few = wanted.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    keys = ["source", "name", "size", "digest", "row"]
    some = rows.join(F.broadcast(wanted) if few else wanted, of, "left_semi").select(keys)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = settled(
        some.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id())
    )
    counts = some.groupBy("source", "name", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source", "name").orderBy("part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("source").alias("of_source"),
        F.col("name").alias("of_name"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    within = Window.partitionBy("part", "source", "name").orderBy("size", "digest", "row")
    numbers = some.withColumn("number", F.row_number().over(within) - 1).join(
        offsets, [*of, F.col("part") == F.col("of_part")]
    )
    numbers = settled(
        numbers.select(F.col("row").alias("of_row"), (F.col("number") + F.col("before")).alias("number"))
    )
    few = numbers.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    told = rows.join(
        F.broadcast(numbers) if few else numbers, F.col("row") == F.col("of_row"), "left"
    )
    own = F.concat("name", F.lit(_NUMBER), F.col("number").cast("string"))
    return told.withColumn("name", F.when(F.col("number") > 0, own).otherwise(F.col("name")))


def _rank(drawn: Column, fraction: Column) -> Column:
    """The random odds over the odds of the fraction; null where the fraction is 0."""
    return F.try_divide(drawn / (1 - drawn), fraction / (1 - fraction))


def _cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source its whole copies, its fraction and the last rank that is taken."""
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.withColumn("whole", F.floor(copies)).withColumn(
        "fraction", copies - F.floor(copies)
    )
    plan = settled(
        plan.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    ).withColumnRenamed("source", "of")
    few = plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    ranked = sizes.join(
        F.broadcast(plan.where("fraction > 0")) if few else plan.where("fraction > 0"),
        F.col("source").eqNullSafe(F.col("of")),
    ).withColumn("rank", _rank(F.col("draw"), F.col("fraction")))
    # rank / (1 + rank) is between 0 and 1 and rises with the rank.
    ranked = ranked.withColumn(
        "range", F.floor(F.col("rank") / (1 + F.col("rank")) * RANGES).cast("int")
    )
    # First whole ranges are taken, then the one that holds the cut is sorted.
    ranges = ranked.groupBy("of", "range", "missing").agg(F.sum("size").alias("range_size"))
    in_order = Window.partitionBy("of").orderBy("range")
    before = F.coalesce(
        F.sum("range_size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    ranges = ranges.withColumn("before", before)
    cut = (
        ranges.where(F.col("before") < F.col("missing"))
        .groupBy("of")
        .agg(F.max(F.struct("range", "before")).alias("at"))
        .select(F.col("of").alias("cut_of"), "at.range", "at.before")
    )
    near = ranked.join(
        F.broadcast(cut) if few else cut,
        F.col("of").eqNullSafe(F.col("cut_of")) & (ranked["range"] == cut["range"]),
    )
    place = F.struct("rank", "name", "size")
    so_far = Window.partitionBy("of").orderBy("rank", "name", "size")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, 0)
    last = (
        near.withColumn("taken", F.sum("size").over(so_far) + F.col("before"))
        .where("taken <= missing")
        .groupBy(F.col("of").alias("last_of"))
        .agg(F.max(F.struct(F.col("taken"), place.alias("place"))).alias("last"))
    )
    # Nothing of that range may fit; then the ranges before it are taken.
    edge = F.struct(
        (F.col("range") / (RANGES - F.col("range"))).alias("rank"),
        F.lit("").alias("name"),
        F.lit(-1).cast("long").alias("size"),
    )
    at_cut = cut.join(last, F.col("cut_of").eqNullSafe(F.col("last_of")), "left").select(
        "cut_of",
        F.coalesce("last.place", edge).alias("cut_last"),
        F.coalesce("last.taken", "before").alias("cut_taken"),
    )
    whole = settled(plan.join(at_cut, F.col("of").eqNullSafe(F.col("cut_of")), "left"))
    gaps = whole.where("cut_last is not null").select(
        F.col("of").alias("gap_of"), "cut_last", (F.col("missing") - F.col("cut_taken")).alias("gap")
    )
    extra = (
        ranked.join(
            F.broadcast(gaps) if few else gaps, F.col("of").eqNullSafe(F.col("gap_of"))
        )
        .where((place > F.col("cut_last")) & (F.col("size") <= F.col("gap")) & (F.col("size") > 0))
        .groupBy(F.col("of").alias("extra_of"))
        .agg(F.max_by(place, F.struct("size", -F.col("rank"), "name")).alias("cut_extra"))
    )
    whole = whole.join(extra, F.col("of").eqNullSafe(F.col("extra_of")), "left")
    return whole.select(
        F.col("of").alias("cut_source"),
        F.col("source_size").alias("cut_source_size"),
        F.col("target").alias("cut_target"),
        F.col("whole").alias("cut_whole"),
        F.col("fraction").alias("cut_fraction"),
        "cut_last",
        "cut_extra",
    )


def mix_parameters_sql(seed: str) -> str:
    """The draw of :func:`draw` as DuckDB SQL over ``name``."""
    return (
        f"((('0x' || substr(md5({literal(seed + ':')} || name), 1, {_HEX_DIGITS}))::BIGINT) + 0.5)"
        f" / {16**_HEX_DIGITS}.0"
    )
