"""Drop lines that many documents share.

Normalised lines are exploded and hashed, the documents of each hash are counted, and
documents are put together again by position from the lines that stay.  Only built-in
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import EDGES

# A line in more than one in this many lines is hot; so there are fewer of them, and
# they can be broadcast: 16 bytes each.
HOT_SHARE = 20_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(EDGES)), _UPPER, _UPPER.lower())


def _hashed(line: Column) -> Column:
    key = line_key(line)
    short = F.char_length(key)
    return F.struct(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), short.alias("size")
    )


def drop_common_lines(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    least_documents: int = 10,
    least_length: int = 1,
) -> DataFrame:
    """Per row: ``ident``, ``text`` (without the dropped lines), ``n_lines``, ``n_dropped``.

    A row is a document.  A line, split at line feeds, is dropped wherever its key has
    at least ``least_length`` code points and at least ``least_documents`` rows have
    it.  A null or empty text is one empty line and stays; a text that loses every line
    becomes empty.  Repeated rows, also whole copies, count one by one and all come
    back; null identifiers are allowed.  Other columns are ignored, whatever their names.
    """
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    whole = docs.select(docs[ident].alias("ident"), docs[text].alias("text"))
    # Rows with the same identifier and text have the same lines, so they may share a key.
    row = F.struct("ident", F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))
    keyed = whole.withColumn("row", row)
    keys = F.transform(lines, _hashed)
    long_enough = F.filter(keys, lambda key: key["size"] >= least_length)
    counts = (
        keyed.select(F.explode(F.array_distinct(long_enough)).alias("key"))
        .groupBy("key.h1", "key.h2")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    common = counts.where(F.col("n") >= least_documents)
    placed = keyed.select("row", F.posexplode(keys).alias("position", "key")).where(
        F.col("key.size") >= least_length
    )
    placed = placed.select("row", "position", "key.h1", "key.h2")
    dropped = _in_common(placed, common).groupBy("row").agg(F.collect_set("position").alias("gone"))
    told = keyed.join(dropped, "row", "left").withColumn("lines", lines)
    told = told.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.transform(stay, lambda position: F.get("lines", position))
    return told.select(
        F.col("ident").alias(ident),
        F.array_join(kept, "\n").alias(text),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
    )


def _in_common(placed: DataFrame, common: DataFrame) -> DataFrame:
    """The lines whose hash is common; the hot ones are found without a shuffle by hash."""
    hot = F.col("n") * HOT_SHARE > common.agg(F.sum("n")).scalar()
    known = common.where(hot).select("h1", "h2", F.lit(True).alias("hot"))
    marked = placed.join(F.broadcast(known), ["h1", "h2"], "left")
    # A hot line needs no partner any more: it is spread by its place.
    at = F.when(F.col("hot"), F.xxhash64("row", "position")).otherwise(F.col("h1"))
    wanted = F.when(F.col("hot"), F.lit(None)).otherwise(F.col("h2"))
    asked = marked.select("row", "position", "hot", at.alias("h1"), wanted.alias("h2"))
    rest = common.where(~hot).select("h1", "h2", F.lit(True).alias("found"))
    found = asked.join(rest, ["h1", "h2"], "left")
    return found.where(F.coalesce("hot", "found")).select("row", "position")
