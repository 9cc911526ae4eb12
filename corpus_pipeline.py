"""From documents to a training mix, in stages that each use one operator.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``.  The last adds how often the mix takes each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.llm import decontamination, language_id, line_dedup, minhash_dedup, mixing
from stepweave.llm.common import Steps, numbered, settled, without
from stepweave.session import quoted, scratch_path, ship_package

#: A document whose best language has less than this share of its letters is rejected.
LEAST_LANGUAGE = 0.25
#: Documents of at least this similarity are near copies here.
NEAR_PERCENT = 80


def _whole(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name can clash."""
    return F.struct(*(docs[quoted(c)] for c in docs.columns)).alias("doc")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Label every document with its language; those without a clear one go.

    Learned from the labels that the documents have.  A null text and a text without
    letters are undetermined and rejected.  Every row is judged for itself, whatever its
    identifier.
    """
    model = language_id.train(docs)
    labelled = language_id.label_languages(docs.select(_whole(docs), docs["text"]), model)
    clear = (F.col("lang_pred") != language_id.UNDETERMINED) & (
        F.col("lang_score") >= LEAST_LANGUAGE
    )
    kept = labelled.where(clear)
    values = {"lang": F.col("lang_pred")}
    return kept.select(*(values.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that ten or more documents have; a document that loses all goes.

    Rows that are alike in all other columns count as one document; a null text is an
    empty one and stays.
    """
    rest = F.struct(*(docs[quoted(c)] for c in docs.columns if c != "text")).alias("rest")
    kept = line_dedup.drop_common_lines(docs.select(rest, docs["text"]), ident="rest")
    left = kept.where((F.col("text") != "") | (F.col("n_dropped") == 0))
    values = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return left.select(*(values.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the one with the least identifier.

    Copies have at least ``NEAR_PERCENT`` of their windows of five words in common.  Rows
    are told apart by themselves: of rows that share an identifier or have none, and whose
    texts are copies, one stays too (null identifiers come last); others all stay.  Rows
    without words are nobody's copies.
    """
    rows = numbered(docs)
    texts = rows.select("row", F.col("doc.text").alias("text"))
    steps = Steps()
    found = minhash_dedup.near_duplicates(texts, ident="row", percent=NEAR_PERCENT, held=steps)
    named = found.join(rows.select("row", F.col("doc.doc_id").alias("doc_id")), "row")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    told = settled(named.select("row", "component_id", place.alias("place")))
    steps.release()
    steps.hold(told)
    first = told.groupBy("component_id").agg(F.min("place").alias("first"))
    gone = told.join(first, "component_id").where("place <> first").select("row")
    gone = settled(gone)
    steps.release()
    return without(rows, gone, docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that have a benchmark item in them go, whatever their identifiers; a clean row
    stays, also if it shares its identifier with one that goes."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered(docs)
    texts = rows.select("row", F.col("doc.text").alias("text"))
    found = decontamination.contaminated(texts, benchmark, ident="row")
    return without(rows, settled(found.select("row").distinct()), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, and ``copies``, how often it takes each row.

    A column of that name in the input is replaced.
    """
    rows = docs.select(_whole(docs), docs["doc_id"], docs["text"], docs["source"])
    mixed = mixing.mix_sources(rows).where("mix_copies > 0")
    columns = [c for c in docs.columns if c.lower() != "copies"]
    return mixed.select(
        *(F.col("doc")[c].alias(c) for c in columns), F.col("mix_copies").alias("copies")
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", common_lines),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("mixing", mix),
]

#: SQL can express neither the language model nor the latent space.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is a table in the shared folder."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
