"""A query for each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.llm import (
    context_mixing,
    decontamination,
    embedding_dedup,
    html_text,
    language_id,
    lexical_search,
    line_dedup,
    minhash_dedup,
    mixing,
    quality,
    substring_dedup,
    vector_codes,
    warc,
)
from stepweave.llm.common import fold
from stepweave.session import ship_package

#: Parts of the documents that are held out, by identifier.
LANGUAGE_FOLDS = 5
SCORE_FOLDS = 10
QUALITY_FOLDS, QUALITY_HELD_OUT = 3, 1


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _digest(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256).alias("kept_sha256")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_main_text(_read(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows."""
    kept = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", _digest("text"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: a row for each pair."""
    docs = _read(spark, sf_dir, "documents")
    return decontamination.contaminated(docs, _read(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four of five."""
    docs = _read(spark, sf_dir, "documents")
    held_out = fold("doc_id", LANGUAGE_FOLDS) == 0
    model = language_id.train(docs, learn=~held_out)
    labelled = language_id.label_languages(docs.select("doc_id", "text"), model)
    return labelled.select(
        "doc_id",
        held_out.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.size("lang_spans").alias("n_spans"),
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return embedding_dedup.linked_vectors(_read(spark, sf_dir, "embeddings"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return minhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixing.mix_sources(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, archived and read back."""
    folder = warc.archive_folder(spark)
    pages = _read(spark, sf_dir, "pages")
    packages = warc.write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(packages, folder).select(
        F.expr("nullif(ident, '')").cast(kind).alias("page_id"),
        F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines of ten or more documents."""
    kept = line_dedup.drop_common_lines(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", _digest("text"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, learned from nine of ten."""
    docs = _read(spark, sf_dir, "documents")
    return context_mixing.score_texts(docs, learn=fold("doc_id", SCORE_FOLDS) != 0)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    index = lexical_search.build_index(_read(spark, sf_dir, "documents"))
    return lexical_search.search(index, _read(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors."""
    coded, books = vector_codes.compress_vectors(_read(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two of three."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    # A null identifier is in no fold.
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % QUALITY_FOLDS
    held_out = F.coalesce(part == QUALITY_HELD_OUT, F.lit(False))
    labels = _read(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~held_out), learn=~held_out)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the stages of the corpus pipeline keep."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_html_extraction,
        op2_substring_dedup,
        op3_decontamination,
        op4_language_id,
        op5_embedding_dedup,
        op6_minhash_dedup,
        op7_mixing,
        op8_warc,
        op9_line_dedup,
        op10_lm_scoring,
        op11_lexical_search,
        op12_vector_codes,
        op13_quality_classifier,
        pipeline,
    )
}
