"""What steps leave on disk."""

import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stepweave.llm import common, context_mixing, decontamination, minhash_dedup

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.mark.parametrize("keep", [common.settled, common.stored])
def test_what_only_led_to_a_settled_table_goes(spark, keep):
    def shuffles():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    before, setting = shuffles(), spark.conf.get(SETTING)
    kept = keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 10  # files go a little later
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SETTING) == setting
    assert {tuple(r) for r in kept.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}


def _shuffles(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def _left(spark, before):
    until = time.time() + 10  # files go a little later
    while (left := _shuffles(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


@pytest.fixture
def plain_plans(spark):
    """As many tasks as there are partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    yield
    spark.conf.set(name, before)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_few_tasks_multiply_the_sample(spark, sf_dir, plain_plans):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(24)
    sample = decontamination.sampled(docs, 1)
    assert sample.rdd.getNumPartitions() <= 6
    common.release(sample)


def test_no_shuffle_of_the_spaces_is_left_when_documents_are_searched(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    before = _shuffles(spark)
    found = decontamination.contaminated(docs, benchmark)
    # That of the number of passages is a few bytes.
    assert sum(Path(x).stat().st_size for x in _left(spark, before)) < 20_000
    assert found.count()


def test_what_tells_what_comes_next_leaves_no_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null")
    keyed = docs.select(F.xxhash64("text").alias("text_key"), F.lit(True).alias("learn"), "text")
    before = _shuffles(spark)
    known = context_mixing.expected_classes(keyed.union(keyed))
    assert known.count()
    # What is told goes to its texts, and the count to one task.
    assert len({Path(x).name.split("_")[1] for x in _left(spark, before)}) <= 2


def test_near_dedup_leaves_only_which_rows_go(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    common.release(common.settled(spark.range(1)))  # there is a folder now
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def tables():
        found = spark._jvm.java.io.File(folder).listFiles()
        return {f.getName() for f in found if f.getName().startswith("rdd-")}

    before, rows = _shuffles(spark), tables()
    corpus_pipeline.near_copies(spark, docs, sf_dir).write.parquet(f"{tmp_path}/out")
    assert not _left(spark, before)
    assert len(tables() - rows) <= 1


def test_near_copies_are_found_without_steps_to_hold(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(3, words), (1, words + " more"), (2, "other words"), (None, words), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash_dedup.near_duplicates(docs)
    told = {(r.doc_id, r.component_id, r.kept) for r in found.collect()}
    assert told == {
        (1, 1, True), (3, 1, False), (2, 2, True), (4, 4, True), (None, None, True)
    }


def test_spaces_are_fitted_on_every_passage(spark):
    random = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in random.integers(0, 5000, 45)) for _ in range(3000)]
    docs = spark.createDataFrame([(x,) for x in [*texts, texts[0]]], "text string")
    weights, blocks = decontamination.term_weights(docs)
    assert blocks == 3 * 3001 > decontamination.DOCS_WEIGHT
    sample = decontamination.sampled(docs, blocks)
    words = [decontamination.words_of(text) for text in texts]
    passages = {tuple(w[at : at + 40]): 1 for w in words for at in range(0, len(w), 20)}
    passages |= {tuple(words[0][at : at + 40]): 2 for at in range(0, 45, 20)}
    rows = sample.collect()
    assert len(rows) == len({tuple(r.terms) for r in rows}) == len(passages)
    share = decontamination.DOCS_WEIGHT / blocks
    assert np.isclose(sum(r.scale**2 for r in rows), share * 9003)

    used = np.unique(decontamination._terms(words[0] + words[1]))
    found = np.zeros((len(used), len(used)))
    parts = sample.mapInArrow(
        decontamination._products(weights, [used]), "key string, data binary"
    )
    for part in common.summed_arrays(parts, "float32").collect():
        row = int(part.key.split()[1])
        data = np.frombuffer(part.data, np.float32).reshape(-1, len(used) - row)
        found[row : row + len(data), row:] += data
    want = np.zeros_like(found)
    for passage, times in passages.items():
        row = np.bincount(decontamination._terms(list(passage)), minlength=len(weights)) * weights
        row *= np.sqrt(times * share) / np.linalg.norm(row)
        want += np.outer(row[used], row[used])
    assert np.allclose(np.triu(found), np.triu(want), atol=1e-4)
    kept = common.stored(sample)
    lies = Path(kept.inputFiles()[0].removeprefix("file:"))
    assert common.is_stored(kept) and lies.exists() and not common.is_stored(sample)
    common.release(kept)
    assert not lies.exists()


def test_groups_that_are_fitted_one_at_a_time_find_the_same(spark, monkeypatch):
    random = np.random.default_rng(9)
    texts = [" ".join(f"w{x}" for x in random.integers(0, 3000, 90)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(i, " ".join(texts[i].split()[9:49])) for i in range(200)]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found():
        rows = decontamination.contaminated(docs, bench).collect()
        return sorted((r.doc_id, r.item_id, round(r.cosine, 3)) for r in rows)

    together = found()
    assert {(i, i) for i in range(200)} <= {x[:2] for x in together}
    monkeypatch.setattr(decontamination, "FIT_CELLS", 1)
    assert found() == together


def test_texts_are_taken_apart_together_like_one_by_one():
    texts = ["One, two;  three", None, "", " .. ", "Übermäßig\tlongerthaneightbytes x1\n", "two"]
    (piece, terms, lengths), = decontamination._pieces(texts)
    assert [(row, plain.split()) for row, plain in piece] == [
        (row, decontamination.words_of(texts[row])) for row in (0, 4, 5)
    ]
    assert lengths.tolist() == [3, 3, 1]
    words = [w for _, p in piece for w in p.split()]
    assert terms.tolist() == [zlib.crc32(w) % decontamination.TERMS for w in words]
    words = [b"x" * n for n in (1, 31, 32, 33, 34, 2000)]
    hashed = [zlib.crc32(w) % decontamination.TERMS for w in words]
    assert decontamination._terms(words).tolist() == hashed
    assert not len(decontamination._terms([]))
