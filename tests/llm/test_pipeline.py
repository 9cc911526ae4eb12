"""The stages in order, and the queries against their SQL."""

import duckdb
import pytest

import corpus_pipeline
from stepweave.llm.oracles import ORACLES
from stepweave.llm.queries import QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_return_documents_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(10**6, None, None, None, None), (10**6 + 1, "12", "en", "s", 2)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == COLUMNS
        assert docs.where("doc_id >= 1000000").isEmpty()
        assert docs.where("n_chars <> char_length(text)").isEmpty()
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).where("copies < 1").isEmpty()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_empty_tables(spark, sf_dir, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert stage[1](spark, docs, sf_dir).isEmpty()


def test_near_copies_have_a_similarity_of_four_fifths(spark, sf_dir):
    def copy(group, changed):
        words = [f"g{group}w{i}" for i in range(200)]
        for i in range(changed):
            words[20 + 10 * i] = f"other{i}"
        return words

    texts = [copy(group, n) for group, changed in enumerate([3, 4, 5]) for n in (0, changed)]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert alike[0] > 0.85 > alike[1] > 0.8 > alike[2] > 0.75
    rows = [(i, " ".join(t), "en", "s", len(" ".join(t))) for i, t in enumerate(texts)]
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    left = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, schema), sf_dir)
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 4, 5]


@pytest.mark.parametrize("name", ORACLES)
def test_queries_like_their_sql(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    with duckdb.connect() as db:
        for table in ("documents", "pages", "embeddings", "benchmark"):
            db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        want = db.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(found.columns) == columns
    told = [df[columns].astype(object).where(df[columns].notna(), None) for df in (found, want)]
    rows = [sorted(map(repr, df.itertuples(index=False))) for df in told]
    assert rows[0] == rows[1]
