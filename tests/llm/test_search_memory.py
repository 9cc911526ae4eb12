"""What a task holds while it builds the search index, and while it searches."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from stepweave.llm import common, lexical_search


def test_a_block_of_the_index_needs_bounded_memory():
    random = np.random.default_rng(6)
    words = [f"w{x}" for x in range(60_000)]
    texts = [" ".join(words[x] for x in random.zipf(1.2, 600) % 60_000) for _ in range(5000)]
    batch = pa.RecordBatch.from_pydict({"ident": list(range(5000)), "text": texts})
    tracemalloc.start()
    found = [len(b["idents"][0]) for b in lexical_search._index(5000, 3_000_000)([batch])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found) == 5000
    assert peak < 80e6


def test_a_task_gets_few_blocks_of_the_index_at_once(spark, monkeypatch):
    rows = [(n, f"a{n % 7} b{n % 11} c{n}") for n in range(4 * lexical_search.BLOCK_DOCS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setitem(lexical_search._FILES, "parquet.block.size", 1 << 10)
    index = lexical_search.build_index(docs)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.blocks.inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) == 4 and max(groups) <= 2

    def one_each(make):
        def made(*given):
            work = make(*given)

            def checked(batches):
                for batch in batches:
                    assert len(batch) <= 1, "several blocks at once"
                    yield batch

            return lambda batches: work(checked(batches))

        return made

    for name in ("_search", "_frequencies"):
        monkeypatch.setattr(lexical_search, name, one_each(getattr(lexical_search, name)))
    before = spark.conf.get(common.BATCH_ROWS)
    index = lexical_search.Index(index.blocks.coalesce(1), index.docs, index.terms)
    items = spark.createDataFrame([(1, "c5 c16000")], "item_id long, text string")
    found = lexical_search.search(index, items).select("doc_id").collect()
    assert {r.doc_id for r in found} == {5, 16000}
    assert spark.conf.get(common.BATCH_ROWS) == before
