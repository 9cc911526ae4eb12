"""Crafted words, large groups and repeated rows: what must hold however the rows lie."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stepweave.llm import (
    common,
    decontamination,
    embedding_dedup,
    minhash_dedup,
    mixing,
    substring_dedup,
    warc,
)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def crafted_texts():
    """Two texts of 40 words, none in common, whose hashes modulo 2^64 under one base agree."""
    one = thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    return [" ".join(f"{half}{i:02d}" for i in range(40)) for half in (one, other)]


def test_crafted_words_are_not_taken_for_equal(spark):
    texts = crafted_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = substring_dedup.remove_repeats(docs).collect()
    assert [r.n_removed for r in kept] == [0, 0]
    assert {r.component_id for r in minhash_dedup.near_duplicates(docs).collect()} == {0, 1}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 15, 35])
def test_windows_have_equal_hashes_if_their_words_are_equal(size):
    random = np.random.default_rng(2)
    kinds = [b"a", b"b", b"ab", b"12345678", b"123456789", b"1234567812345678", b"x" * 40]
    words = [kinds[i] for i in random.integers(0, 7, 3000)]
    words += [bytes(thue_morse(64)[i : i + 1], "ascii") for i in range(64)]
    hashes = [common.WindowHasher(seed).load(words) for seed in (1, 2)]
    first = np.arange(len(words) - size + 1)
    known = [h.windows(first, size) for h in hashes]
    assert not (known[0] == known[1]).any()
    windows = {}
    for i, value in enumerate(known[0].tolist()):
        assert windows.setdefault(tuple(words[i : i + size]), value) == value
    assert len(set(windows.values())) == len(windows)
    lengths = np.where(first % 2, size, max(1, size // 2))
    mixed = hashes[0].windows(first, lengths)
    assert (mixed[1::2] == known[0][1::2]).all()


@pytest.mark.parametrize("size", [8 << 20, 5_000])
def test_buckets_hold_a_bounded_part_of_the_texts(spark, monkeypatch, size):
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", size)
    random = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in random.integers(0, 5000, 300)) for _ in range(60)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(100, texts[0]), (101, f"{texts[1][:900]} z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    buckets = substring_dedup._buckets(docs)
    whole = sum(len(t) for _, t in rows)
    assert buckets == max(4, -(-whole // size))
    found = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    same = len(texts[1][:900].split()) - 1  # its last word is cut
    assert {i: n for i, n in found.items() if n} == {0: 300, 100: 300, 1: found[1], 101: found[101]}
    assert found[1] == found[101] and found[1] in (same, same + 1)


def near_copies_of_one_text(n, words=60, seed=3):
    """Each with some words of its own: like the base, less like each other."""
    random = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for number in range(n):
        own = list(base)
        for at in random.choice(words, int(random.integers(0, 4)), replace=False):
            own[at] = f"o{number}x{at}"
        rows.append((number, " ".join(own)))
    return rows


def _dealt(spark, monkeypatch, n):
    """(rows dealt to cells, components) of so many near copies."""
    dealt = []
    real = minhash_dedup._linked

    def linked(k, percent):
        inner = real(k, percent)
        seen = spark.sparkContext.accumulator(0)
        dealt.append(seen)

        def counted(cell):
            seen.add(cell.num_rows)
            return inner(cell)

        return counted

    monkeypatch.setattr(minhash_dedup, "_linked", linked)
    docs = spark.createDataFrame(near_copies_of_one_text(n), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs).collect()}
    return dealt[0].value, found


def test_rows_dealt_to_cells_grow_with_a_group(spark, monkeypatch):
    few, _ = _dealt(spark, monkeypatch, 400)
    many, _ = _dealt(spark, monkeypatch, 1600)
    assert many <= 6 * max(few, 400)


@pytest.mark.parametrize("cell", [1 << 23, 40_000, 5_000])
def test_a_group_of_near_copies_like_brute_force(spark, monkeypatch, cell):
    """Also where one cell does not hold a list, and where its smaller part does not fit."""
    monkeypatch.setattr(minhash_dedup, "CELL_BYTES", cell)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rows = near_copies_of_one_text(70, seed=5) + [
        (100 + i, t.replace("b5 ", "c5 ")) for i, t in near_copies_of_one_text(40, seed=6)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs).collect()}
    sets = {}
    for ident, text in rows:
        words = text.split()
        sets[ident] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    least = dict(zip(sets, sets, strict=True))
    links = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert found == least


def test_a_source_of_repeated_rows_comes_near_its_target(spark):
    """One identifier, or none and one text, on all rows of a source."""
    for ident in (7, None):
        rows = [(i + 1000, "w " * 10 + str(i), "A") for i in range(200)]
        rows += [(ident, "x " * 9 + "y", "B")] * 200
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        docs = docs.withColumns({"cut_whole": F.lit(1), "__draw": F.lit("z"), "doc": F.lit(2), "row": F.lit(3)})
        mixed = mixing.mix_sources(docs.repartition(5))
        assert mixed.columns[: len(docs.columns)] == docs.columns
        told = mixed.groupBy("source").agg(
            F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken"),
            F.first("mix_target").alias("target"),
            F.count("*").alias("n"),
        )
        for r in told.collect():
            assert r.n == 200 and abs(r.taken - r.target) <= 11, r
        again = mixing.mix_sources(docs.repartition(3))
        columns = ["doc_id", "source", "mix_size", "mix_copies"]
        counts = [sorted(map(repr, m.select(columns).collect())) for m in (mixed, again)]
        assert counts[0] == counts[1]


def test_repeated_identifiers_with_other_texts_are_drawn_apart(spark):
    rows = [(i % 3, "w " * (1 + i % 7) + f"t{i}", f"s{i % 2}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in mixing.mix_sources(docs).groupBy("source").agg(
        F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken"), F.first("mix_target").alias("target")
    ).collect():
        assert abs(r.taken - r.target) <= 8


# --- the pipeline ----------------------------------------------------------------------

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, doc string"


def _documents(spark, rows):
    full = [(i, t, "en", "s", len(t) if t is not None else None, "x", "y") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def _words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_one_row_of_each_group_of_copies_stays(spark, sf_dir):
    near = _words("a").replace("a30 ", "z ")
    rows = [(5, _words("a")), (3, near), (3, near), (None, near), (None, _words("b")), (None, _words("b"))]
    rows += [(9, _words("c")), (9, _words("d")), (9, _words("d")), (10, None), (10, None), (11, ""), (11, "")]
    docs = _documents(spark, rows).repartition(3)
    left = corpus_pipeline.near_copies(spark, docs, sf_dir)
    assert left.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    want = [(3, near), (None, _words("b")), (9, _words("c")), (9, _words("d"))]
    assert found == sorted([*want, (10, None), (10, None), (11, ""), (11, "")], key=repr)


def test_rows_with_a_benchmark_item_go_and_others_stay(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 200").first().text
    rows = [(None, item), (4, f"{_words('u')} {item} {_words('v')}"), (4, _words("k")), (None, _words("m"))]
    rows += [(None, None), (6, "")]
    left = corpus_pipeline.benchmark_leaks(spark, _documents(spark, rows), sf_dir)
    found = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    want = [(4, _words("k")), (None, _words("m")), (None, None), (6, "")]
    assert found == sorted(want, key=repr)


def test_columns_with_the_names_of_steps_do_not_clash(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    names = ["lang_pred", "lang_score", "mix_size", "copies", "row", "doc", "rest", "n_dropped", "node", "kept"]
    docs = docs.withColumns({name: F.lit("x") for name in names})
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert set(names) <= set(docs.columns) and docs.where("row <> 'x'").isEmpty()
    assert docs.where("copies < 1").isEmpty()


def test_the_language_of_a_text_is_found_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = corpus_pipeline.language(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


# --- verbatim copies of benchmark items ------------------------------------------------


@pytest.mark.parametrize("count", [50, 500])
def test_every_verbatim_copy_is_found(spark, count):
    """Items of 5 to 45 frequent words, copied whole into texts of rare words."""
    random = np.random.default_rng(12)
    frequent = [f"f{i}" for i in range(30)]
    items = [
        (n, " ".join(random.choice(frequent, int(random.integers(5, 46))))) for n in range(count)
    ]
    rows = []
    for n, (_, text) in enumerate(items):
        rare = [f"r{n}x{i}" for i in range(80)]
        at = int(random.integers(0, 80))
        rows.append((n, " ".join([*rare[:at], text.upper().replace(" ", ", "), *rare[at:]])))
    rows += [(count + n, " ".join(random.choice(frequent, 200))) for n in range(300)]  # frequent words
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert {(n, n) for n in range(count)} <= found


def test_long_items_are_compared_in_blocks(monkeypatch):
    random = np.random.default_rng(13)
    for size in (1, 7, 63, 64, 65, 200):
        item = [b"w%d" % x for x in random.integers(0, 30, size)]
        text = [b"w%d" % x for x in random.integers(0, 40, 150)]
        table = np.zeros((len(item) + 1, len(text) + 1), int)
        for i, a in enumerate(item):
            for j, b in enumerate(text):
                same = table[i][j] + 1 if a == b else 0
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], same)
        for block in (1, 8, 64, 4096):
            monkeypatch.setattr(decontamination, "LCS_WORDS", block)
            assert decontamination.common_words(item, text) == table[-1][-1], (size, block)


# --- archives --------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast,share", [(250_000, 20_000), (0, 20_000), (0, 2)])
def test_pages_of_one_payload_fill_many_packages(spark, tmp_path, monkeypatch, broadcast, share):
    """A third of all pages are one payload; revisits count although they have no body."""
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(warc, "HOT_SHARE", share)
    rows = [(n, "u", "hot" if n % 3 == 0 else f"p{n % 50}" if n % 3 == 1 else f"own{n}") for n in range(300)]
    rows += [(None, "u", "hot"), (None, "u", "lonely"), (400, None, None), (401, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/archives"
    packages = warc.write_archives(pages.coalesce(1), folder, package_bytes=20_000)
    told = packages.collect()
    assert max(r.records for r in told) <= 20_000 // warc.RECORD_BYTES + 1
    found = {(r.ident, r.payload is not None and bytes(r.payload)): (r.kind, r.refers_to)
             for r in warc.read_archives(packages, folder).collect()}
    last = {}
    for ident, _, text in rows:
        if ident is not None:
            last[text or ""] = max(ident, last.get(text or "", -1))
    kinds = {}
    for (ident, _), kind in found.items():
        kinds.setdefault(ident, []).append(kind)
    for ident, _, text in rows:
        response = last.get(text or "")
        if ident is None:
            continue
        want = ("response", None) if ident == response else ("revisit", str(response))
        assert kinds[str(ident)] == [want]
    assert sorted(kinds[""], key=repr) == [("response", None), ("revisit", str(last["hot"]))]


# --- vectors ---------------------------------------------------------------------------


@pytest.mark.parametrize("batch", [2, 3, 10_000])
def test_cells_go_on_over_batches(spark, monkeypatch, batch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 5)
    random = np.random.default_rng(7)
    centres = random.normal(size=(12, 8))
    rows = [(n, (centres[n % 12] + random.normal(0, 0.02, 8)).tolist()) for n in range(70)]
    rows += [(100 + n, [1.0, 0.01 * n, 0.0]) for n in range(14)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
        found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.linked_vectors(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in (8, 3):
        own = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if len(v) == size]
        links = {i: [j for j, b in own if i != j and a @ b >= 0.95] for i, a in own}
        assert sum(found[i][0] for i, _ in own) >= 0.9 * sum(map(len, links.values()))
        assert all(found[i][0] <= len(links[i]) for i, _ in own)
        assert all(found[i][1] in {i, *links[i]} or found[i][1] < i for i, _ in own)
