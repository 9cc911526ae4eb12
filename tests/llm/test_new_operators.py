"""Lexical search, vector codes and the quality classifier against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stepweave.llm import lexical_search, quality, vector_codes
from stepweave.llm.queries import QUERIES

ODD = "doc_id long, text string, item_id string, rank string, score string, ident string, number long"


def documents(spark, rows):
    """Documents with extra columns whose names clash with those of results and steps."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", 1) for r in rows], ODD)


# --- lexical search --------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, best=10):
    """Scores of all documents for all items, from the definition."""
    terms = [(ident, Counter(plain_terms(text))) for ident, text in docs]
    terms = [(ident, counts) for ident, counts in terms if counts]
    n, total = len(terms), sum(c.total() for _, c in terms)
    df = Counter(term for _, counts in terms for term in counts)
    found = []
    for item, text in items:
        hits = []
        for ident, counts in terms:
            m = 10 + (90 * counts.total() * n) // total
            score = 0
            for term in set(plain_terms(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                score += w * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                hits.append((-score, ident is None, ident or 0, ident))
        for rank, (score, _, _, ident) in enumerate(sorted(hits, key=lambda h: h[:3])[:best], 1):
            found.append((item, rank, ident, -score))
    return sorted(found, key=repr)


def random_text(random, words=400, most=60):
    return " ".join(f"W{int(x)}" for x in random.zipf(1.3, random.integers(0, most)) % words)


@pytest.mark.parametrize("block", [4096, 5])
@pytest.mark.parametrize("step", [1 << 14, 8])
def test_search_like_scoring_every_document(spark, monkeypatch, block, step):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "STEP_CELLS", step)
    random = np.random.default_rng(3)
    docs = [(n, random_text(random)) for n in range(90)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (200, None), (201, ""), (202, " -- "), (203, docs[9][1])]
    docs += [(204, "Été ÉTÉ été-x1 y_z \u0085 a b"), (205, "w1 " * 5000 + "zz")]
    items = [(n, random_text(random, most=30)) for n in range(12)]
    items += [(20, None), (21, ""), (22, "nowhere"), (23, items[3][1]), (None, items[4][1])]
    items += [(24, docs[5][1]), (25, "été x1 Z zz"), (26, " ".join(t for _, t in docs[:40]))]
    table = documents(spark, docs).repartition(3)
    bench = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id int")
    index = lexical_search.build_index(table)
    got = lexical_search.search(index, bench)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["score"] == "bigint"
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == plain_search([(r.doc_id, r.text) for r in table.collect()], items)


def test_search_in_rounds_and_again_in_one_index(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "TERMS_AT_ONCE", 20)
    random = np.random.default_rng(4)
    docs = [(n, random_text(random)) for n in range(50)]
    items = [(n, random_text(random, most=12)) for n in range(15)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = lexical_search.build_index(documents(spark, docs))
    for best in (10, 3):
        rows = lexical_search.search(index, bench, best=best).collect()
        assert sorted(map(tuple, rows), key=repr) == plain_search(docs, items, best)


def test_search_of_empty_tables(spark):
    docs = documents(spark, [(1, "a b")])
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    nothing = lexical_search.build_index(docs.limit(0))
    assert lexical_search.search(nothing, bench).isEmpty()
    assert lexical_search.search(lexical_search.build_index(docs), bench.limit(0)).isEmpty()
    # A term of all documents weighs nothing here: ln(4 / 3) is above 0, so it does not.
    assert lexical_search.search(lexical_search.build_index(docs), bench).count() == 1


def test_a_treap_gives_its_cells_back():
    random = np.random.default_rng(5)
    for shape in ((1, 1), (1, 9), (9, 1), (40, 5), (5, 40), (64, 64), (33, 31)):
        cells = np.unique(random.integers(0, shape, (60, 2)), axis=0)
        values = random.integers(1, 1000, len(cells))
        treap = lexical_search.build_treap(cells[:, 0], cells[:, 1], values, shape)
        descent = lexical_search.Descent(treap)
        by_row = defaultdict(dict)
        for (row, column), value in zip(cells.tolist(), values.tolist(), strict=True):
            by_row[row][column] = value
        rows = np.array(sorted(by_row))
        assert descent.filled(rows).tolist() == [len(by_row[r]) for r in rows.tolist()]
        for row, columns in by_row.items():
            found = descent.search(np.array([row]), np.array([2]), 1, 10**6, shape[1])
            assert sorted(found) == sorted((2 * v, c) for c, v in columns.items())
        # Largest impacts of parents are those of their children.
        for level in descent.largest[:-1]:
            assert level[:-1].max() == values.max()


def test_best_first_leaves_most_documents_alone():
    """One document has the item's rare terms: its range is found without the others."""
    docs, terms = 4096, 20
    rows, columns = np.divmod(np.arange(docs * terms), docs)
    impacts = np.where(columns == 1234, 900_000, 1000 + (rows * 7 + columns) % 50)
    treap = lexical_search.build_treap(rows, columns, impacts, (terms, docs))
    descent = lexical_search.Descent(treap)
    opened = []
    real = descent.child

    def child(level, nodes, digit):
        opened.append(nodes.size)
        return real(level, nodes, digit)

    descent.child = child
    found = descent.search(np.arange(terms), np.full(terms, 10), 1, 1, docs)
    assert found == [(terms * 9_000_000, 1234)]
    assert sum(opened) < docs * terms / 10


# --- vector codes ----------------------------------------------------------------------


def plain_codes(rows, rounds=2):
    """(codes, errors, codebooks) from the definition, each part against each entry."""
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows], np.int64)
    parts = np.split(vectors, 16, axis=1)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    books = [part[order[:64]] for part in parts]

    def nearest(part, book):
        squares = ((part[:, None] - book[None]) ** 2).sum(-1)
        return squares.argmin(1), squares.min(1)

    for _ in range(rounds):
        for p, part in enumerate(parts):
            own = nearest(part, books[p])[0]
            books[p] = np.array(
                [part[own == e].sum(0) // (own == e).sum() if (own == e).any() else entry
                 for e, entry in enumerate(books[p])]
            )
    found = [nearest(part, book) for part, book in zip(parts, books, strict=True)]
    codes = ["".join(f"{own[i]:02x}" for own, _ in found) for i in range(len(rows))]
    return codes, sum(error for _, error in found).tolist(), books


@pytest.mark.parametrize("values", [1 << 18, 16 * 20])
def test_codes_like_comparing_every_part_with_every_entry(spark, monkeypatch, values):
    monkeypatch.setattr(vector_codes, "BLOCK_VALUES", values)
    random = np.random.default_rng(6)
    centres = random.normal(size=(12, 32))
    rows = [
        (n, [float(np.float32(x)) for x in centres[n % 12] + random.normal(0, 0.02 * (n % 5), 32)],
         ["a", None, "b"][n % 3])
        for n in range(400)
    ]
    rows += [(500 + n, rows[0][1], "a") for n in range(60)] + [(3, rows[9][1], None), (None, rows[5][1], "b")]
    odd = [None, [1.0, None] + [0.0] * 30, [math.nan] * 32, [0.0] * 31 + [math.inf]]
    schema = "vec_id long, embedding array<float>, label string, code string, n int"
    table = spark.createDataFrame(
        [(*r, "x", 1) for r in [*rows, *((900 + i, v, "c") for i, v in enumerate(odd))]], schema
    )
    got, books = vector_codes.compress_vectors(table.repartition(4))
    codes, errors, want = plain_codes(rows)
    assert all((a == b).all() for a, b in zip(books, want, strict=True))
    by_label = Counter()
    for (_, _, label), error in zip(rows, errors, strict=True):
        by_label[label] += error
    expected = [
        (ident, label, code, error, by_label[label])
        for (ident, _, label), code, error in zip(rows, codes, errors, strict=True)
    ]
    columns = ["vec_id", "label", "code", "error", "label_error"]
    assert got.columns == columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected))
    flat = ",".join(str(x) for book in want for x in book.ravel().tolist())
    assert vector_codes.codebooks_digest(books) == hashlib.sha256(flat.encode()).hexdigest()


def test_few_short_and_no_vectors(spark, monkeypatch):
    schema = "vec_id long, embedding array<double>, label int"
    few = [(1, [0.5] * 16, 1), (2, [-0.001] * 16, 2), (3, [0.5] * 4, 1), (4, [], None)]
    padded = [(i, v + [0.0] * (16 - len(v)), l) for i, v, l in few]
    got, books = vector_codes.compress_vectors(spark.createDataFrame(few, schema))
    codes, errors, _ = plain_codes(padded)
    assert [(r.code, r.error) for r in got.orderBy("vec_id").collect()] == list(zip(codes, errors, strict=True))
    assert len(books) == 16 and len(books[0]) == 4
    got, books = vector_codes.compress_vectors(spark.createDataFrame([], schema))
    assert got.isEmpty() and books == []
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress_vectors(spark.createDataFrame([(1, [1e30] * 16, 1)], schema))
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(vector_codes, "HOT_SHARE", 2)
    rows = [(n, [float(n)] * 16, n // 5 if n < 20 else None) for n in range(60)]
    got, _ = vector_codes.compress_vectors(spark.createDataFrame(rows, schema))
    sums = Counter()
    for r in got.collect():
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in got.collect()) and got.count() == 60


@pytest.mark.parametrize("width", [1, 4])
def test_trees_own_what_their_balls_own(width):
    random = np.random.default_rng(7)
    kinds = [
        random.integers(-50, 50, (700, width)),
        np.repeat(random.integers(-50, 50, (6, width)), 100, axis=0),
        (2.0 ** random.integers(0, 25, (300, width))).astype(np.int64),
        np.zeros((300, width), np.int64),
    ]
    entries = np.concatenate([random.integers(-50, 50, (60, width)), np.zeros((4, width), np.int64)])
    for points in kinds:
        tree = vector_codes.build_tree(points)
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        for ball, (start, stop) in enumerate(tree.spans):
            own = tree.points[start:stop]
            assert (tree.sums[ball] == own.sum(0)).all()
            away = np.sqrt(((own - tree.pivots[ball]) ** 2).sum(1))
            assert away.max() <= tree.radii[ball] * (1 + 1e-9)
        squares = ((points[:, None] - entries[None]) ** 2).sum(-1)
        found, least = vector_codes.assigned(tree, entries)
        assert (found == squares.argmin(1)).all() and (least == squares.min(1)).all()
        sums = vector_codes.entry_sums(tree, entries)
        for entry in range(len(entries)):
            own = points[found == entry]
            assert (sums[entry, :-1] == own.sum(0)).all() and sums[entry, -1] == len(own)


def test_balls_are_owned_without_a_look_at_their_points():
    random = np.random.default_rng(8)
    points = np.concatenate([random.integers(-9, 9, (500, 4)) + 1000 * i for i in range(8)])
    tree = vector_codes.build_tree(points)
    entries = np.array([[1000 * i] * 4 for i in range(8)])
    owned = list(vector_codes.owners(tree, entries))
    assert all(mixed is None for _, _, mixed in owned) and len(owned) < 40


# --- quality ---------------------------------------------------------------------------


def plain_moments(texts, positive):
    found = quality.text_features([t.encode() if t is not None else None for t in texts]) / quality.STEPS
    good = found[np.array(positive, bool)]
    return good.T @ good / len(good), found.T @ found / len(found)


def test_the_risk_is_minimised():
    """No other weights near the solution, and none of a plain descent, have less risk."""
    random = np.random.default_rng(9)
    labels = random.random(400) < 0.6
    x = np.hstack([random.normal(np.where(labels, 1.0, -1.0)[:, None], 1.2, (400, 5)), np.ones((400, 1))])
    known = labels & (random.random(400) < 0.5)
    positive, everything = x[known].T @ x[known] / known.sum(), x.T @ x / 400

    def losses(w, rows, label):
        return ((1 - label * (rows @ w)) ** 2 / 4).mean()

    w = quality.minimise(positive, everything, 0.6)
    good, bad = quality.risk_parts(w, positive, everything, 0.6)
    assert good == pytest.approx(0.6 * losses(w, x[known], 1))
    assert bad == pytest.approx(losses(w, x, -1) - 0.6 * losses(w, x[known], -1))
    for _ in range(200):
        other = quality.risk_parts(w + random.normal(0, 0.05, 6), positive, everything, 0.6)
        assert other[0] + max(other[1], 0) >= good + max(bad, 0) - 1e-3
    accuracy = ((x @ w > 0) == labels).mean()
    assert accuracy > 0.9


def test_the_negatives_part_is_not_below_zero():
    """Few rows and many features: the unbiased risk leaves its range, the result does not."""
    random = np.random.default_rng(10)
    x = np.hstack([random.normal(0, 1, (30, 25)), np.ones((30, 1))])
    known = np.arange(30) < 8
    positive, everything = x[known].T @ x[known] / 8, x.T @ x / 30
    ridge = quality.RIDGE * np.trace(everything) / 26 * np.eye(26)
    ridge[-1, -1] = 0
    unbiased = np.linalg.solve(everything + ridge, 2 * 0.9 * positive[-1] - everything[-1])
    assert quality.risk_parts(unbiased, positive, everything, 0.9)[1] < 0
    w = quality.minimise(positive, everything, 0.9)
    parts = [quality.risk_parts(v, positive, everything, 0.9) for v in (w, unbiased)]
    risks = [good + max(bad, 0.0) for good, bad in parts]
    assert risks[0] <= risks[1]


def test_features_describe_whole_texts(monkeypatch):
    texts = [None, "", "   ", "One two. Three!", "été à l’été", "x" * 50, "a b a b a b", "12.5% 3,4 \n\n"]
    found = quality.text_features([t and t.encode() for t in texts])
    assert (found[0] == found[1]).all()
    assert (found[:, -1] == quality.STEPS).all() and found.min() >= 0 and found.max() <= quality.STEPS
    alone = [quality.text_features([t and t.encode()])[0] for t in texts]
    assert (np.array(alone) == found).all()  # whatever stands beside it
    long = "Some words are here, and WORDS!! 12 | there. " * 400
    whole = quality.text_features([long.encode()])[0]
    monkeypatch.setattr(quality, "_TOGETHER_BYTES", 1000)
    parts = quality.text_features([long.encode(), b"x"])[0]
    apart = np.flatnonzero(np.abs(whole - parts) > 8)
    new = quality.SHAPES + quality._BY_WORD.index("new in the text")
    assert set(apart.tolist()) <= {new, new - 1, new - 2}  # counted within a part
    assert not quality.text_features([b"y" * 5000, b""])[1][: quality.SHAPES].any()


def labelled_texts(random, n=300):
    good = [" ".join(random.choice(["The", "house", "is", "red.", "and", "we"], 40)) for _ in range(n)]
    bad = [" ".join(f"{w}$$$" for w in random.choice(["The", "house", "red"], 40)) for _ in range(n)]
    return good, bad


def test_quality_is_learned_from_positives_and_unlabelled_texts(spark):
    good, bad = labelled_texts(np.random.default_rng(11))
    rows = [(n, t) for n, t in enumerate([*good, *bad])]
    odd = [(None, "The house"), (None, None), (5000, None), (5001, ""), (1, good[1]), (2, bad[2])]
    docs = documents(spark, [*rows, *odd])
    told = [(n, 1 if n < 300 else 0, 0) for n in range(0, 600, 4)]
    told += [(None, 1, 0), (3, None, 0), (1, 1, 0), (1, 1, 0), (9, 1, 1), (9, 0, 1)]
    labels = spark.createDataFrame(told, "doc_id long, quality int, of int")
    model = quality.train(docs, labels)
    assert 0.4 < model.prior < 0.6
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    known = {n for n, q, _ in told if q == 1 and n is not None} - {9}
    positive, everything = plain_moments([t for _, t in plain], [i in known for i, _ in plain])
    want = quality.minimise(positive, everything, model.prior) / quality.STEPS
    assert np.allclose(model.weights, want)
    docs = docs.drop("score")
    scored = quality.score_quality(docs, model)
    assert scored.columns == [*docs.columns, "score", "predicted"]
    found = scored.collect()
    assert len(found) == len(plain) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.5) for r in found)
    right = [r.predicted == (r.doc_id < 300) for r in found if r.doc_id is not None and r.doc_id < 600]
    assert np.mean(right) > 0.97
    one = {r.score for r in found if not r.text}
    assert len(one) == 1
    with pytest.raises(ValueError, match="exist"):
        quality.score_quality(docs.withColumn("Score", F.lit(1)), model)
    kept = quality.score_quality(docs, model).where("score > 0.5")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_quality_with_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a"), (2, None)]).drop("score")
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, quality int")
    for d, l in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        model = quality.train(d, l)
        assert model.weights is None
        assert {r.score for r in quality.score_quality(docs, model).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).isEmpty()


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op13_quality_classifier"](spark, sf)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    told = found.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.score for r in told if r.quality == 1]
    bad = [r.score for r in told if r.quality == 0]
    above = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert above > 0.95
    assert np.mean([r.predicted == r.quality for r in told]) > 0.93
