"""Score the quality of texts by learning from positive and unlabelled ones.

Trusted positives are documents labelled 1; all documents to learn from count as
unlabelled web text, whatever their labels.  The class prior, the share of good documents
among the unlabelled, is estimated from the labels.  With the squared loss on a linear
model the unbiased risk, ``prior * E_P[loss(z, +1) - loss(z, -1)] + E_U[loss(z, -1)]``, is a
quadratic of the weights, known from the second moments of the two groups alone.  So one
pass over all documents gathers whole-number sums of fixed size, and the risk is minimised
exactly, whatever the size of the corpus.  Where the part that stands for negatives,
``E_U[loss(z, -1)] - prior * E_P[loss(z, -1)]``, comes out below zero, which no true risk
can, the non-negative risk counts it as zero and is minimised by gradient steps that lead
out of that region.

Texts are described by hashed shapes of their words (``Word``, ``WORD!!``, ``12.5%``), how
often words repeat the ones before, and shares of kinds of characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import BROADCAST_ROWS, byte_texts, in_pieces, mixed, summed_arrays

#: Buckets of word shapes.
SHAPES = 256
#: A feature is a whole number up to this, so that sums do not depend on their order.
STEPS = 1 << 10
#: Share of the mean square that is added to the moments, against weights without ground.
RIDGE = 1e-4
#: Steps of the non-negative risk, should the unbiased one leave its range.
STEPS_BACK = 500
#: The score of all texts where nothing can be learned.
UNKNOWN = 0.5

_TOGETHER_BYTES = 1 << 20
# Kinds of bytes: of letters, digits, ends of words, and other marks one by one.
_SPACE, _UPPER, _LOWER, _DIGIT, _WIDE = range(5)
_KINDS = np.array(
    [
        _SPACE
        if c in b" \t\n\v\f\r"
        else _WIDE
        if c >= 128
        else _UPPER
        if chr(c).isupper()
        else _LOWER
        if chr(c).islower()
        else _DIGIT
        if chr(c).isdigit()
        else 5 + c
        for c in range(256)
    ],
    np.uint8,
)
# Dense features, after the shapes: shares of words, then of bytes, then sizes.
_BY_WORD = ("as before", "as two before", "new in the text", "empty shape", "ends a sentence")
_BY_BYTE = ("upper", "lower", "digit", "wide", "mark", "line feed")
_SIZES = 12  # steps of the number of words, doubling
_WORD_SIZES = 8  # steps of the mean length of words
WIDTH = SHAPES + len(_BY_WORD) + len(_BY_BYTE) + _SIZES + _WORD_SIZES + 1


def _word_hashes(kinds: np.ndarray, inside: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of the values of ``kinds`` within each word.

    ``inside`` are their places' word numbers, in order; ``first`` where each word begins.
    """
    starts = np.searchsorted(inside, first)
    ranks = np.arange(len(inside)) - starts[inside] if len(inside) else inside
    powers = mixed(np.arange(1, int(ranks.max(initial=0)) + 2).astype(np.uint64))
    values = mixed(kinds.astype(np.uint64) + np.uint64(1)) * powers[ranks]
    total = np.zeros(len(first) + 1, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    ends = np.append(starts[1:], len(inside))
    total[:-1] = sums[ends] - sums[starts]
    return mixed(total[:-1])


def _counted(data: bytes, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(shape counts, word counts, byte counts, words, bytes) of texts laid end to end.

    Every text ends in a space; ``cuts`` are the places where they begin.
    """
    raw = np.frombuffer(data, np.uint8)
    kinds = _KINDS[raw]
    texts = len(cuts)
    lengths = np.diff(np.append(cuts, len(raw)))
    owner = np.repeat(np.arange(texts), lengths)
    blank = kinds == _SPACE
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)
    words = np.bincount(owner[starts], minlength=texts)
    word_of = np.cumsum(begins) - 1
    inside = np.flatnonzero(~blank)
    word_text = owner[starts]
    # Whole words, to tell repeats.
    number = np.arange(len(starts))
    whole = _word_hashes(raw[inside], word_of[inside], number)
    # Shapes: kinds without wide bytes, runs as one.
    plain = inside[kinds[inside] != _WIDE]
    run = np.ones(len(plain), bool)
    run[1:] = (kinds[plain[1:]] != kinds[plain[:-1]]) | (word_of[plain[1:]] != word_of[plain[:-1]])
    plain = plain[run]
    shape = _word_hashes(kinds[plain], word_of[plain], number)
    bucket = (shape % np.uint64(SHAPES)).astype(np.int64)
    shapes = np.bincount(word_text * SHAPES + bucket, minlength=texts * SHAPES)
    counts = []
    for back in (1, 2):
        same = whole[back:] == whole[:-back]
        same &= word_text[back:] == word_text[:-back]
        counts.append(np.bincount(word_text[back:][same], minlength=texts))
    order = np.lexsort((whole, word_text))
    new = np.ones(len(starts), bool)
    new[1:] = (whole[order[1:]] != whole[order[:-1]]) | (
        word_text[order[1:]] != word_text[order[:-1]]
    )
    counts.append(np.bincount(word_text[order][new], minlength=texts))
    shaped = np.bincount(word_of[plain], minlength=len(starts)) if len(plain) else 0 * number
    counts.append(np.bincount(word_text[shaped == 0], minlength=texts))
    stops = np.flatnonzero(blank[1:] & ~blank[:-1]) if len(raw) > 1 else np.zeros(0, np.int64)
    sentence = np.isin(raw[stops], np.frombuffer(b".?!", np.uint8))
    counts.append(np.bincount(owner[stops][sentence], minlength=texts))
    marks = [kinds == k for k in (_UPPER, _LOWER, _DIGIT, _WIDE)]
    marks += [kinds > _WIDE, raw == 10]
    by_byte = [np.bincount(owner[mark], minlength=texts) for mark in marks]
    return (
        shapes.reshape(texts, SHAPES),
        np.array(counts).T,
        np.array(by_byte).T,
        words,
        lengths - 1,
    )


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words, if it has any."""
    start = 0
    while len(text) - start > _TOGETHER_BYTES:
        stop = text.rfind(b" ", start + 1, start + _TOGETHER_BYTES)
        stop = stop if stop > 0 else start + _TOGETHER_BYTES
        yield text[start:stop]
        start = stop
    yield text[start:]


def text_features(texts: Iterable[bytes | None]) -> np.ndarray:
    """[text, feature]: whole numbers from 0 to ``STEPS``; the last one is constant.

    A null text counts as an empty one.  Of a text above a megabyte the counts of its
    parts are added, so it is described whole in bounded memory.
    """
    texts = [text or b"" for text in texts]
    sums = [np.zeros((len(texts), n), np.int64) for n in (SHAPES, len(_BY_WORD), len(_BY_BYTE))]
    words, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    parts = ((row, part) for row, text in enumerate(texts) for part in _parts(text))
    for piece in in_pieces(parts, lambda item: len(item[1]) + 1, _TOGETHER_BYTES):
        rows = np.array([row for row, _ in piece])
        ends = np.cumsum([len(part) + 1 for _, part in piece])
        counted = _counted(
            b"".join(part + b" " for _, part in piece), np.append(0, ends[:-1])
        )
        for total, counts in zip((*sums, words, size), counted, strict=True):
            np.add.at(total, rows, counts)
    return _features(*sums, words, size)


def _features(
    shapes: np.ndarray, by_word: np.ndarray, by_byte: np.ndarray, words: np.ndarray, size: np.ndarray
) -> np.ndarray:
    found = np.zeros((len(words), WIDTH))
    per_word, per_byte = np.maximum(words, 1)[:, None], np.maximum(size, 1)[:, None]
    at = SHAPES
    found[:, :at] = np.sqrt(shapes / per_word)  # a rare shape still tells
    found[:, at : at + len(_BY_WORD)] = by_word / per_word
    at += len(_BY_WORD)
    found[:, at : at + len(_BY_BYTE)] = by_byte / per_byte
    at += len(_BY_BYTE)
    rows = np.arange(len(words))
    found[rows, at + np.minimum(np.log2(words + 1).astype(int), _SIZES - 1)] = 1
    at += _SIZES
    found[rows, at + np.minimum(np.log2(size / per_word[:, 0] + 1).astype(int), _WORD_SIZES - 1)] = 1
    found[:, -1] = 1
    return np.rint(found * STEPS).astype(np.int64)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's features, as packed pairs of place and value."""
    for batch in batches:
        found = text_features(byte_texts(batch["text"]))
        rows, places = np.nonzero(found)
        cuts = np.searchsorted(rows, np.arange(len(found) + 1))
        packed = np.stack([places, found[rows, places]], 1).astype(np.uint16)
        data = [packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch["ident"], pa.array(data)], ["ident", "features"])


def _unpacked(data: list[bytes]) -> np.ndarray:
    found = np.zeros((len(data), WIDTH))
    pairs = np.frombuffer(b"".join(data), np.uint16).reshape(-1, 2)
    rows = np.repeat(np.arange(len(data)), [len(x) // 4 for x in data])
    found[rows, pairs[:, 0]] = pairs[:, 1]
    return found


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the products of all features, over all rows and over positives.

    The constant feature's row has the sums, and its product with itself the count.
    """
    sums = {key: np.zeros((WIDTH, WIDTH), np.int64) for key in ("all", "positive")}
    for batch in batches:
        positive = batch["positive"].to_numpy(zero_copy_only=False).astype(bool)
        for low in range(0, len(batch), 4096):
            rows = _unpacked(batch["features"].slice(low, 4096).to_pylist())
            good = rows[positive[low : low + 4096]]
            # Exact: 4,096 products of numbers up to 1,024 are far below 2^53.
            sums["all"] += (rows.T @ rows).astype(np.int64)
            sums["positive"] += (good.T @ good).astype(np.int64)
    yield pa.RecordBatch.from_pydict(
        {"key": list(sums), "data": [x.tobytes() for x in sums.values()]}
    )


@dataclass(frozen=True)
class QualityModel:
    """Weights of the features; none if there was nothing to learn from."""

    weights: np.ndarray | None
    prior: float

    def scores(self, texts: Iterable[bytes | None]) -> np.ndarray:
        found = text_features(texts)
        if self.weights is None:
            return np.full(len(found), UNKNOWN)
        # The squared loss is least where z is twice the probability less one.
        return np.clip((found @ self.weights + 1) / 2, 0.0, 1.0)


def risk_parts(
    weights: np.ndarray, positive: np.ndarray, everything: np.ndarray, prior: float
) -> tuple[float, float]:
    """The risk of positives, and the estimated one of negatives, for mean moments.

    The loss of z for a label y is (1 - y z)^2 / 4.
    """

    def mean_loss(moments: np.ndarray, label: int) -> float:
        return float(1 - 2 * label * moments[-1] @ weights + weights @ moments @ weights) / 4

    of_positives = prior * mean_loss(positive, 1)
    return of_positives, mean_loss(everything, -1) - prior * mean_loss(positive, -1)


def minimise(positive: np.ndarray, everything: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the least non-negative risk, from mean moments with a constant feature.

    The unbiased risk's minimum is a linear system.  It is also the minimum of the
    non-negative risk, which is nowhere smaller, if the negatives' part is not below zero
    there.  Otherwise steps go down the whole risk while that part is at least zero, and
    up that part alone while it is not.
    """
    ridge = RIDGE * np.trace(everything) / len(everything) * np.eye(len(everything))
    ridge[-1, -1] = 0
    weights = np.linalg.solve(everything + ridge, 2 * prior * positive[-1] - everything[-1])
    good, bad = risk_parts(weights, positive, everything, prior)
    if bad >= 0:
        return weights
    step = 1.0 / max(np.linalg.eigvalsh(everything + prior * positive)[-1], 1e-12)
    best, least = weights, good
    for _ in range(STEPS_BACK):
        if bad >= 0:
            down = (everything[-1] + everything @ weights) / 2 - prior * positive[-1]
            weights = weights - step * (down + ridge @ weights)
        else:
            up = (everything[-1] + everything @ weights) / 2
            up -= prior * (positive[-1] + positive @ weights) / 2
            weights = weights + step * up
        good, bad = risk_parts(weights, positive, everything, prior)
        if good + max(bad, 0.0) < least:
            best, least = weights, good + max(bad, 0.0)
    return best


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    ident: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    prior: float | None = None,
) -> QualityModel:
    """Learn from all rows of ``docs`` for which ``learn`` holds, and their labels.

    A document is a trusted positive if all of its labels are 1; null labels and labels
    of null identifiers say nothing.  The rest is unlabelled, and so are the positives
    themselves.  ``prior`` is estimated as the share of positives among the labelled
    documents, if it is not given.  Without documents or positives nothing is learned.
    Repeated rows count as often.  Other columns are ignored, whatever their names.
    """
    chosen = docs if learn is None else docs.where(learn)
    rows = chosen.select(chosen[ident].alias("ident"), chosen[text].alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()
    told = (
        labels.select(labels[ident].alias("of"), labels[quality].alias("quality"))
        .where("of is not null and quality is not null")
        .groupBy("of")
        .agg((F.min("quality") == 1).alias("positive"))
    )
    few = told.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # Features are far smaller than texts, and these stay where they are.
    described = rows.mapInArrow(_described, f"ident {kind}, features binary")
    joined = described.join(F.broadcast(told) if few else told, F.col("ident") == F.col("of"), "left")
    marked = joined.select(
        "features", F.coalesce("positive", F.lit(False)).alias("positive"), F.col("of").isNotNull()
    ).toDF("features", "positive", "labelled")
    sums = summed_arrays(marked.mapInArrow(_moments_and_labels, "key string, data binary"), "int64")
    found = {row.key: np.frombuffer(row.data, np.int64) for row in sums.collect()}  # three rows
    if not found:
        return QualityModel(None, 0.0)
    everything, positive = (found[k].reshape(WIDTH, WIDTH) for k in ("all", "positive"))
    n, good, labelled = everything[-1, -1], positive[-1, -1], int(found["labelled"][0])
    if not good:
        return QualityModel(None, 0.0)
    share = prior if prior is not None else good / STEPS**2 / labelled
    weights = minimise(positive / good, everything / n, float(share))
    return QualityModel(weights / STEPS, float(share))


def _moments_and_labels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labelled = 0

    def counted() -> Iterator[pa.RecordBatch]:
        nonlocal labelled
        for batch in batches:
            labelled += int(batch["labelled"].to_numpy(zero_copy_only=False).sum())
            yield batch

    yield from _moments(counted())
    data = np.array([labelled], np.int64).tobytes()
    yield pa.RecordBatch.from_pydict({"key": ["labelled"], "data": [data]})


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``.

    The score is the probability of label 1, 0 to 1; predicted is 1 from a half on.  Null
    and empty texts are scored as empty ones.  An untrained model gives every text a half.
    The input's columns are kept, whatever their names; the two must not be among them.
    """
    if clash := {c.lower() for c in docs.columns} & {"score", "predicted"}:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(byte_texts(texts)))

    # A filter on the score must not bring the texts to Python once more.
    score = F.arrow_udf(scored, "double").asNondeterministic()(docs[text])
    return docs.select("*", score.alias("score")).select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
