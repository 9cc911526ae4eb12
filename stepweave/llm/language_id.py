"""Language of every word and document.

Trigram counts of the labelled documents give each word a score per language; the
scripts that a language is written in narrow a word's candidates; and the Viterbi path
over the words, with a penalty for each switch, labels the spans of mixed text.  A
document's language has most of its letters.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import in_pieces, summed_arrays

#: Trigrams are hashed into so many buckets; with the number of languages this bounds
#: the model: 8 bytes a bucket and language.
BUCKETS = 1 << 15
#: What a switch of the language between two words costs, in natural logarithms.
SWITCH = 8.0
#: A script is one of a language's if at least this share of its letters is in it.
SCRIPT_SHARE = 0.001
#: What a word costs in a language that is not written in its script.
WRONG_SCRIPT = 50.0
#: The language of texts without letters.
UNDETERMINED = "und"
_SMOOTHING = 0.5
_PIECE_CHARS = 1 << 20
# Texts are taken out of an Arrow batch so many at a time.
_TOGETHER = 4096

# The first code points of ranges of one script, and the scripts.
SCRIPT_RANGES = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0750, "arabic"),
    (0x0780, "other"),
    (0x08A0, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"),
    (0x0B00, "oriya"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "kannada"),
    (0x0D00, "malayalam"),
    (0x0D80, "sinhala"),
    (0x0E00, "thai"),
    (0x0E80, "lao"),
    (0x0F00, "tibetan"),
    (0x1000, "myanmar"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x13A0, "other"),
    (0x1780, "khmer"),
    (0x1800, "mongolian"),
    (0x18B0, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "latin"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x2E80, "han"),
    (0x3040, "kana"),
    (0x3100, "han"),
    (0x3130, "hangul"),
    (0x3190, "han"),
    (0x31F0, "kana"),
    (0x3200, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD800, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB10, "other"),
    (0xFB50, "arabic"),
    (0xFE00, "other"),
    (0xFF00, "latin"),
    (0xFF66, "kana"),
    (0xFFA0, "hangul"),
    (0x10000, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
)
SCRIPTS = tuple(dict.fromkeys(script for _, script in SCRIPT_RANGES))


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter, by code point."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@functools.cache
def _scripts() -> np.ndarray:
    """A code point's script, by code point."""
    starts = [start for start, _ in SCRIPT_RANGES] + [0x110000]
    numbers = [SCRIPTS.index(script) for _, script in SCRIPT_RANGES]
    return np.repeat(np.array(numbers, np.int8), np.diff(starts))


@dataclass
class _Words:
    """The words (runs of letters) of several texts, and their letters' trigrams."""

    trigrams: np.ndarray  # bucket of each letter's trigram
    starts: np.ndarray  # first letter of each word, counted in letters
    lengths: np.ndarray
    scripts: np.ndarray  # of each word's first letter
    texts: np.ndarray  # number of each word's text


def _words(texts: list[str]) -> _Words:
    points = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "replace"), np.uint32)
    points = np.concatenate([[np.uint32(10)], points, [np.uint32(10)]])
    letter = _letters()[points]
    code = np.where(letter, points, np.uint32(0))
    at = np.flatnonzero(letter)
    hashed = code[at - 1] * np.uint32(0x9E3779B1)
    hashed ^= code[at] * np.uint32(0x85EBCA77)
    hashed = (hashed ^ (hashed >> np.uint32(15))) + code[at + 1] * np.uint32(0xC2B2AE3D)
    hashed *= np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    first = ~letter[at - 1]
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(at))
    return _Words(
        (hashed >> shift).astype(np.int32),
        starts,
        ends - starts,
        _scripts()[points[at[first]]],
        np.searchsorted(np.flatnonzero(points[1:] == 10), at[first] - 1),
    )


def _parts(text: str) -> list[str]:
    """A long text in parts that end between words; line feeds become spaces."""
    text = text.replace("\n", " ")
    parts, start = [], 0
    while len(text) - start > _PIECE_CHARS:
        stop = start + _PIECE_CHARS
        while stop > start + 1 and text[stop - 1].isalpha():
            stop -= 1
        stop = stop if stop > start + 1 else start + _PIECE_CHARS
        parts.append(text[start:stop])
        start = stop
    return [*parts, text[start:]]


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """Lists of (row, part), of bounded length together; the shortest texts come first.

    So the texts of a list have much the same length, and take their steps together.
    """
    order = sorted(range(len(texts)), key=lambda row: len(texts[row] or ""))
    parts = ((row, part) for row in order for part in _parts(texts[row] or ""))
    return in_pieces(parts, lambda part: len(part[1]) + 1, _PIECE_CHARS)


def _slices(batches: Iterable) -> Iterator:
    """Some rows of each batch at a time; memory that Arrow holds unused goes back."""
    for batch in batches:
        for start in range(0, len(batch), _TOGETHER):
            yield batch.slice(start, _TOGETHER)
        pa.default_memory_pool().release_unused()


@dataclass(frozen=True)
class LanguageModel:
    """Scores by trigram bucket and language, and each language's scripts."""

    languages: list[str]
    scores: np.ndarray  # [bucket, language]
    penalties: np.ndarray  # [script, language]


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", learn: Column | None = None
) -> LanguageModel:
    """Count the trigrams of all rows with a text and a label for which ``learn`` holds."""
    labelled = docs.where(docs[text].isNotNull() & docs[lang].isNotNull())
    if learn is not None:
        labelled = labelled.where(learn)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in _slices(batches):
            langs = batch["lang"].to_pylist()
            for piece in _pieces(batch["text"].to_pylist()):
                # One label after the other: counts of a label are one array.
                for label in {langs[row] for row, _ in piece}:
                    words = _words([part for row, part in piece if langs[row] == label])
                    if label not in counts:
                        counts[label] = np.zeros(BUCKETS + len(SCRIPTS), np.int64)
                    counts[label][:BUCKETS] += np.bincount(words.trigrams, minlength=BUCKETS)
                    letters = np.bincount(words.scripts, words.lengths, len(SCRIPTS))
                    counts[label][BUCKETS:] += letters.astype(np.int64)
        for label, found in counts.items():
            yield pa.RecordBatch.from_pydict({"key": [label], "data": [found.tobytes()]})

    chosen = labelled.select(labelled[text].alias("text"), labelled[lang].alias("lang"))
    counted = chosen.mapInArrow(count, "key string, data binary")
    rows = sorted(summed_arrays(counted, "int64").collect())  # a row for each language
    if not rows:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0)))
    counts = np.array([np.frombuffer(row.data, np.int64) for row in rows], np.float64).T
    trigrams, letters = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((trigrams + _SMOOTHING) / (trigrams.sum(0) + _SMOOTHING * BUCKETS))
    used = letters >= SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    # A script that no language uses says nothing.
    penalties = np.where(used | ~used.any(1, keepdims=True), 0.0, -WRONG_SCRIPT)
    return LanguageModel([row.key for row in rows], scores.astype(np.float32), penalties)


def viterbi(scores: np.ndarray, texts: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word: ``scores`` [word, language], words by text.

    All texts take their steps together, the longest first, so that the number of steps
    is that of the longest text.
    """
    n, k = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, texts[1:] != texts[:-1]))
    lengths = np.diff(np.append(first, n))
    order = np.argsort(-lengths, kind="stable")
    first, lengths = first[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    stays = np.zeros((n, k), bool)
    best_before = np.zeros(n, np.int64)
    value = scores[first].astype(np.float64)
    for step in range(1, lengths[0]):
        m = active[step]
        now, at = value[:m], first[:m] + step
        best = now.argmax(1)
        switched = now[np.arange(m), best] - penalty
        stay = now >= switched[:, None]
        stays[at] = stay
        best_before[at] = best
        value[:m] = np.where(stay, now, switched[:, None]) + scores[at]
    labels = np.zeros(n, np.int64)
    state = value.argmax(1)
    for step in range(lengths[0] - 1, -1, -1):
        m = active[step]
        at = first[:m] + step
        labels[at] = state[:m]
        if step:
            stay = stays[at, state[:m]]
            state[:m] = np.where(stay, state[:m], best_before[at])
    return labels


def label_languages(
    docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = SWITCH
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_spans``.

    ``lang_spans`` lists (language, first word, words) of the text's words, which are its
    runs of letters.  ``lang_pred`` has most letters, the first by name of equal ones;
    ``lang_score`` is its share of the letters, 0 to 1.  A null text, a text without
    letters and any text under an empty model are ``und`` with score 0 and no spans.
    The input's columns are kept, whatever their names; the three must not be among them.
    """
    new = ["lang_pred", "lang_score", "lang_spans"]
    if clash := {c.lower() for c in docs.columns} & set(new):
        raise ValueError(f"columns already exist: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(column: pa.Array) -> pa.Array:
        parts = [pa.array([], _LABEL)]
        for part in _slices([column]):
            parts.append(pa.array(_labelled(part.to_pylist(), shared.value, penalty), _LABEL))
        return pa.concat_arrays(parts)

    # A filter on the label must not bring the texts to Python once more.
    labelled = F.arrow_udf(label, "pred string, score double, " + _SPANS).asNondeterministic()
    found = labelled(docs[text])
    return docs.select("*", found.alias("__found")).select(
        *(docs[c] for c in docs.columns),
        F.col("__found.pred").alias("lang_pred"),
        F.col("__found.score").alias("lang_score"),
        F.col("__found.spans").alias("lang_spans"),
    )


_SPANS = "spans array<struct<lang string, first long, words long>>"
_LABEL = pa.struct(
    [
        ("pred", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())])
            ),
        ),
    ]
)


def _labelled(texts: list[str | None], model: LanguageModel, penalty: float) -> list[dict]:
    nothing = {"pred": UNDETERMINED, "score": 0.0, "spans": []}
    found = [nothing] * len(texts)
    if not model.languages:
        return found
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    last = -1
    for piece in _pieces(texts):
        if held and piece[0][0] != last:  # no text goes on from the pieces before
            _decide(held, model, penalty, found)
            held = []
        last = piece[-1][0]
        words = _words([part for _, part in piece])
        if len(words.starts):
            scores = np.add.reduceat(model.scores[words.trigrams], words.starts, axis=0)
            scores += model.penalties[words.scripts].astype(np.float32)
            rows = np.array([row for row, _ in piece])[words.texts]
            held.append((scores, words.lengths, rows))
    _decide(held, model, penalty, found)
    return found


def _decide(held: list, model: LanguageModel, penalty: float, found: list[dict]) -> None:
    """Label the words of whole texts, and put each text's result into ``found``."""
    if not held:
        return
    scores, lengths, rows = (np.concatenate(parts) for parts in zip(*held, strict=True))
    labels = viterbi(scores, rows, penalty)
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    turns = np.append(True, (rows[1:] != rows[:-1]) | (labels[1:] != labels[:-1]))
    turns = np.append(np.flatnonzero(turns), len(rows))
    k = len(model.languages)
    local = np.cumsum(np.isin(np.arange(len(rows)), starts, assume_unique=True)) - 1
    letters = np.bincount(local * k + labels, lengths, len(starts) * k).reshape(-1, k)
    spans: dict[int, list[dict]] = {}
    for start, stop in zip(turns[:-1].tolist(), turns[1:].tolist(), strict=True):
        span = {
            "lang": model.languages[labels[start]],
            "first": start - int(starts[local[start]]),
            "words": stop - start,
        }
        spans.setdefault(int(rows[start]), []).append(span)
    for row, counts in zip(rows[starts].tolist(), letters, strict=True):
        best = int(counts.argmax())
        found[row] = {
            "pred": model.languages[best],
            "score": float(counts[best] / counts.sum()),
            "spans": spans[row],
        }
