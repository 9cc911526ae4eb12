"""Find benchmark passages in documents by latent semantic retrieval.

Passages are TF-IDF vectors over hashed terms.  Randomised singular value
decompositions of all passages, whose products of terms are summed on Spark, give a latent
space for each group of items; documents' passages that are close to an item there are
candidates.  An item of frequent words can be
far from the passage that holds it, so a run of its words is a candidate too.  A longest common
subsequence of words, and for paraphrases the item's answer, decide.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepweave.llm.common import (
    PIECE_BYTES,
    collected,
    in_pieces,
    is_stored,
    mixed,
    release,
    settled,
    stored,
    summed_arrays,
)

#: Hashed terms, dimensions of the latent space and extra ones while it is computed.
TERMS = 1 << 17
RANK = 256
EXTRA = 16
#: A passage is two blocks of so many words; passages overlap by a block.
HALF = 20
#: A space is for so many passages of items, fewer than its dimensions; it is fitted on
#: all passages of documents besides, which weigh as so many together, and of which the
#: items' count so many times as much: they must be told apart, whatever is frequent.
GROUP = RANK // 2
DOCS_WEIGHT = 4096
ITEM_WEIGHT = 16.0
#: Tasks that multiply passages, at least, and blocks of documents for each further one:
#: each has the products whole, and sends as much on.
FIT_TASKS, FIT_BLOCKS = 6, 1 << 18
#: Products of terms that a task holds: those of further groups take further readings.
FIT_CELLS = 1 << 24
#: So many passages of items are searched for at once; further ones in further rounds.
PASSAGES_AT_ONCE = 16 * GROUP
#: Least cosine of a candidate.
COSINE = 0.2
#: Least share of an item's words, in order: of a copy, and of a paraphrase, which also
#: needs that share of the answer, the item's last words.
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.75
ANSWER_WORDS = 8
#: A run of so many words of an item that is in a document makes it a candidate, whatever
#: their weights; so does a shorter item as a whole, from so many words on.
RUN, SHORTEST = 8, 5
#: Words of an item that are compared at once.
LCS_WORDS = 4096
# Bits of a hash that tell at first sight that it is no item's.
_MARK_BITS = 20
_MARKS = np.uint64((1 << _MARK_BITS) - 1)
_SEED = 11
# Words of at most so many bytes are hashed together, byte by byte.
_LONG_WORD = 32
# More than sums of single precision are off.
_ROUNDING = 1e-4
_PART = 1 << 18  # products per row of the shuffle
_BLOCKS_AT_ONCE = 1 << 10

# ASCII marks become spaces.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _plain(text: str) -> bytes:
    return text.lower().encode().translate(_PLAIN)


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return _plain(text).split() if text else []


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc32s(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`zlib.crc32` of many words."""
    # Long words come first: those that have one more byte are the first so many.
    short = np.minimum(sizes, _LONG_WORD + 1).astype(np.int16)
    order = np.argsort(-short, kind="stable")
    begins, found = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    more = len(starts) - np.cumsum(np.bincount(short, minlength=_LONG_WORD + 2))
    for byte in range(_LONG_WORD):
        some = found[: more[byte]]
        if not len(some):
            break
        at = (some ^ data[begins[: len(some)] + byte]) & np.uint32(255)
        found[: len(some)] = _CRC[at] ^ some >> np.uint32(8)
    hashes = np.empty_like(found)
    hashes[order] = ~found
    for word in order[: more[_LONG_WORD]].tolist():
        hashes[word] = crc32(data[starts[word] : starts[word] + sizes[word]])
    return hashes


def _terms_of(plain: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a plain text's words, and where these begin."""
    data = np.frombuffer(plain + b" ", np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.append(0, ends[:-1] + 1)
    there = ends > starts
    starts, ends = starts[there], ends[there]
    hashes = _crc32s(data, starts, ends - starts)
    return (hashes & np.uint32(TERMS - 1)).astype(np.int64), starts


def _terms(words: list[bytes]) -> np.ndarray:
    return _terms_of(b" ".join(words))[0]


def _pieces(
    texts: Iterable[str | None],
) -> Iterator[tuple[list[tuple[int, bytes]], np.ndarray, np.ndarray]]:
    """Some (row, plain text) with words at a time, their terms and how many each has."""
    plain = ((row, _plain(text)) for row, text in enumerate(texts) if text)
    for piece in in_pieces(plain, lambda item: len(item[1]), PIECE_BYTES):
        terms, starts = _terms_of(b" ".join(text for _, text in piece))
        ends = np.cumsum([len(text) + 1 for _, text in piece])
        lengths = np.diff(np.searchsorted(starts, ends), prepend=0)
        if len(terms):
            yield [piece[i] for i in np.flatnonzero(lengths)], terms, lengths[lengths > 0]


def _block_starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: each block's first word, its text, its number in it."""
    counts = -(-lengths // HALF)
    texts = np.repeat(np.arange(len(lengths)), counts)
    numbers = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.cumsum(lengths) - lengths
    return begins[texts] + numbers * HALF, texts, numbers


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each term is there; in blocks this short that is in how many blocks."""
    counts = np.zeros(TERMS + 1, np.int64)
    for batch in batches:
        for _, terms, lengths in _pieces(batch["text"].to_pylist()):
            counts[:TERMS] += np.bincount(terms, minlength=TERMS)
            counts[TERMS] += (-(-lengths // HALF)).sum()
    yield pa.RecordBatch.from_pydict({"key": ["terms"], "data": [counts.tobytes()]})


def _all_passages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term lists of all passages."""
    for batch in batches:
        for _, terms, lengths in _pieces(batch["text"].to_pylist()):
            starts, texts, _ = _block_starts(lengths)
            sizes = np.minimum(starts + 2 * HALF, np.cumsum(lengths)[texts]) - starts
            stops = np.cumsum(sizes)
            at = np.arange(stops[-1]) + np.repeat(starts - (stops - sizes), sizes)
            offsets = pa.array(np.append(0, stops), pa.int32())
            found = pa.ListArray.from_arrays(offsets, pa.array(terms.astype(np.int32)[at]))
            yield pa.RecordBatch.from_arrays([found], ["terms"])


def _scaled(
    terms: np.ndarray, lengths: np.ndarray, scales: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, part) of passages laid end to end, a passage's terms in order.

    Its parts are as its terms' counts times their weights, and its length is its scale.
    """
    passages = np.repeat(np.arange(len(lengths)), lengths)
    wide = int(lengths.max(initial=1))
    table = np.full((len(lengths), wide), TERMS, np.int32)
    table[passages, np.arange(len(terms)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = terms
    table.sort(axis=1)
    flat = table.ravel()
    new = np.diff(flat, prepend=-1) != 0
    new[::wide] = True
    at = np.flatnonzero(new)
    times = np.diff(at, append=len(flat))
    there = flat[at] < TERMS
    at, times = at[there], times[there]
    passage, term = at // wide, flat[at]
    part = times * weights[term].astype(np.float64)
    norms = np.sqrt(np.bincount(passage, part**2, len(lengths)))
    return passage, term, part * (scales / np.maximum(norms, 1e-30))[passage]


def _add_products(
    total: np.ndarray, used: np.ndarray, passage: np.ndarray, term: np.ndarray, part: np.ndarray
) -> None:
    """Add the products of the passages' used terms, of two terms where the first is no later.

    Terms side by side first, then those at growing distances within their passages.
    """
    place = np.full(TERMS, -1, np.int32)
    place[used] = np.arange(len(used))
    at = place[term]
    known = np.flatnonzero(at >= 0)
    at, passage, part = at[known], passage[known], part[known]
    flat = total.reshape(-1)
    # How many terms follow in the passage; those that most follow come first.
    left = np.cumsum(np.bincount(passage, minlength=1))[passage] - np.arange(len(at)) - 1
    order = np.argsort(-left.astype(np.int16), kind="stable") if len(at) else known
    counts = np.bincount(left, minlength=1)
    row, own = at[order] * np.int64(len(used)), part[order]
    n = len(at)
    for distance in range(len(counts)):
        there = order[:n] + distance
        np.add.at(flat, row[:n] + at[there], own[:n] * part[there])
        n -= counts[distance]


def _products(weights: np.ndarray, used: list[np.ndarray]):
    """The passages' part of each group's A^T A, its upper half in parts of whole rows.

    A has the group's terms; passages are scaled by all of theirs.
    """

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(own), len(own))) for own in used]
        for batch in batches:
            lists = batch["terms"]
            scaled = _scaled(
                lists.flatten().to_numpy(),
                lists.value_lengths().to_numpy().astype(np.int64),
                batch["scale"].to_numpy(),
                weights,
            )
            for total, own in zip(totals, used, strict=True):
                _add_products(total, own, *scaled)
        for group, total in enumerate(totals):
            step = _rows_of_a_part(len(total))
            for row in range(0, len(total), step):
                some = total[row : row + step, row:]
                if some.any():
                    data = some.astype(np.float32).tobytes()
                    yield pa.RecordBatch.from_pydict({"key": [f"{group} {row}"], "data": [data]})

    return multiply


def _rows_of_a_part(terms: int) -> int:
    return max(1, _PART // terms)


@dataclass(frozen=True)
class LatentSpace:
    """A space of some targets, and what each term adds to the products with them there."""

    place: np.ndarray  # of each term in the products; -1 for terms that no target has
    products: np.ndarray  # by term, times its weight, and target
    missing: np.ndarray  # length of the part of each target that the space lacks

    @cached_property
    def greatest(self) -> np.ndarray:
        """The most that a term adds to any product."""
        return self.products.max(axis=1, initial=0).astype(np.float64)


def term_weights(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Weights of the terms from all texts, and the number of blocks."""
    counted = docs.select("text").mapInArrow(_count_terms, "key string, data binary")
    counts = np.zeros(TERMS + 1, np.int64)
    for row in collected(summed_arrays(counted, "int64")):  # one row
        counts = np.frombuffer(row.data, np.int64)
    blocks = max(int(counts[TERMS]), 1)
    weights = np.log((blocks + 1) / (np.minimum(counts[:TERMS], blocks) + 1))
    # Squared, so that few passages have a weighty part of the items' terms.
    return np.maximum(weights**2, 0.01).astype(np.float32), blocks


def sampled(docs: DataFrame, blocks: int) -> DataFrame:
    """Passages ``terms, scale`` of documents that the spaces are fitted on: all of them.

    One that repeats is a single row, of as much weight.  Where documents have more than
    ``DOCS_WEIGHT`` blocks, the weights are as much less.
    """
    chosen = docs.select("text").mapInArrow(_all_passages, "terms array<int>")
    weight = F.count(F.lit(1)) * F.lit(min(1.0, DOCS_WEIGHT / blocks))
    counted = chosen.groupBy("terms").agg(F.sqrt(weight).alias("scale"))
    return counted.coalesce(fit_tasks(blocks))


def fit_tasks(blocks: int) -> int:
    """How many tasks multiply the passages of so many blocks."""
    return max(FIT_TASKS, blocks // FIT_BLOCKS)


def fit(
    sample: DataFrame, weights: np.ndarray, targets: list[list[bytes]], tasks: int = FIT_TASKS
) -> list[LatentSpace]:
    """A space for each group of targets, from the group and the passages of documents.

    The products of a group's terms, A^T A, are summed on Spark by so many tasks, and so
    many groups at a time as a task can hold; what is read again is stored first.  Two rounds of subspace iteration with them follow.
    """
    groups = [targets[at : at + GROUP] for at in range(0, len(targets), GROUP)]
    counted = [[np.unique(_terms(words), return_counts=True) for words in own] for own in groups]
    used = [np.unique(np.concatenate([term for term, _ in group])) for group in counted]
    bases = [np.eye(len(own), dtype=np.float32) for own in used]
    large = [i for i, own in enumerate(used) if len(own) > RANK + EXTRA]
    cells = [(i, len(used[i]) ** 2) for i in large]
    readings = list(in_pieces(cells, lambda item: item[1], FIT_CELLS))
    own = stored(sample) if len(readings) > 1 and not is_stored(sample) else None
    sample = sample if own is None else own
    for reading in readings:
        numbers = [i for i, _ in reading]
        multiply = _products(weights, [used[i] for i in numbers])
        parts = sample.coalesce(tasks).mapInArrow(multiply, "key string, data binary")
        totals = [_item_products(groups[i], used[i], weights) for i in numbers]
        sums = settled(summed_arrays(parts, "float32", tasks))
        for part in sums.toLocalIterator():
            group, row = map(int, part.key.split())
            total = totals[group]
            data = np.frombuffer(part.data, np.float32).reshape(-1, len(total) - row)
            total[row : row + len(data), row:] += data
        release(sums)
        for i, total in zip(numbers, totals, strict=True):
            bases[i] = _greatest(total)
    if own is not None:
        release(own)
    return [_space(weights, *of) for of in zip(counted, used, bases, strict=True)]


def _item_products(
    targets: list[list[bytes]], used: np.ndarray, weights: np.ndarray
) -> np.ndarray:
    """The upper half of the targets' own A^T A."""
    total = np.zeros((len(used), len(used)), np.float32)
    for words in targets:
        scale = np.array([ITEM_WEIGHT])
        found = _scaled(_terms(words), np.array([len(words)]), scale, weights)
        _add_products(total, used, *found)
    return total


def _greatest(total: np.ndarray) -> np.ndarray:
    """The main directions of A^T A, of which the upper half is given, by subspace iteration."""
    for row in range(1, len(total)):
        total[row, :row] = total[:row, row]
    random = np.random.default_rng(_SEED)
    basis = random.standard_normal((len(total), RANK + EXTRA), np.float32)
    for _ in range(2):
        basis = np.linalg.qr(total @ basis)[0].astype(np.float32)
    inner = basis.T @ (total @ basis)
    strength, rotation = np.linalg.eigh((inner + inner.T) / 2)
    return basis @ rotation[:, np.argsort(-strength)[:RANK]]


def _space(weights: np.ndarray, group: list, used: np.ndarray, basis: np.ndarray) -> LatentSpace:
    place = np.full(TERMS, -1, np.int32)
    place[used] = np.arange(len(used))
    vectors = np.zeros((len(used), len(group)), np.float32)
    for i, (term, times) in enumerate(group):
        vectors[place[term], i] = times * weights[term] / np.sqrt(times @ weights[term] ** 2)
    inside = basis @ (basis.T @ vectors)
    missing = np.linalg.norm(vectors - inside, axis=0).astype(np.float32)
    return LatentSpace(place, (inside * weights[used][:, None]).astype(np.float32), missing)


def _with_next(sums: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sums of passages: of a block and, where ``two`` says so, of the next one."""
    whole = sums.copy()
    whole[:-1][two[:-1]] += sums[1:][two[:-1]]
    return whole


def _block_sums(
    products: np.ndarray, at: np.ndarray, blocks: np.ndarray, count: int
) -> np.ndarray:
    """Sums of the products' rows ``at`` by block; blocks are in order.

    Rank by rank of the terms within their blocks, the fullest blocks first: each step
    adds one row to a slice of them.
    """
    runs = np.flatnonzero(np.diff(blocks, prepend=-1))
    sizes = np.diff(np.append(runs, len(blocks)))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = runs[order], sizes[order]
    found = products[at[starts]]
    for rank in range(1, int(sizes[0])):
        more = int(np.searchsorted(-sizes, -rank, side="left"))  # blocks of more terms
        found[:more] += products[at[starts[:more] + rank]]
    sums = np.zeros((count, products.shape[1]), np.float32)
    sums[blocks[starts]] = found
    return sums


def close(
    weights: np.ndarray,
    spaces: list[LatentSpace],
    terms: np.ndarray,
    starts: np.ndarray,
    after: np.ndarray,
    least: float,
) -> Iterator[tuple[int, int, float]]:
    """(passage, target, cosine in its space) wherever the cosine may be ``least``.

    A passage is a block and, where ``after`` says so, the next one.  No cosine is greater
    than the share of the passage that the targets' terms make up, so only passages with a
    large enough share are projected.  What a space lacks of a target can add to the
    cosine at most its length times the passage's, which is allowed for: whatever the
    space, no pair whose terms have that cosine is passed over.  Nor is a passage projected
    whose terms, each with the target it adds most to, cannot reach ``least``.
    """
    stops, after = np.append(starts[1:], len(terms)), np.append(after, False)
    for low in range(0, len(starts), _BLOCKS_AT_ONCE):
        n = min(_BLOCKS_AT_ONCE, len(starts) - low)
        high = min(low + n + 1, len(starts))  # one more, for the last passage
        two, sizes = after[low:high], stops[low:high] - starts[low:high]
        part = terms[starts[low] : stops[high - 1]]
        block = np.repeat(np.arange(high - low), sizes)
        square = weights[part].astype(np.float64) ** 2
        whole = _with_next(np.bincount(block, square, high - low), two)[:n]
        first = 0
        for space in spaces:
            at = space.place[part]
            mine = np.flatnonzero(at >= 0)
            own = np.bincount(block[mine], square[mine], high - low)
            own = _with_next(own, two)[:n]
            most = np.bincount(block[mine], space.greatest[at[mine]], high - low)
            most = _with_next(most, two)[:n] + np.sqrt(2 * HALF * own) * space.missing.max()
            chosen = np.flatnonzero(
                (own > 0) & (own >= least**2 * whole) & (most >= (least - _ROUNDING) * np.sqrt(whole))
            )
            if len(chosen):
                needed = np.zeros(high - low + 1, bool)
                needed[chosen] = True
                needed[chosen[two[chosen]] + 1] = True
                mine = mine[needed[block[mine]]]
                blocks = block[mine]
                sums = _block_sums(space.products, at[mine], blocks, high - low)
                norms = np.sqrt(whole[chosen])
                cosines = _with_next(sums, two)[chosen] / norms[:, None].astype(np.float32)
                # A term may repeat, which makes a passage longer than its terms are.
                rest = np.sqrt(2 * HALF * own[chosen]) / norms
                hits = np.nonzero(cosines + np.outer(rest, space.missing) >= least)
                passages = (low + chosen[hits[0]]).tolist()
                yield from zip(
                    passages, (first + hits[1]).tolist(), cosines[hits].tolist(), strict=True
                )
            first += len(space.missing)


@dataclass(frozen=True)
class _Item:
    """An item; what its words are looked up in is made where it is first needed."""

    ident: object
    words: list[bytes]

    @cached_property
    def counts(self) -> Counter:
        return Counter(self.words)

    @cached_property
    def blocks(self) -> list[tuple[dict[bytes, int], int]]:
        return _mask_blocks(self.words)

    @cached_property
    def answer(self) -> dict[bytes, int]:
        return _masks(self.words[-ANSWER_WORDS:])


def _masks(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def _mask_blocks(words: list[bytes]) -> list[tuple[dict[bytes, int], int]]:
    """Masks of some words at a time, so that they grow with the words and no faster."""
    parts = (words[at : at + LCS_WORDS] for at in range(0, len(words), LCS_WORDS))
    return [(_masks(part), len(part)) for part in parts]


def common_subsequence(masks: dict[bytes, int], size: int, words: Iterable[bytes]) -> int:
    """Length of the longest common subsequence; a bit for each of the ``size`` words."""
    everything = (1 << size) - 1
    state = everything
    for word in words:
        if match := masks.get(word):
            hit = state & match
            state = ((state + hit) | (state - hit)) & everything
    return size - state.bit_count()


def _common_in_blocks(blocks: list[tuple[dict[bytes, int], int]], words: list[bytes]) -> int:
    """The same over blocks of an item: what one carries at a word, the next one adds."""
    if len(blocks) == 1:
        return common_subsequence(*blocks[0], words)
    common, carried = 0, bytearray(len(words))
    for masks, size in blocks:
        everything = (1 << size) - 1
        state, carries = everything, bytearray(len(words))
        for i, word in enumerate(words):
            hit = state & masks.get(word, 0)
            if hit or carried[i]:
                total = state + hit + carried[i]
                carries[i] = total >> size
                state = (total | (state - hit)) & everything
        common += size - state.bit_count()
        carried = carries
    return common


def common_words(item: list[bytes], words: list[bytes]) -> int:
    """Length of the longest common subsequence."""
    return _common_in_blocks(_mask_blocks(item), words)


def _run_hashes(terms: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of so many terms that lie side by side."""
    found, done = mixed(terms.astype(np.uint64) + np.uint64(1)), 1
    while done < length:
        step = min(done, length - done)
        found = mixed(mixed(found[:-step] if step else found) + found[step:] * np.uint64(3))
        done += step
    return found


@dataclass(frozen=True)
class _Runs:
    """Items by the hashes of their runs of words, for each length of a run."""

    tables: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(items: list[_Item]) -> _Runs:
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for number, item in enumerate(items):
            if len(item.words) >= SHORTEST:
                length = min(len(item.words), RUN)
                hashes = np.unique(_run_hashes(_terms(item.words), length))
                by_length.setdefault(length, []).append((hashes, number))
        tables = []
        for length, found in sorted(by_length.items()):
            hashes = np.concatenate([h for h, _ in found])
            owners = np.concatenate([np.full(len(h), n) for h, n in found])
            order = np.argsort(hashes, kind="stable")
            known, first = np.unique(hashes[order], return_index=True)
            marks = np.zeros(1 << _MARK_BITS, bool)
            marks[known & _MARKS] = True
            tables.append((length, marks, known, np.append(first, len(order)), owners[order]))
        return _Runs(tables)

    def found(self, terms: np.ndarray, texts: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, item) wherever a run of an item may begin within a text."""
        for length, marks, known, first, owners in self.tables:
            if len(terms) < length:
                continue
            hashes = _run_hashes(terms, length)
            places = np.flatnonzero(marks[hashes & _MARKS])
            places = places[texts[places] == texts[places + length - 1]]
            at = np.minimum(np.searchsorted(known, hashes[places]), len(known) - 1)
            same = known[at] == hashes[places]
            for place, own in zip(places[same].tolist(), at[same].tolist(), strict=True):
                for item in owners[first[own] : first[own + 1]].tolist():
                    yield place, item


def _passages(words: list[bytes]) -> list[list[bytes]]:
    """What an item is searched by: the same passages as documents have.

    The last one has more than a block, so every word is in one of some length.
    """
    starts = range(0, max(len(words) - HALF, 1), HALF)
    return [words[start : start + 2 * HALF] for start in starts]


def _count_passages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = (words_of(text) for text in batch["text"].to_pylist())
        yield pa.RecordBatch.from_pydict({"n": [sum(len(_passages(w)) for w in words if w)]})


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row for each document and item found in it: ``ident, item, cosine, common, answer``.

    ``common`` is the share of the item's words that are in the passage in their order,
    ``answer`` that of its last words.  A copy has most of the words; a paraphrase fewer,
    but the answer.  Null or empty texts and items find nothing; an empty table on either
    side gives no rows.  Repeated documents are found as often, repeated items as often.
    Other columns are ignored, whatever their names.  Texts and items of any length are read whole: an
    item is searched by its passages, and compared whole where one of them is found.  Copies
    with ``RUN`` words in a row unchanged are always found, and so are items of ``SHORTEST``
    words or more that are there as they are; ``cosine`` is null where only that led there.
    """
    rows = docs.select(docs[ident].alias("ident"), docs[text].alias("text"))
    items = benchmark.select(benchmark[item].alias("ident"), benchmark[item_text].alias("text"))
    counted = items.select("text").mapInArrow(_count_passages, "n long")
    passages = sum(row.n for row in counted.agg(F.sum("n").alias("n")).collect() if row.n)
    rounds = max(1, -(-passages // PASSAGES_AT_ONCE))
    weights, blocks = term_weights(rows)
    sample = sampled(rows, blocks)
    if rounds > 1:
        sample = stored(sample)
    kinds = [df.schema["ident"].dataType.simpleString() for df in (rows, items)]
    schema = f"ident {kinds[0]}, item {kinds[1]}, cosine double, common double, answer double"
    context = docs.sparkSession.sparkContext
    found = None
    for number in range(rounds):
        part = items.where(F.pmod(F.xxhash64("ident", "text"), F.lit(rounds)) == number)
        some = [
            _Item(row.ident, words)
            for row in part.collect()
            if row.text and (words := words_of(row.text))
        ]
        targets = [(i, words) for i, item in enumerate(some) for words in _passages(item.words)]
        spaces = fit(sample, weights, [words for _, words in targets], fit_tasks(blocks))
        shared = context.broadcast((some, [i for i, _ in targets], weights, spaces, _Runs.of(some)))
        hits = rows.mapInArrow(_search(shared), schema)
        if rounds > 1:  # one round's spaces at a time
            hits = settled(hits)
            shared.destroy()
        found = hits if found is None else found.union(hits)
    if rounds > 1:
        release(sample)
    return found.withColumnsRenamed({"ident": ident, "item": item})


def _search(shared):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, owners, weights, spaces, runs = shared.value
        if not items:
            return
        idents = pa.array([i.ident for i in items])
        for batch in batches:
            for piece in _pieces(batch["text"].to_pylist()):
                hits = list(_hits(items, owners, weights, spaces, runs, *piece))
                if hits:
                    at, which, cosine, common, answer = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["ident"].take(pa.array(at)),
                            idents.take(pa.array(which)),
                            *(pa.array(x, pa.float64()) for x in (cosine, common, answer)),
                        ],
                        ["ident", "item", "cosine", "common", "answer"],
                    )

    return search


def _hits(
    items: list[_Item],
    owners: list[int],
    weights: np.ndarray,
    spaces: list[LatentSpace],
    runs: _Runs,
    piece: list[tuple[int, bytes]],
    terms: np.ndarray,
    lengths: np.ndarray,
) -> Iterator:
    """(row, item's number, cosine, common, answer) of what is found in some texts."""
    starts, texts, numbers = _block_starts(lengths)
    candidates: dict[tuple[int, int], list[tuple[float | None, int]]] = {}
    for block, target, cosine in close(
        weights, spaces, terms, starts, texts[1:] == texts[:-1], COSINE
    ):
        key = int(texts[block]), owners[target]
        candidates.setdefault(key, []).append((cosine, int(numbers[block])))
    begins = np.cumsum(lengths) - lengths
    seen_runs = set()
    for place, number in runs.found(terms, np.repeat(np.arange(len(piece)), lengths)):
        text = int(np.searchsorted(begins, place, side="right")) - 1
        run = text, number, (place - int(begins[text])) // HALF
        if run not in seen_runs:
            seen_runs.add(run)
            candidates.setdefault(run[:2], []).append((None, run[2]))
    regions: dict[tuple[int, int, int], set[bytes]] = {}
    split: dict[int, list[bytes]] = {}
    for (text, number), places in candidates.items():
        item, (row, plain) = items[number], piece[text]
        if text not in split:
            split[text] = plain.split()
        words = split[text]
        size, tail = len(item.words), min(len(item.words), ANSWER_WORDS)
        best, seen = (0.0, 0.0), set()
        for _, block in places:
            reach = -(-size // HALF)  # blocks around the passage that the item may be in
            # The places of a long item are many: nearby ones share a region.
            step = max(1, reach // 4)
            block -= block % step
            low, high = max(0, block - reach) * HALF, (block + step + 1 + reach) * HALF
            if (low, high) in seen:
                continue
            seen.add((low, high))
            if (here := (text, low, high)) not in regions:
                regions[here] = set(words[low:high])
            # Words that are not there at all cannot be there in order.
            there = item.counts.keys() & regions[here]
            if sum(item.counts[word] for word in there) < PARAPHRASE * size:
                continue
            common = _common_in_blocks(item.blocks, words[low:high]) / size
            answer = common_subsequence(item.answer, tail, words[low:high]) / tail
            best = max(best, (common, answer))
        if best[0] >= COPY or best[0] >= PARAPHRASE and best[1] >= ANSWER:
            cosines = (cosine for cosine, _ in places if cosine is not None)
            yield row, number, max(cosines, default=None), *best
