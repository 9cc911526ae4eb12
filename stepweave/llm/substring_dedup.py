"""Remove words of long passages that occur more than once.

Difference-cover anchors: in a document only the short windows at the positions of a
cover modulo its period are hashed.  The cover has every difference, so of any two equal
long windows some aligned pair of short ones is hashed; a long window without a shared
anchor in it cannot be repeated.  Around the shared anchors the match is extended to
whole windows, which are compared in turn.

Both comparisons count: a hash that occurs twice marks its places, without forming pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.llm.common import (
    BROADCAST_ROWS,
    PIECE_BYTES,
    WindowHasher,
    byte_texts,
    in_pieces,
    mixed,
    release,
    settled,
)

#: Words of a window.
WINDOW = 35
#: The windows of about so many bytes of texts are compared at once.
BUCKET_BYTES = 8 << 20
# Perfect difference covers, by period.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
#: An anchor has at least this share of a window's words.
LEAST_ANCHOR = 0.4
_SEGMENT_WORDS = 100_000
# Hashes are first compared among the texts of about so many bytes.
_TOGETHER_BYTES = 8 << 20
# Places are shuffled in packets: per bucket of hashes the hashes (64 and 16 bits), the
# texts' keys, how many places each text has, and the positions in two halves.
_PACKET = (
    "bucket int, h1 binary, h2 binary, k1 binary, k2 binary, counts binary, low binary, "
    "high binary"
)
_NAMES = ["bucket", "h1", "h2", "k1", "k2", "counts", "low", "high"]
_KINDS = ["u8", "u2", "u2", "u8", "u4", "u2", "u2"]
# Places go back to their texts in packets too, without hashes.
_PLACES = "bucket int, k1 binary, k2 binary, counts binary, low binary, high binary"
_FOUND = "k1 int, k2 long, positions array<int>"


def cover_for(window: int) -> tuple[int, np.ndarray]:
    """The longest period whose anchors are long enough, and its cover as a table."""
    period = max(p for p in COVERS if p == 1 or window - p + 1 >= LEAST_ANCHOR * window)
    table = np.zeros(period, bool)
    table[list(COVERS[period])] = True
    return period, table


def _segments(rows: Iterable[tuple[int, list[bytes]]], overlap: int) -> Iterator[tuple]:
    """(row, words, first word's number, how many window starts are its own)."""
    for row, words in rows:
        for start in range(0, len(words), _SEGMENT_WORDS):
            part = words[start : start + _SEGMENT_WORDS + overlap]
            yield row, part, start, min(_SEGMENT_WORDS, len(words) - start)


def _hashed(rows: Iterable[tuple[int, list[bytes]]], length: int, hashers, wanted) -> Iterator:
    """Rows, positions and hashes of the windows of ``length`` words that are wanted.

    ``wanted(row, positions)`` says which positions of a row's text are.
    """

    def size(item: tuple) -> int:
        return sum(map(len, item[1])) + len(item[1])

    for piece in in_pieces(_segments(rows, length - 1), size, PIECE_BYTES):
        words = [word for item in piece for word in item[1]]
        lengths = np.array([len(item[1]) for item in piece])
        begins = np.cumsum(lengths) - lengths
        firsts, owners, positions = [], [], []
        for begin, n, (row, _, start, own) in zip(begins, lengths, piece, strict=True):
            at = np.arange(min(own, max(0, n - length + 1)))
            at = at[wanted(row, at + start)]
            firsts.append(at + begin)
            positions.append(at + start)
            owners.append(np.full(len(at), row))
        first = np.concatenate(firsts)
        if len(first):
            hashes = [hasher.load(words).windows(first, length) for hasher in hashers]
            yield np.concatenate(owners), np.concatenate(positions), hashes


def _packets(batch: pa.RecordBatch, found: list, buckets: int) -> pa.RecordBatch | None:
    """Windows to be compared, in packets by their hash.

    A hash that occurs twice here is known to be repeated: its places go without it to
    any bucket, and the hash alone goes to its own to tell the others.
    """
    if not found:
        return None
    owners, positions = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    h1 = np.concatenate([f[2][0] for f in found])
    h2 = np.zeros(len(h1), np.uint16)  # anchors have none
    if len(found[0][2]) > 1:
        h2 = (np.concatenate([f[2][1] for f in found]) & np.uint64(0xFFFF)).astype(np.uint16)
    k1, k2 = (batch[name].to_numpy() for name in ("k1", "k2"))
    order = np.lexsort((h2, h1))
    same = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    known = np.zeros(len(h1), bool)
    known[order[1:]] = same
    known[order[:-1]] |= same
    witness = order[np.append(True, ~same) & known[order]]
    rows: list[tuple] = []

    def deal(chosen: np.ndarray, bucket: np.ndarray, hashes: bool, places: bool) -> None:
        """Packets of the chosen windows, with their hashes, their places or both."""
        chosen = chosen[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket)
        if not len(chosen):
            return
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for start, stop in zip(starts, [*starts[1:], len(bucket)], strict=True):
            part = chosen[start:stop]
            hash_part = part if hashes else part[:0]
            part = part if places else part[:0]
            text = owners[part]
            first = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(part) else part
            columns = (
                h1[hash_part],
                h2[hash_part],
                (k1[text[first]] & 0xFFFF).astype(np.uint16),
                k2[text[first]],
                np.diff(np.append(first, len(part))).astype(np.uint32),
                (positions[part] & 0xFFFF).astype(np.uint16),
                (positions[part] >> 16).astype(np.uint16),
            )
            rows.append((int(bucket[start]), *(c.tobytes() for c in columns)))

    def of(windows: np.ndarray) -> np.ndarray:
        return (h1[windows] % np.uint64(buckets)).astype(np.int64)

    alone, settled_here = np.flatnonzero(~known), np.flatnonzero(known)
    deal(alone, of(alone), True, True)
    deal(witness, of(witness), True, False)
    home = _home(k1, k2, buckets)
    deal(settled_here, home[owners[settled_here]], False, True)
    columns = zip(*rows, strict=True)
    kinds = [pa.int32()] + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], _NAMES
    )


def _home(k1: np.ndarray, k2: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each text; copies of one text have different ones."""
    both = k2.astype(np.uint64) ^ (k1.astype(np.uint64) << np.uint64(32))
    return (mixed(both) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The packets of one bucket at a time, of packets in the order of their buckets."""
    bucket, held = None, []
    for batch in batches:
        for packet in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if packet[0] != bucket:
                if held:
                    yield held
                bucket, held = packet[0], []
            held.append(packet[1:])
    if held:
        yield held


def _repeated(buckets: int):
    """Of packets in the order of their buckets, the places whose hash comes twice."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packets in _by_bucket(batches):
            yield _twice(packets, buckets)

    return compare


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's places together, from packets in the order of their buckets."""
    for packets in _by_bucket(batches):
        k1, k2, counts, low, high = (
            np.concatenate([np.frombuffer(packet[i], kind) for packet in packets])
            for i, kind in enumerate(_KINDS[2:])
        )
        k1, k2 = np.repeat(k1, counts), np.repeat(k2, counts)
        position = low.astype(np.int32) + (high.astype(np.int32) << 16)
        order = np.lexsort((position, k2, k1))
        k1, k2, position = k1[order], k2[order], position[order]
        text = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        fresh = text | np.append(True, position[1:] != position[:-1])
        k1, k2, position, text = (column[fresh] for column in (k1, k2, position, text))
        first = np.flatnonzero(text)
        offsets = pa.array(np.append(first, len(position)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(k1[first].astype(np.int32)),
                pa.array(k2[first].view(np.int64)),
                pa.ListArray.from_arrays(offsets, pa.array(position)),
            ],
            ["k1", "k2", "positions"],
        )


def _twice(packets: list[tuple], buckets: int) -> pa.RecordBatch:
    places, keys, hashes = [], [], []
    texts = 0
    for packet in packets:
        h1, h2, k1, k2, counts, low, high = (
            np.frombuffer(data, kind) for data, kind in zip(packet, _KINDS, strict=True)
        )
        position = low.astype(np.int32) + (high.astype(np.int32) << 16)
        owner = np.repeat(np.arange(len(k2)), counts) + texts
        texts += len(k2)
        keys.append((k1, k2))
        if len(h1) and len(owner):  # to be compared
            hashes.append((h1, h2, owner, position))
        elif len(h1):  # known to be repeated
            hashes.append((h1, h2, np.full(len(h1), -1), np.zeros(len(h1), np.int32)))
        else:
            places.append((owner, position))
    if hashes:
        h1, h2, owner, position = (np.concatenate(c) for c in zip(*hashes, strict=True))
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
        twice = np.zeros(len(order), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        twice &= owner >= 0
        places.append((owner[twice], position[twice]))
    owner, position = (np.concatenate(c) for c in zip(*places, strict=True))
    k1, k2 = (np.concatenate(c) for c in zip(*keys, strict=True))
    home = _home(k1, k2, buckets)[owner]
    order = np.lexsort((owner, home))
    owner, position, home = owner[order], position[order], home[order]
    rows = []
    for bucket in np.unique(home):
        start, stop = np.searchsorted(home, [bucket, bucket + 1])
        text, at = owner[start:stop], position[start:stop]
        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        columns = (
            k1[text[first]],
            k2[text[first]],
            np.diff(np.append(first, len(text))).astype(np.uint32),
            (at & 0xFFFF).astype(np.uint16),
            (at >> 16).astype(np.uint16),
        )
        rows.append((int(bucket), *(c.tobytes() for c in columns)))
    kinds = [pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
        ["bucket", "k1", "k2", "counts", "low", "high"],
    )


def _buckets(texts: DataFrame) -> int:
    """So many that a bucket holds the windows of a bounded part of the texts.

    A task has one bucket in memory, so its need does not grow with the corpus.
    """
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(least, -(-size // BUCKET_BYTES))


def _by_text(texts: DataFrame, find, window: int, buckets: int) -> DataFrame:
    """``k1, k2, positions`` of the windows that ``find`` chooses and that are repeated."""
    packets = texts.mapInArrow(find(window, buckets), _PACKET)
    dealt = packets.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    places = dealt.mapInArrow(_repeated(buckets), _PLACES)
    home = places.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return settled(home.mapInArrow(_gathered, _FOUND))


def _anchors(window: int, buckets: int):
    period, cover = cover_for(window)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WindowHasher(1)

        def wanted(_, positions):
            return cover[positions % period]

        for batch in batches:
            for rows in _long_enough(batch, window):
                found = list(_hashed(rows, window - period + 1, [hasher], wanted))
                if packets := _packets(batch, found, buckets):
                    yield packets

    return find


def _windows(window: int, buckets: int):
    period, _ = cover_for(window)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = [WindowHasher(2), WindowHasher(3)]
        for batch in batches:
            for rows in _long_enough(batch, window):
                marks = {}
                for row, words in rows:
                    # Windows with a shared anchor in them.
                    shared = np.asarray(batch["positions"][row].values)
                    starts = np.maximum(shared - period + 1, 0)
                    marks[row] = _covered(starts, shared + 1, len(words))

                def wanted(row, positions, marks=marks):
                    return marks[row][positions]

                found = list(_hashed(rows, window, hashers, wanted))
                if packets := _packets(batch, found, buckets):
                    yield packets

    return find


def _covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` numbers lie in one of the ranges."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.minimum(starts, n), 1)
    np.add.at(change, np.minimum(stops, n), -1)
    return np.cumsum(change[:-1]) > 0


def _long_enough(batch: pa.RecordBatch, window: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(row, words) of the texts with a whole window, some texts at a time."""
    texts = ((row, text) for row, text in enumerate(byte_texts(batch["text"])) if text)
    for piece in in_pieces(texts, lambda item: len(item[1]), _TOGETHER_BYTES):
        split = ((row, text.split()) for row, text in piece)
        if rows := [(row, words) for row, words in split if len(words) >= window]:
            yield rows


def _without(window: int):
    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, words, gone = [], [], []
            for text, places in zip(byte_texts(batch["text"]), batch["positions"], strict=True):
                tokens = text.split() if text else []
                n = len(tokens)
                if places.is_valid:
                    starts = np.asarray(places.values)
                    covered = _covered(starts, starts + window, n)
                    tokens = [t for t, out in zip(tokens, covered.tolist(), strict=True) if not out]
                kept.append(b" ".join(tokens))
                words.append(n)
                gone.append(n - len(tokens))
            texts = pa.array(kept, pa.binary()).cast(pa.string())
            counts = [pa.array(c, pa.int64()) for c in (words, gone)]
            yield pa.RecordBatch.from_arrays(
                [batch["ident"], texts, *counts], ["ident", "text", "n_words", "n_removed"]
            )

    return remove


def remove_repeats(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row: ``ident``, ``text`` (kept words, joined by a space), ``n_words``, ``n_removed``.

    Words are what ASCII white space separates; a null text has none.  A word goes if a
    window of ``window`` words of its own text covers it whose words also start anywhere
    else, in another row or in the same text; windows are judged on the input.  Repeated
    rows repeat each other.  Identifiers may be null; other columns are ignored, whatever
    their names.  Texts of any length are read whole, in segments.
    """
    number = isinstance(docs.schema[ident].dataType, T.IntegralType)
    first = docs[ident].cast("long") if number else F.xxhash64(docs[ident])
    first = F.pmod(F.coalesce(first, F.lit(0)), F.lit(1 << 16)).cast("int")
    # Rows that share both keys have the same text (80 bits) and so the same repeats.
    keyed = docs.select(
        docs[ident].alias("ident"),
        first.alias("k1"),
        F.xxhash64(docs[text]).alias("k2"),
        docs[text].alias("text"),
    )
    texts = keyed.select("k1", "k2", "text")
    buckets = _buckets(texts)
    shared = _by_text(texts, _anchors, window, buckets)
    marked = _of_few(texts, shared, "left_semi").join(shared, ["k1", "k2"])
    repeats = _by_text(marked, _windows, window, buckets)
    release(shared)
    alone = _of_few(keyed, repeats, "left_anti")
    touched = _of_few(keyed, repeats, "left_semi")
    if alone is keyed:  # too many texts to tell them apart before the join
        told = keyed.join(repeats, ["k1", "k2"], "left").select("ident", "text", "positions")
    else:
        none = F.lit(None).cast("array<int>").alias("positions")
        told = alone.select("ident", "text", none).union(
            touched.join(repeats, ["k1", "k2"]).select("ident", "text", "positions")
        )
    kind = keyed.schema["ident"].dataType.simpleString()
    schema = f"ident {kind}, text string, n_words long, n_removed long"
    return told.mapInArrow(_without(window), schema).withColumnsRenamed(
        {"ident": ident, "text": text}
    )


def _of_few(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Texts that are (not) among those found, if these are few enough to be broadcast."""
    keys = found.select("k1", "k2")
    if keys.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return texts
    return texts.join(F.broadcast(keys), ["k1", "k2"], how)
