"""Delimited cells on Arrow arrays, for functions that SQL calls with any delimiter.

The rules are those of ``codes``, where built-in functions do the same.  Work is per
distinct cell and per distinct code of a batch; what is said of patterns and numbers is how
the JVM reads them, since job descriptions are written for it.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: characters that count as blank at the ends of a cell.
BLANKS = "".join(map(chr, range(33)))
_PLAIN_MARKS = set("\\.^$|?*+()[]{}")
# Escapes of the JVM's patterns that Python lacks, as what they stand for.
_ESCAPES = {
    "h": r"[ \t\xA0\u1680\u180e\u2000-\u200a\u202f\u205f\u3000]",
    "H": r"[^ \t\xA0\u1680\u180e\u2000-\u200a\u202f\u205f\u3000]",
    "v": r"[\n\x0B\f\r\x85\u2028\u2029]",
    "V": r"[^\n\x0B\f\r\x85\u2028\u2029]",
    "R": r"(?:\r\n|[\n\x0B\f\r\x85\u2028\u2029])",
    "e": r"\x1B",
    "z": r"\Z",
    "Z": r"(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\Z)",
}
_CLASSES = {
    "Lower": "a-z",
    "Upper": "A-Z",
    "ASCII": r"\x00-\x7F",
    "Alpha": "a-zA-Z",
    "Digit": "0-9",
    "Alnum": "a-zA-Z0-9",
    "Punct": r"!-/:-@\[-`{-~",
    "Graph": "!-~",
    "Print": " -~",
    "Blank": r" \t",
    "Cntrl": r"\x00-\x1F\x7F",
    "XDigit": "0-9a-fA-F",
    "Space": r" \t\n\x0B\f\r",
}
_NUMBER = re.compile(
    r"[\x00-\x20]*([+-]?(?:NaN|Infinity"
    r"|((?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[fFdD]?"
    r"|(0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?))[\x00-\x20]*"
)
_LONG_MIN, _LONG_MAX = -(1 << 63), (1 << 63) - 1


class PatternError(ValueError):
    """A delimiter that cannot be read as a pattern."""


def _translated(pattern: str) -> str:
    """A pattern of the JVM as one of Python; what has no counterpart is an error."""
    out, i, in_class = [], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            if i + 1 >= len(pattern):
                raise PatternError(f"the pattern ends in a backslash: {pattern}")
            name = pattern[i + 1]
            i += 2
            if name == "Q":
                stop = pattern.find("\\E", i)
                stop = len(pattern) if stop < 0 else stop
                out.append(re.escape(pattern[i:stop]))
                i = stop + 2
            elif name in "pP":
                group = re.match(r"\{(\w+)\}", pattern[i:])
                if group is None or group[1] not in _CLASSES:
                    raise PatternError(f"the pattern's class \\{name} is not supported: {pattern}")
                inside = _CLASSES[group[1]]
                if in_class and name == "P":
                    raise PatternError(f"\\P within a class is not supported: {pattern}")
                out.append(inside if in_class else f"[{'^' if name == 'P' else ''}{inside}]")
                i += group.end()
            elif name in _ESCAPES:
                text = _ESCAPES[name]
                if in_class and (name in "HVRzZ"):
                    raise PatternError(f"\\{name} within a class is not supported: {pattern}")
                out.append(text[1:-1] if in_class and text[0] == "[" else text)
            elif name in "GXNk":
                raise PatternError(f"the pattern's \\{name} is not supported: {pattern}")
            else:
                out.append("\\" + name)
            continue
        if in_class:
            if c == "[" or pattern.startswith("&&", i):
                raise PatternError(f"a class within a class is not supported: {pattern}")
            # A closing bracket that comes first stands for itself.
            if c == "]" and i > in_class:
                in_class = 0
        elif c == "[":
            in_class = i + (2 if pattern.startswith("^", i + 1) else 1)
        elif pattern.startswith("(?<", i) and pattern[i + 3 : i + 4] not in ("=", "!", ""):
            out.append("(?P<")
            i += 3
            continue
        out.append(c)
        i += 1
    return "".join(out)


def _literal(pattern: str) -> str | None:
    """The text that a pattern stands for, if it is no more than that."""
    if len(pattern) == 2 and pattern[0] == "\\" and not pattern[1].isalnum():
        return pattern[1]
    return pattern if pattern and not _PLAIN_MARKS & set(pattern) else None


@functools.lru_cache(maxsize=256)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The function that splits a text on a pattern and keeps all parts."""
    text = _literal(pattern)
    if text is not None:
        return lambda value: value.split(text)
    try:
        # Classes such as \d and \s hold ASCII only, as in the JVM.
        found = re.compile(_translated(pattern), re.ASCII)
    except re.error as error:
        raise PatternError(f"no pattern: {pattern}: {error}") from error

    def split(value: str) -> list[str]:
        parts, start, place = [], 0, 0
        while place <= len(value) and (match := found.search(value, place)):
            # After an empty match the search goes on one character further.
            place = match.end() + (match.start() == match.end())
            if match.end() > 0:  # nothing at the very beginning is no delimiter
                parts.append(value[start : match.start()])
                start = match.end()
        return [*parts, value[start:]] if parts else [value]

    return split


def cell_parts(cells: pa.Array, pattern: str) -> pa.ListArray:
    """The parts of cells that are not null."""
    text = _literal(pattern)
    if text is not None:
        return pc.split_pattern(cells, text)
    split = splitter(pattern)
    return pa.array([split(cell) for cell in cells.to_pylist()], pa.list_(pa.string()))


def cell_codes(cells: pa.Array, pattern: str) -> pa.ListArray:
    """The parts without a blank first and a blank last one; a lone part stays."""
    parts = cell_parts(cells, pattern)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    values = parts.values
    low, high = offsets[:-1], offsets[1:]
    several = high - low > 1

    def blank(at: np.ndarray) -> np.ndarray:
        chosen = values.take(pa.array(at[several]))
        found = np.zeros(len(at), bool)
        empty = pc.equal(pc.utf8_length(pc.utf8_trim(chosen, characters=BLANKS)), 0)
        found[several] = empty.to_numpy(zero_copy_only=False)
        return found

    kept = np.ones(len(values), bool)
    first, last = blank(low), blank(high - 1)
    kept[low[first]] = False
    kept[high[last] - 1] = False
    lengths = high - low - first - last
    lengths = np.where(several, np.maximum(lengths, 0), high - low)
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values.filter(pa.array(kept)))


def id_key(code: str) -> int | None:
    """A code as a number: read as a double, cut towards zero, saturating; None if it is
    no number."""
    if code.isdigit() and len(code) <= 15 and code.isascii():
        return int(code)
    match = _NUMBER.fullmatch(code)
    if match is None:
        return None
    text, _, hexadecimal = match.groups()
    if text.endswith("NaN"):
        return 0
    if hexadecimal:
        sign = -1.0 if text[0] == "-" else 1.0
        try:
            value = sign * float.fromhex(hexadecimal)
        except OverflowError:
            value = sign * math.inf
    else:
        value = float(text if text.endswith("Infinity") else text.rstrip("fFdD"))
    if math.isinf(value) or not _LONG_MIN < value < _LONG_MAX:
        return _LONG_MAX if value > 0 else _LONG_MIN
    return int(value)


def code_keys(codes: pa.Array, kind: str) -> pa.Array:
    """The lookup keys of codes: numbers for ``id``, exact text for ``user``."""
    if kind == "user":
        return codes
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    coded = codes.dictionary_encode()
    texts = coded.dictionary
    # Short runs of digits, the common case, are read together.
    digits = pc.match_substring_regex(texts, r"\A[0-9]{1,15}\z")
    keys = pc.if_else(digits, texts, pa.scalar(None, texts.type)).cast(pa.int64())
    others = pc.invert(digits)
    if pc.any(others).as_py():
        read = [id_key(code) for code in texts.filter(others).to_pylist()]
        keys = pc.replace_with_mask(keys, others, pa.array(read, pa.int64()))
    return keys.take(coded.indices)


def as_text(values: pa.Array) -> pa.Array:
    """Values as the text that Spark casts them to."""
    kind = values.type
    if pa.types.is_string(kind):
        return values
    if pa.types.is_null(kind) or pa.types.is_large_string(kind) or pa.types.is_integer(kind):
        return values.cast(pa.string())
    if pa.types.is_boolean(kind) or pa.types.is_date(kind):
        return values.cast(pa.string())
    if pa.types.is_decimal(kind):
        return pa.array([None if x is None else f"{x:f}" for x in values.to_pylist()], pa.string())
    if pa.types.is_float64(kind) or pa.types.is_float32(kind):
        numbers = values.to_numpy(zero_copy_only=False)
        texts = [_double_text(x) for x in numbers]
        return pa.array(texts, pa.string(), mask=~values.is_valid().to_numpy(zero_copy_only=False))
    raise TypeError(f"a {kind} cell is not text; cast it to STRING")


def _double_text(number: np.floating) -> str:
    """The shortest digits that give the number back, written as the JVM does."""
    if np.isnan(number):
        return "NaN"
    if np.isinf(number):
        return "Infinity" if number > 0 else "-Infinity"
    if number == 0:
        return "-0.0" if np.signbit(number) else "0.0"
    if 1e-3 <= abs(number) < 1e7:
        return np.format_float_positional(number, unique=True, trim="0")
    text = np.format_float_scientific(number, unique=True, trim="0", exp_digits=1)
    return text.replace("e+", "E").replace("e", "E")
