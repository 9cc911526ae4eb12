"""Elements of JSON documents that are too large to be read as a whole.

A document's text is walked once; what lies beside the path is passed over unread, and an
array's elements are given out one by one, as the text that they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa

# About so many characters of elements leave together.
_TOGETHER = 1 << 22

_BLANK = re.compile(r"[ \t\n\r]*")
_STRING = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.S)
_MARK = re.compile(r'"(?:[^"\\]++|\\.)*+"|[\[\]{}]', re.S)
_SCALAR = re.compile(r"[^\s,\]}\[{:\"]+")
_STARTS = set('{["-0123456789tfn')
_STEP = re.compile(r"""\.?(?P<name>[^.\[\]'"]+)|\[(?P<place>\d+)\]|\[(?P<quote>['"])(?P<key>.*?)(?P=quote)\]""")


class JsonError(ValueError):
    """A document or a path that cannot be read."""


def path_steps(path: str) -> list[str | int]:
    """The names and places of a path such as ``$.a[0].b`` or ``$['a b']``."""
    rest, steps = path.removeprefix("$"), []
    while rest:
        step = _STEP.match(rest)
        if step is None:
            raise JsonError(f"no path: {path}")
        place, name = step["place"], step["name"]
        steps.append(int(place) if place is not None else name if name is not None else step["key"])
        rest = rest[step.end() :]
    return steps


def _start(text: str, at: int) -> int:
    at = _BLANK.match(text, at).end()
    if at >= len(text):
        raise JsonError("not JSON: the document ends too early")
    return at


def _end(text: str, at: int) -> int:
    """Where the value that begins at ``at`` ends."""
    if text[at] in "{[":
        depth = 0
        for mark in _MARK.finditer(text, at):
            if text[mark.start()] in "{[":
                depth += 1
            elif text[mark.start()] in "}]":
                depth -= 1
                if not depth:
                    return mark.end()
        raise JsonError("not JSON: a bracket is not closed")
    found = (_STRING if text[at] == '"' else _SCALAR).match(text, at)
    if found is None:
        raise JsonError(f"not JSON: character {at}")
    return found.end()


def _members(text: str, at: int) -> Iterator[tuple[str | int, int, int]]:
    """(name or place, start, end) of the members of the object or array at ``at``."""
    array, close = text[at] == "[", "]" if text[at] == "[" else "}"
    at, place = _start(text, at + 1), 0
    if text[at] == close:
        return
    while True:
        name: str | int = place
        if not array:
            stop = _end(text, at)
            name = json.loads(text[at:stop])
            at = _start(text, stop)
            if text[at] != ":":
                raise JsonError(f"not JSON: character {at}")
            at = _start(text, at + 1)
        stop = _end(text, at)
        yield name, at, stop
        at, place = _start(text, stop), place + 1
        if text[at] == close:
            return
        if text[at] != ",":
            raise JsonError(f"not JSON: character {at}")
        at = _start(text, at + 1)


def pieces(text: str, steps: list[str | int]) -> Iterator[tuple[str, bool]]:
    """(text, whether it is an array's element) of what lies at the path.

    Of a name that an object has twice the first counts; nothing there gives nothing.
    """
    at = _start(text, 0)
    for step in steps:
        if text[at] != ("[" if isinstance(step, int) else "{"):
            if text[at] not in _STARTS:
                raise JsonError(f"not JSON: character {at}")
            return
        found = next((start for name, start, _ in _members(text, at) if name == step), None)
        if found is None:
            return
        at = found
    if text[at] == "[":
        for _, start, stop in _members(text, at):
            yield text[start:stop], True
    else:
        yield text[at : _end(text, at)], False


def split_documents(column: str, path: str, names: list[str]):
    """Rows of ``names``, with a document in ``column``, to one row for each piece of it."""
    steps = path_steps(path)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [batch[name] for name in names]
            for row in range(len(batch)):
                held, size = [], 0
                for piece in pieces(batch[column][row].as_py(), steps):
                    held.append(piece)
                    size += len(piece[0])
                    if size >= _TOGETHER:
                        yield made(others, row, held)
                        held, size = [], 0
                if held:
                    yield made(others, row, held)

    def made(others: list[pa.Array], row: int, held: list[tuple[str, bool]]) -> pa.RecordBatch:
        same = pa.array([row] * len(held))
        texts, inside = zip(*held, strict=True)
        columns = [*(c.take(same) for c in others), pa.array(texts), pa.array(inside)]
        return pa.RecordBatch.from_arrays(columns, [*names, "__piece", "__inside"])

    return split
