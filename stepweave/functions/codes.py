"""SQL expressions that take a delimited cell apart into lookup keys.

All of it stays in built-in functions, in three stages: ``parts`` splits a cell,
``codes`` drops blank ends, and ``keys`` reads the codes as keys.  The arguments are
SQL text (a column, a parameter or a literal), so the same expressions serve the
DataFrame operators and the SQL-callable functions.  Each stage is to be a column of
its own: the next one names it several times, and Spark then computes it once.
"""

from __future__ import annotations

# Blank means nothing but characters up to U+0020; a numeric key
# starts like a decimal, hexadecimal or special floating-point literal.  A short
# run of digits is the common case and is the same as BIGINT and through DOUBLE.
BLANK = r"RLIKE r'^[\x00-\x20]*$'"
NUMERIC = r"RLIKE r'^[\x00-\x20]*[+-]?(NaN|Infinity|[0-9.])'"
DIGITS = r"RLIKE r'^[0-9]{1,15}(,[0-9]{1,15})*\z'"
LONG_MIN = "-9223372036854775807L - 1L"
LONG_MAX = "9223372036854775807L"


def _blank(text: str) -> str:
    """Whether ``text`` is blank; the cheap tests settle most cases."""
    return f"({text} = '' OR (ascii({text}) <= 32 AND {text} {BLANK}))"


def parts(value: str, delimiter: str) -> str:
    """The parts of a cell: split on a regular expression, trailing parts kept.

    An empty delimiter splits characters and leaves an empty part at the end.  A
    null delimiter is an error where there is a cell to split.
    """
    checked = f"coalesce({delimiter}, raise_error('Error: the split delimiter is null'))"
    return (
        f"CASE WHEN {delimiter} = '' AND {value} <> '' "
        f"THEN concat(split({value}, '', -1), array('')) "
        f"WHEN {value} IS NOT NULL THEN split({value}, {checked}, -1) END"
    )


def codes(parts: str) -> str:
    """The parts without a blank first and a blank last one; a lone part stays."""
    first = f"CAST({_blank(f'{parts}[0]')} AS INT)"
    last = f"CAST({_blank(f'element_at({parts}, -1)')} AS INT)"
    return (
        f"CASE WHEN size({parts}) < 2 THEN {parts} "
        f"ELSE slice({parts}, 1 + {first}, size({parts}) - {first} - {last}) END"
    )


def id_keys(codes: str) -> str:
    """The codes as BIGINT keys: read as a double, cut towards zero, saturating.

    A cell of short runs of digits is cast as a whole, unless a code has the joining
    comma inside.  Otherwise what is no number becomes null, which matches no key;
    the pattern keeps text away from the cast, where every failure would cost an
    exception.
    """
    # Each code is read once; what is made of its number is a step of its own.
    numbers = f"transform({codes}, p -> CASE WHEN p {NUMERIC} THEN try_cast(p AS DOUBLE) END)"
    return (
        f"coalesce(CASE WHEN array_join({codes}, ',') {DIGITS} "
        f"THEN try_cast({codes} AS ARRAY<BIGINT>) END, "
        f"transform({numbers}, x -> CASE WHEN isnan(x) THEN 0L "
        f"WHEN x >= 9223372036854775808D THEN {LONG_MAX} "
        f"WHEN x <= -9223372036854775808D THEN {LONG_MIN} "
        "ELSE CAST(x AS BIGINT) END))"
    )


def keys(kind: str, codes: str) -> str:
    """The lookup keys of the codes: numbers for ``id``, exact text for ``user``."""
    return id_keys(codes) if kind == "id" else codes


def joined(labels: str, separator: str, missing: str) -> str:
    """Labels as one string; a null label becomes ``missing``, or the text ``null``."""
    return (
        f"array_join(transform({labels}, v -> coalesce(v, {missing}, 'null')), "
        f"coalesce({separator}, 'null'))"
    )
