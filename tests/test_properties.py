"""The decoding forms against each other and against a plain restatement of the rules."""

import math
import re

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stepweave.functions import cells as arrow_cells
from stepweave.operators import lookups as L

IDS = {0: "zero", 1: "A", 2: "B", 12: "C", -3: "D", 9223372036854775807: "max"}
USERS = {"a": "A", "B": "b", " a": "spaced", "1": "one"}
CONTROL = "".join(map(chr, range(33)))
DECIMAL = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?", re.ASCII)


def _long(text):
    """The BIGINT that a code stands for, or None."""
    text = text.strip(CONTROL)
    if re.fullmatch(r"[+-]?NaN", text):
        return 0
    if re.fullmatch(r"[+-]?Infinity", text):
        number = -math.inf if text[0] == "-" else math.inf
    elif DECIMAL.fullmatch(text):
        number = float(text.rstrip("fFdD"))
    else:
        return None
    if math.isinf(number):
        return 2**63 - 1 if number > 0 else -(2**63)
    return max(min(int(number), 2**63 - 1), -(2**63))


def _expected(cell, kind):
    if cell is None:
        return None
    parts = cell.split(",")
    if len(parts) > 1:
        drop_first, drop_last = not parts[0].strip(CONTROL), not parts[-1].strip(CONTROL)
        parts = parts[drop_first : len(parts) - drop_last]
    found = [IDS.get(_long(p)) if kind == "id" else USERS.get(p) for p in parts]
    return ";".join("NA" if f is None else f for f in found)


CODES = st.one_of(
    st.sampled_from(["", " ", "\t", "1", "2", " 12 ", "1.9", "-3.2", "a", "B", " a", "x", "NaN"]),
    st.sampled_from(["1e0", "0x", "1d", "1f", ".5", "1.", "-", "+", "+1", "1_0", "nan", "1e30"]),
    st.text(alphabet="01.eE+- aBdfInityNx\t", max_size=6),
    st.integers(-(2**65), 2**65).map(str),
)
CELLS = st.one_of(st.none(), st.lists(CODES, min_size=1, max_size=5).map(",".join))


@pytest.fixture(scope="module")
def tables(spark):
    ids = spark.createDataFrame(list(IDS.items()), "k bigint, v string")
    users = spark.createDataFrame(list(USERS.items()), "k string, v string")
    built = {}
    for kind, df in (("id", ids), ("user", users)):
        for form in ("broadcast", "sharded", "joined"):
            built[kind, form] = L.lookup_from(df, kind, kind, way=form)
    return built


@pytest.mark.parametrize("kind", ["id", "user"])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(cells=st.lists(CELLS, min_size=30, max_size=120))
def test_forms_follow_the_rules(spark, tables, kind, cells):
    df = spark.createDataFrame(list(enumerate(cells)), "i int, cell string")
    expected = {i: _expected(cell, kind) for i, cell in enumerate(cells)}
    way = L.lookup_by_id if kind == "id" else L.lookup_by_user
    for form in ("broadcast", "sharded", "joined"):
        out = way(df, "cell", tables[kind, form], ",", ";", "NA")
        got = {r.i: r.label for r in out.collect()}
        wrong = {cells[i]: (got[i], e) for i, e in expected.items() if got[i] != e}
        assert not wrong, form


@settings(max_examples=200, deadline=None)
@given(cells=st.lists(CELLS, min_size=1, max_size=40))
def test_cells_on_arrow_follow_the_rules(cells):
    """What the SQL functions do with a batch, without Spark."""
    some = pa.array([cell for cell in cells if cell is not None], pa.string())
    codes = arrow_cells.cell_codes(some, ",")
    for kind, known in (("id", IDS), ("user", USERS)):
        keys = arrow_cells.code_keys(codes.values, kind).to_pylist()
        texts = pa.ListArray.from_arrays(
            codes.offsets, pa.array([known.get(key, "NA") for key in keys], pa.string())
        )
        got = [";".join(row) for row in texts.to_pylist()]
        assert got == [_expected(cell, kind) for cell in some.to_pylist()]
