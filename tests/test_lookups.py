"""Decoding rules, each checked in the indexed, the joined and the SQL form."""

import pickle
import re
import weakref
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stepweave.config import LookupSpec
from stepweave.functions import cells
from stepweave.functions import codes as cell_sql
from stepweave.operators import lookup_index
from stepweave.operators import lookups as L

IDS = [(1, "A"), (2, "B"), (0, "zero"), (9223372036854775807, "max"), (-9223372036854775808, "min")]
USERS = [("ann", "Ann A."), ("Bob", "Bob B."), (" x", "spaced")]
FORMS = ["indexed", "sharded", "joined", "sql", "sql_sharded"]
WAYS = {"sharded": "sharded", "joined": "joined", "sql_sharded": "sharded"}

# (cell, delimiter, text for no match, expected)
ID_CASES = [
    (None, ",", "NA", None),
    ("1,2", ",", "NA", "A;B"),
    (",1,2,", ",", "NA", "A;B"),
    ("\t,1", ",", "NA", "A"),
    ("1,", ",", "NA", "A"),
    ("1,,2", ",", "NA", "A;NA;B"),
    ("1, ,2", ",", "NA", "A;NA;B"),
    ("", ",", "NA", "NA"),
    (" ", ",", "NA", "NA"),
    (",", ",", "NA", ""),
    (",,", ",", "NA", "NA"),
    (" 1 ,2.9,1e0", ",", "NA", "A;B;A"),
    ("x,9", ",", "NA", "NA;NA"),
    ("2,1,2", ",", "NA", "B;A;B"),
    ("1,9", ",", None, "A;null"),
    ("1|2", "|", "NA", "A;NA;B"),
    ("1|2", "\\|", "NA", "A;B"),
    ("1,2|2|1,", "\\|", "NA", "NA;B;NA"),
    ("1 - 2", "\\s*-\\s*", "NA", "A;B"),
    ("12", "", "NA", "A;B"),
    ("1", "", "NA", "A"),
    ("", "", "NA", "NA"),
    ("0.9,-0.9", ",", "NA", "zero;zero"),
    ("-1.9,1d,2f,0x1p1", ",", "NA", "NA;A;B;B"),
    ("NaN,Infinity,-Infinity,1e30,-1e30", ",", "NA", "zero;max;min;max;min"),
    ("nan,inf,infinity,+INF,1_0,1 2", ",", "NA", "NA;NA;NA;NA;NA;NA"),
]
USER_CASES = [
    (None, ",", "?", None),
    ("ann,Bob", ",", "?", "Ann A.;Bob B."),
    ("Ann,bob", ",", "?", "?;?"),
    (" ann, x,x", ",", "?", "?;spaced;?"),
    (",ann,", ",", "?", "Ann A."),
    ("", ",", "?", "?"),
    ("ann,1", ",", None, "Ann A.;null"),
]


def _lookup(spark, kind, form):
    rows, schema = (IDS, "k bigint, v string") if kind == "id" else (USERS, "k string, v string")
    return _made(spark.createDataFrame(rows, schema), form, kind)


def _made(df, form, kind="id", name="t"):
    return L.lookup_from(df, name, kind, way=WAYS.get(form, "broadcast"))


def _decode(spark, kind, form, cells, delimiter, missing, lookup=None):
    lookup = lookup or _lookup(spark, kind, form)
    df = spark.createDataFrame(list(enumerate(cells)), "i int, cell string")
    if form.startswith("sql"):
        L.register_sql_functions(spark, [lookup])
        df.createOrReplaceTempView("cells")
        text = spark.sql(
            f"SELECT i, {L.SQL_NAMES[kind]}('t', cell, :d, ';', :m) AS label FROM cells",
            args={"d": delimiter, "m": missing},
        )
    else:
        way = L.lookup_by_id if kind == "id" else L.lookup_by_user
        text = way(df, "cell", lookup, delimiter, ";", missing)
        assert text.columns == ["i", "cell", "label"]
    return [r["label"] for r in text.orderBy("i").collect()]


def _by_setting(cases):
    settings = {}
    for cell, delimiter, missing, expected in cases:
        settings.setdefault((delimiter, missing), []).append((cell, expected))
    return settings.items()


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("kind,cases", [("id", ID_CASES), ("user", USER_CASES)])
def test_rules(spark, kind, cases, form):
    lookup = _lookup(spark, kind, form)
    assert lookup.way == WAYS.get(form, "broadcast")
    for (delimiter, missing), pairs in _by_setting(cases):
        cells = [cell for cell, _ in pairs]
        got = _decode(spark, kind, form, cells, delimiter, missing, lookup)
        assert dict(zip(cells, got)) == dict(pairs), (delimiter, missing)


@pytest.mark.parametrize("form", FORMS)
def test_wrong_kind_matches_nothing(spark, form):
    users = _lookup(spark, "user", form)
    assert _decode(spark, "id", form, ["1,2", ",", None], ",", "NA", users) == ["NA;NA", "", None]
    ids = _lookup(spark, "id", form)
    assert _decode(spark, "user", form, ["1"], ",", "NA", ids) == ["NA"]


@pytest.mark.parametrize("form", ["indexed", "sharded", "joined"])
def test_duplicate_keys_keep_the_greatest_label(spark, form):
    rows = spark.createDataFrame([(1, "a"), (1, "c"), (1, "b")], "k bigint, v string")
    lookup = _made(rows, form)
    assert lookup.rows == 1
    assert _decode(spark, "id", form, ["1,1"], ",", "NA", lookup) == ["c;c"]


@pytest.mark.parametrize("form", FORMS)
def test_empty_lookup(spark, form):
    rows = spark.createDataFrame([], "k bigint, v string")
    lookup = _made(rows, form)
    assert _decode(spark, "id", form, ["1,2", "", None], ",", "NA", lookup) == ["NA;NA", "NA", None]


@pytest.mark.parametrize("share", [1, 10, L.HOT_SHARE])
def test_hot_cells_and_repeats(spark, monkeypatch, share):
    """A cell with most rows, null rows and rare cells give what the indexed form gives,
    with no, some and all cells taken for hot."""
    monkeypatch.setattr(L, "HOT_SHARE", share)
    cells = ["1,2"] * 500 + [None] * 300 + [f"{i},2" for i in range(1200)] + [str(i) for i in range(5000)]
    joined = _decode(spark, "id", "joined", cells, ",", "NA")
    assert joined == _decode(spark, "id", "indexed", cells, ",", "NA")
    assert len(joined) == len(cells)


def test_the_joined_form_takes_cells_apart_once(spark):
    """Cells are read by one generator, and their labels are sorted once: no list is
    gathered in groups, which fall back to sorting twice."""
    df = spark.createDataFrame([("1,x",), (None,)], "cell string")
    out = L.lookup_by_id(df, "cell", _lookup(spark, "id", "joined"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1
    assert "Union" not in plan
    assert "Window" in plan


def test_the_joined_form_shuffles_its_cells_once(spark):
    """Counting the cells and taking them apart start from one exchange; a code is read as
    a number once."""
    df = spark.createDataFrame([("1,x",), (None,)], "cell string")
    lookup = _lookup(spark, "id", "joined")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = L.lookup_by_id(df, "cell", lookup)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"[ -]Exchange hashpartitioning\(cell#\d+, \d+\)", plan)) - len(
        re.findall(r"ReusedExchange [^\n]*, Exchange hashpartitioning\(cell#\d+, \d+\)", plan)
    ) == 1
    assert cell_sql.id_keys("c").count("AS DOUBLE") == 1


def test_codes_that_no_number_is_and_blank_cells_in_one_pass(spark):
    """Unreadable codes, empty and odd cells side by side with good ones, in their order."""
    cells = [",".join(["x", str(i % 3), "", "1e0", "-", "2.9"][: i % 7]) for i in range(300)]
    cells += ["", ",", ",,", " , ", None]
    joined = _decode(spark, "id", "joined", cells, ",", "NA")
    assert joined == _decode(spark, "id", "indexed", cells, ",", "NA")


def test_null_delimiter_is_an_error(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql")])
    ask = "SELECT lookupValueByIdList('t', {}, CAST(NULL AS STRING), ';', 'NA') AS v"
    assert spark.sql(ask.format("CAST(NULL AS STRING)")).first().v is None
    with pytest.raises(PySparkException, match="split delimiter is null"):
        spark.sql(ask.format("'1'")).collect()


def test_unknown_lookup_is_an_error_when_a_row_needs_it(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql")])
    ask = "SELECT lookupValueByIdList('other', {}, ',', ';', 'NA') AS v"
    assert spark.sql(ask.format("CAST(NULL AS STRING)")).first().v is None
    assert spark.sql(ask.format("','")).first().v == ""
    with pytest.raises(PySparkException, match="no lookup named other"):
        spark.sql(ask.format("'1'")).collect()


def test_sql_names_ignore_case_and_convert_numbers(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql")])
    assert spark.sql("SELECT LOOKUPVALUEBYIDLIST('t', 2L, ',', ';', 'NA') AS v").first().v == "B"


def test_the_lookup_may_differ_by_row(spark):
    other = spark.createDataFrame([(1, "other")], "k bigint, v string")
    L.register_sql_functions(
        spark, [_lookup(spark, "id", "sql"), L.lookup_from(other, "o", "id"), _lookup_user(spark)]
    )
    df = spark.sql(
        "SELECT t, lookupValueByIdList(t, '1', ',', ';', 'NA') AS v "
        "FROM VALUES ('t'), ('o'), ('u') AS x(t)"
    )
    assert {r.t: r.v for r in df.collect()} == {"t": "A", "o": "other", "u": "NA"}


def test_an_unknown_name_matters_only_where_there_is_a_cell(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql")])
    df = spark.createDataFrame([("t", "1"), ("other", None), ("other", ",")], "t string, c string")
    df.createOrReplaceTempView("named")
    out = spark.sql("SELECT t, c, lookupValueByIdList(t, c, ',', ';', 'NA') AS v FROM named")
    assert {tuple(r) for r in out.collect()} == {("t", "1", "A"), ("other", None, None), ("other", ",", "")}


def test_lookups_may_be_called_in_any_clause(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql")])
    call = "lookupValueByIdList('t', CAST(id AS STRING), ',', ';', 'NA')"
    out = spark.sql(
        f"SELECT {call} AS v, count(*) AS n FROM range(5) WHERE {call} <> 'zero' "
        f"GROUP BY {call} ORDER BY v"
    )
    assert [tuple(r) for r in out.collect()] == [("A", 1), ("B", 1), ("NA", 2)]


def test_the_limit_comes_from_the_session(spark):
    spark.conf.set(L.BROADCAST_SETTING, "1")
    try:
        assert not L.lookup_from(spark.createDataFrame(IDS, "k bigint, v string"), "t", "id").broadcast
    finally:
        spark.conf.unset(L.BROADCAST_SETTING)
    assert L.lookup_from(spark.createDataFrame(IDS, "k bigint, v string"), "t", "id").broadcast


def _lookup_user(spark):
    return L.lookup_from(spark.createDataFrame(USERS, "k string, v string"), "u", "user")


def test_null_separator_is_the_text_null(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql")])
    sql = "SELECT lookupValueByIdList('t', '1,2', ',', CAST(NULL AS STRING), 'NA') AS v"
    assert spark.sql(sql).first().v == "AnullB"


def test_build_from_a_path(spark, tmp_path):
    path = str(tmp_path / "codes")
    spark.sql("SELECT 7L AS code, 1.5D AS rate").write.parquet(path)
    spec = LookupSpec("codes", "id", path, "SELECT code, rate FROM codes")
    lookup = L.build_lookup(spark, spec)
    assert (lookup.name, lookup.kind, lookup.rows) == ("codes", "id", 1)
    assert _decode(spark, "id", "indexed", ["7"], ",", "NA", lookup) == ["1.5"]
    other = LookupSpec("codes", "other", path, "SELECT code, rate FROM codes")
    assert L.build_lookup(spark, other) is None


@pytest.mark.parametrize(
    "sql,kind",
    [
        ("SELECT 1 AS k, 'a' AS v", "id"),
        ("SELECT CAST(NULL AS BIGINT) AS k, 'a' AS v", "id"),
        ("SELECT 1L AS k, CAST(NULL AS STRING) AS v", "id"),
        ("SELECT CAST(NULL AS STRING) AS k, 'a' AS v", "user"),
        ("SELECT 1L AS k", "id"),
    ],
)
def test_bad_lookups_fail_when_built(spark, sql, kind):
    with pytest.raises((L.LookupBuildError, PySparkException)):
        L.lookup_from(spark.sql(sql), "bad", kind)


def test_the_indexed_form_does_not_shuffle_the_facts(spark):
    df = spark.createDataFrame([("1",)], "cell string")
    plan = L.lookup_by_id(df, "cell", _lookup(spark, "id", "indexed"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("way", ["broadcast", "sharded", "joined"])
def test_cells_that_change_when_they_are_computed_again(spark, way):
    names = spark.range(50).selectExpr("id AS key", "concat('n', id) AS label")
    lookup = L.lookup_from(names, "names", "id", way=way)
    facts = spark.range(500).withColumn("cell", (F.rand() * 50).cast("int").cast("string"))
    found = L.lookup_by_id(facts, "cell", lookup, output="label")
    assert found.where("label IS NULL OR label <> concat('n', cell)").isEmpty()


def test_one_broadcast_serves_every_use(spark):
    names = spark.range(5).selectExpr("id AS key", "'n' AS label")
    lookup = L.lookup_from(names, "names", "id")
    facts = spark.range(2).selectExpr("'1,2' AS cell")
    for _ in range(3):
        L.lookup_by_id(facts, "cell", lookup).collect()
    assert len(lookup.shared) == 1


CALL = "lookupValueByIdList('t', {}, ',', ';', 'NA')"


@pytest.mark.parametrize("form", ["sql", "sql_sharded"])
def test_lookups_order_explode_and_join_at_every_size(spark, form):
    L.register_sql_functions(spark, [_lookup(spark, "id", form)])
    ordered = spark.sql(f"SELECT id FROM range(4) ORDER BY {CALL.format('id')} DESC, id")
    assert [r.id for r in ordered.collect()] == [0, 3, 2, 1]  # zero, NA, B, A
    parts = spark.sql(
        f"SELECT id, name FROM range(3) LATERAL VIEW explode(split({CALL.format('concat(id, 1)')}, "
        f"'N')) AS name"
    )
    assert sorted(map(tuple, parts.collect())) == [
        (0, "A"), (1, ""), (1, "A"), (2, ""), (2, "A")
    ]
    pairs = spark.sql(
        f"SELECT a.id, b.n FROM range(5) a LEFT JOIN VALUES ('A'), ('B') b(n) "
        f"ON {CALL.format('a.id')} = b.n ORDER BY a.id"
    )
    assert [tuple(r) for r in pairs.collect()] == [(0, None), (1, "A"), (2, "B"), (3, None), (4, None)]
    windows = spark.sql(
        f"SELECT id, rank() OVER (PARTITION BY {CALL.format('id')} ORDER BY id) AS r FROM range(6)"
    )
    assert {r.id: r.r for r in windows.collect()} == {0: 1, 1: 1, 2: 1, 3: 1, 4: 2, 5: 3}
    inside = spark.sql(
        f"SELECT id FROM range(9) WHERE {CALL.format('id')} IN "
        f"(SELECT {CALL.format('x')} FROM VALUES (1), (2) t(x))"
    )
    assert sorted(r.id for r in inside.collect()) == [1, 2]


def test_lookup_names_separators_and_patterns_may_differ_by_row(spark):
    L.register_sql_functions(spark, [_lookup(spark, "id", "sql"), _lookup_user(spark)])
    rows = [
        ("t", "1,2", ",", "+", "NA"),
        ("t", "1|9", r"\|", "-", None),
        ("t", None, ",", "+", "NA"),
        ("u", "1", ",", "+", "none"),
        ("t", "1  2", r"\s+", None, "NA"),
    ]
    df = spark.createDataFrame(rows, "t string, c string, d string, s string, m string")
    df.repartition(1).createOrReplaceTempView("mixed_calls")
    out = spark.sql("SELECT *, lookupValueByIdList(t, c, d, s, m) AS v FROM mixed_calls")
    got = {(r.t, r.c): r.v for r in out.collect()}
    assert got == {
        ("t", "1,2"): "A+B",
        ("t", "1|9"): "A-null",
        ("t", None): None,
        ("u", "1"): "none",
        ("t", "1  2"): "AnullB",
    }


@pytest.mark.parametrize("way", ["broadcast", "sharded"])
def test_cells_of_other_types_are_the_text_that_a_cast_gives(spark, way):
    values = "1.5D, 100.0D, 1.0E10D, -0.0D, CAST(0.1 AS FLOAT), 12.50BD, true, DATE'2024-02-03', 7Y"
    casts = spark.sql(f"SELECT explode(array({', '.join(f'CAST({v} AS STRING)' for v in values.split(', '))}))")
    texts = [r[0] for r in casts.collect()]
    rows = spark.createDataFrame([(t, f"<{t}>") for t in dict.fromkeys(texts)], "k string, v string")
    L.register_sql_functions(spark, [L.lookup_from(rows, "texts", "user", way=way)])
    for value, text in zip(values.split(", "), texts, strict=True):
        sql = f"SELECT lookupValueByUserList('texts', {value}, ';', ';', 'NA') AS v"
        assert spark.sql(sql).first().v == f"<{text}>", value


PATTERNS = [
    ("a,b,,c,", ","), ("a|b", r"\|"), ("a|b", "|"), ("a.b.c", r"\."), ("a1b22c", r"\d+"),
    ("a  b\tc", r"\s+"), ("aXbxc", "(?i)x"), ("a[b", r"\["), ("a.b|c", r"\Q.\E|\Q|\E"),
    ("abc", ""), ("", ""), ("", ","), ("aAbBc", r"\p{Upper}"), ("a\u00a0b c", r"\h"),
    ("a\r\nb\nc", r"\R"), ("a-b_c", "[-_]"), ("a]b", "[]]"), ("a,b;c", "[,;]"), ("xaxb", "(?=a)"),
    ("a1b", r"(?<n>\d)"), ("aéb", r"\w"), ("1,,2", ",+"), ("a\\b", r"\\"), ("a^b", "[\\^]"),
    ("ab,cd", r"(?<=b),"), ("aab", "a*?"), ("a b", r"\p{Space}"), ("tab", r"[\x61]"),
]


def test_patterns_split_as_the_built_in_function_does(spark):
    df = spark.createDataFrame(PATTERNS, "cell string, pattern string")
    wanted = [
        r.parts
        for r in df.selectExpr(
            "CASE WHEN pattern = '' AND cell <> '' THEN concat(split(cell, '', -1), array('')) "
            "ELSE split(cell, pattern, -1) END AS parts"
        ).collect()
    ]
    found = [cells.splitter(pattern)(cell) for cell, pattern in PATTERNS]
    for case, one, other in zip(PATTERNS, found, wanted, strict=True):
        assert one == other, case


@pytest.mark.parametrize("pattern", ["(", r"\p{Greek}", "[a-z&&[b]]", r"\Gx", "a\\"])
def test_patterns_without_a_counterpart_are_errors(pattern):
    with pytest.raises(cells.PatternError):
        cells.splitter(pattern)("x")


@pytest.mark.parametrize("kind", ["id", "user"])
def test_a_sharded_index_gives_what_one_in_memory_gives(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(lookup_index, "SHARD_BYTES", 20_000)
    rng = np.random.default_rng(5)
    numbers = np.unique(rng.integers(-(10**9), 10**9, 5000))
    # Texts whose hashes are equal lie side by side.
    keys = numbers.tolist() if kind == "id" else [f"k{n}" for n in numbers] + ["plumless", "buckeroo"]
    schema = f"key {L.KEY_TYPES[kind]}, label string"
    df = spark.createDataFrame([(k, f"label of {k}") for k in keys], schema)
    index = lookup_index.build_shards(df, 200_000, str(tmp_path / "shards"))
    assert len(index.names) == 10
    whole = lookup_index.MemoryIndex(df.toArrow())
    kinds = {"id": pa.int64(), "user": pa.string()}
    asked = [*rng.permutation(keys).tolist()[:1000], *keys[:3], None, keys[-1]]
    asked += [10**12, -(10**12)] if kind == "id" else ["", "none", "k"]
    asked = pa.array([int(x) if kind == "id" and x is not None else x for x in asked], kinds[kind])
    for _ in range(2):
        assert index.labels(asked).to_pylist() == whole.labels(asked).to_pylist()
    monkeypatch.setattr(lookup_index, "OPEN_SHARDS", 2)
    index = pickle.loads(pickle.dumps(index))
    assert index.labels(asked).to_pylist() == whole.labels(asked).to_pylist()
    assert len(index._open) <= 2


def test_lookups_of_a_session_share_one_limit(spark, monkeypatch):
    """Fifty lookups, each a third of the limit: three are broadcast, until some are released."""
    monkeypatch.setattr(L.BroadcastBudget, "_of_sessions", weakref.WeakKeyDictionary())
    names = spark.range(20).selectExpr("id AS key", "concat('n', id) AS label")
    size = L.lookup_from(names, "first", "id").size
    budget = L.BroadcastBudget.of(spark)
    budget.give_back(size)
    limit = 3 * size
    made = [L.lookup_from(names, f"l{i}", "id", limit) for i in range(50)]
    assert [x.way for x in made] == ["broadcast"] * 3 + ["sharded"] * 47
    assert budget.taken == limit
    L.register_sql_functions(spark, made)
    out = spark.sql(
        "SELECT lookupValueByIdList(concat('l', id), '1,2', ',', ';', 'NA') AS v FROM range(50)"
    )
    assert {r.v for r in out.collect()} == {"n1;n2"}
    folders = [folder for x in made for folder in x.folders]
    assert len(folders) == 2 * 47 and all(Path(folder).exists() for folder in folders)
    for lookup in made:
        lookup.release()
        lookup.release()
    assert budget.taken == 0 and not any(Path(folder).exists() for folder in folders)
    assert L.lookup_from(names, "next", "id", limit).way == "broadcast"


def test_a_hot_cell_of_any_length_is_dealt_to_many_tasks(spark):
    """Its rows do not meet in one partition of the join, nor do those without a cell."""
    long = ",".join(str(i) for i in range(1100))
    assert len(long) > 4096
    rows = [(long,)] * 3000 + [(None,)] * 3000 + [(f"{i}",) for i in range(3000)]
    df = spark.createDataFrame(rows, "cell string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = L.lookup_by_id(df, "cell", _lookup(spark, "id", "joined"), ",", ";", "NA")
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2 * len(rows) / len(sizes)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_a_folder_that_python_cannot_open(spark, monkeypatch):
    assert not lookup_index.reachable("nosuchscheme://host/folder")
    monkeypatch.setattr(L, "reachable", lambda path: False)
    lookup = L.lookup_from(spark.createDataFrame(IDS, "k bigint, v string"), "t", "id", -1)
    assert lookup.way == "joined"
    assert _decode(spark, "id", "joined", ["1,7"], ",", "NA", lookup) == ["A;NA"]
    with pytest.raises(L.LookupBuildError, match="mount the shared folder"):
        L.register_sql_functions(spark, [lookup])


def test_short_runs_of_digits_are_read_together(monkeypatch):
    """Only codes of another form are read one by one; all are read alike."""
    codes = pa.array(["12", "007", None, "x", "1" * 15, "1" * 16, "1.9", "", "12", "\u0661", "5\n"])
    want = [None if code is None else cells.id_key(code) for code in codes.to_pylist()]
    asked, one = [], cells.id_key
    monkeypatch.setattr(cells, "id_key", lambda code: asked.append(code) or one(code))
    assert cells.code_keys(codes, "id").to_pylist() == want
    assert not {"12", "007", "1" * 15} & set(asked)
    assert cells.code_keys(pa.array([], pa.string()), "id").to_pylist() == []
