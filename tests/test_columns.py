import json

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from stepweave.config import DerivedColumn
from stepweave.functions import json as json_columns
from stepweave.functions import json_pieces
from stepweave.functions.json import json_attr, json_nodes
from stepweave.operators.columns import ColumnError, cast_id_columns, derive_columns


def test_id_columns_become_bigint_in_place(spark):
    df = spark.sql(
        "SELECT 1 AS a_id, 2.9D AS B_ID, -2.9BD AS c_Id, true AS d_id, ' 7' AS e_id, "
        "3 AS id, 4 AS f_idx, CAST(NULL AS INT) AS g_id, 5 AS `odd name_id`, "
        "TIMESTAMP_LTZ '1970-01-01 00:00:09Z' AS t_id"
    )
    out = cast_id_columns(df)
    assert out.columns == df.columns
    assert dict(out.dtypes) == {
        "a_id": "bigint", "B_ID": "bigint", "c_Id": "bigint", "d_id": "bigint", "e_id": "string",
        "id": "int", "f_idx": "int", "g_id": "bigint", "odd name_id": "bigint", "t_id": "bigint",
    }
    assert tuple(out.first()) == (1, 2, -2, 1, " 7", 3, 4, None, 5, 9)


@pytest.mark.parametrize("value", ["DATE '2020-01-01'", "TIMESTAMP_NTZ '2020-01-01'", "array(1)"])
def test_id_columns_that_cannot_be_cast_are_named(spark, value):
    with pytest.raises(ColumnError, match="x_id"):
        cast_id_columns(spark.sql(f"SELECT {value} AS x_id"))


def test_id_cast_overflow_fails(spark):
    with pytest.raises(PySparkException, match="OVERFLOW"):
        cast_id_columns(spark.sql("SELECT 1e30D AS x_id")).collect()


def test_derived_columns_surround_the_source(spark):
    df = spark.sql("SELECT 2 AS a, 'x' AS b")
    out = derive_columns(
        df,
        pre=[DerivedColumn("a * 10", "p1"), DerivedColumn("upper(b)", "p2")],
        post=[DerivedColumn("concat(b, a)", "q1")],
    )
    assert out.columns == ["p1", "p2", "a", "b", "q1"]
    assert tuple(out.first()) == (20, "X", 2, "x", "x2")


def test_derived_columns_are_one_projection(spark, sf_dir):
    df = cast_id_columns(spark.read.parquet(f"{sf_dir}/events.parquet"))
    out = derive_columns(df, [DerivedColumn("event_id + 1", "p")], [DerivedColumn("value", "q")])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Project") == 1


def test_parameters_are_substituted_everywhere(spark):
    df = spark.range(1)
    given = {"batchId": "42", "jobName": "nightly", "s3SecretKey": "hush"}
    column = DerivedColumn("CAST(batchId AS LONG) + batchId", "b", "param", "batchId")
    name = DerivedColumn("'jobName'", "n", "param", "jobName")
    assert tuple(derive_columns(df, [column], [name], given).first()) == (84, 0, "nightly")
    for unknown in ("s3SecretKey", "other", "configFileFullPath"):
        with pytest.raises(ColumnError, match="there is no parameter"):
            derive_columns(df, [DerivedColumn("1", "x", "param", unknown)], [], given)


def test_a_derived_column_may_not_hide_another(spark):
    with pytest.raises(ColumnError, match="ID"):
        derive_columns(spark.range(1), [DerivedColumn("1", "ID")])
    with pytest.raises(ColumnError, match="x"):
        derive_columns(spark.range(1), [DerivedColumn("1", "x")], [DerivedColumn("2", "x")])


def test_json_attr(spark):
    texts = ['{"k": 69, "s": "t", "n": null, "o": {"p": [1, 2]}, "b": true}', "broken", None]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    paths = ["k", "$.s", "n", "none", "o.p", "$.o.p[1]", "b"]
    rows = df.select(*[json_attr("j", p).alias(f"c{i}") for i, p in enumerate(paths)]).collect()
    assert tuple(rows[0]) == ("69", "t", "null_string", "null_string", "[1,2]", "2", "true")
    assert set(rows[1]) == set(rows[2]) == {"null_string"}


def _nodes(spark, text):
    df = spark.createDataFrame([(text,)], "j string")
    return [r.node for r in json_nodes(df, "j", "l").collect()]


def test_json_nodes(spark):
    assert _nodes(spark, '{"l": [{"a": 1}, {"a": 2}]}') == ['{"a":1}', '{"a":2}']
    assert _nodes(spark, '{"l": {"a": "x"}}') == ['{"a":"x"}']
    assert _nodes(spark, '{"l": ["x", 5, "5", true, null, [1]]}') == [
        '{"value":"x"}', '{"value":5}', '{"value":"5"}', '{"value":true}', '{"value":null}',
        '{"value":[1]}',
    ]
    assert _nodes(spark, '{"l": ["{\\"a\\":1}"]}') == ['{"value":"{\\"a\\":1}"}']
    for nothing in ('{"l": []}', '{"l": null}', '{"l": "  "}', "{}", " ", None):
        assert _nodes(spark, nothing) == []
    with pytest.raises(PySparkException, match="not JSON, or too large"):
        _nodes(spark, "broken")
    for bad in ('{"l": 5}', '{"l": "text"}'):
        with pytest.raises(PySparkException, match="no JSON object or array"):
            _nodes(spark, bad)


DOCUMENTS = [
    ('{"l": [{"b": 1, "a": "x"}, 2, "s,]}", null, [1, {"c": "[{"}], {"q": "\\\\\\"}"}]}', "l"),
    ('{"k": {"l": ["no"]}, "l": {"a": {"z": [1.50, 1e3, true]}}}', "l"),
    ('{"a": [{"l": 1}, {"l": [10, 20]}], "l": 3}', "$.a[1].l"),
    ('{"x y": {"l": [{"v": "é\\u00e9 😀"}]}}', "$['x y'].l"),
    ('  [1,\n 2 , {"a" :\t[ ]}]  ', "$"),
    ('{"l": []}', "l"),
    ('{"l": null}', "l"),
    ('{"m": 1}', "l"),
    ('{"l": {}}', "l"),
    ('{"l": "  "}', "l"),
    ('[[1], [2, 3]]', "$[1]"),
    ('[1]', "$[7]"),
    ('{"l": 1}', "$.l.x"),
]


def test_large_documents_give_what_small_ones_give(spark, monkeypatch):
    for limit in (0, 10**9):
        for number, (text, path) in enumerate(DOCUMENTS):
            df = spark.createDataFrame([(number, text), (90, None), (91, " ")], "n int, j string")
            want = sorted(tuple(r) for r in json_nodes(df, "j", path).select("n", "node").collect())
            monkeypatch.setattr(json_columns, "LARGE_BYTES", limit)
            found = json_nodes(df.where("n < 90"), "j", path, large=True)
            assert found.columns == ["n", "node"]
            assert sorted(map(tuple, found.collect())) == want, (text, path)


@pytest.mark.parametrize(
    "text", ['{"l": [1, 2}', '{"l": [1 2]}', '{"l" [1]}', '{"l": [1,', '{"l": 7}', "x", '{"l": [tru]}']
)
def test_large_documents_that_cannot_be_read_are_errors(spark, monkeypatch, text):
    monkeypatch.setattr(json_columns, "LARGE_BYTES", 0)
    df = spark.createDataFrame([(text,)], "j string")
    with pytest.raises(Exception, match="(?i)json|no path"):
        json_nodes(df, "j", "l", large=True).collect()


def test_pieces_of_a_document_leave_some_at_a_time(spark, monkeypatch):
    text = "[" + ",".join(f'{{"i": {i}, "s": "[{i}]"}}' for i in range(20_000)) + "]"
    whole = list(json_pieces.pieces(text, []))
    assert len(whole) == 20_000 and json.loads(whole[77][0]) == {"i": 77, "s": "[77]"}
    batch = pa.RecordBatch.from_pydict({"n": [1], "j": [text]})
    monkeypatch.setattr(json_pieces, "_TOGETHER", 10_000)
    out = list(json_pieces.split_documents("j", "$", ["n"])(iter([batch])))
    assert sum(map(len, out)) == 20_000 and max(map(len, out)) < 1000
    assert json_pieces.path_steps("$.a[0]['b c'].d") == ["a", 0, "b c", "d"]
    with pytest.raises(json_pieces.JsonError):
        json_pieces.path_steps("$.a[*]")
