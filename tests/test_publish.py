import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.operators import catalog, publish
from stepweave.operators.catalog import (
    CatalogError,
    check_table,
    column_type,
    create_external_table,
    refresh_table,
    repair_partitions,
)
from stepweave.operators.publish import EFFECTIVE_KEY as KEY
from stepweave.session import has_files


def _rows(spark, rows, schema="v int, kind string"):
    return spark.createDataFrame(rows, f"{KEY} bigint, {schema}")


def _read(spark, path):
    df = spark.read.parquet(path).select(KEY, "v", "kind")
    return sorted(map(tuple, df.collect()), key=str)


BOTH = (KEY, "kind")


def test_distinct_effective_keys(spark):
    df = _rows(spark, [(1, 1, "a"), (1, 2, "a"), (2, 3, "a")])
    assert sorted(r[0] for r in publish.distinct_effective_keys(df).collect()) == [1, 2]


@pytest.mark.parametrize("columns", [(KEY,), BOTH, ("kind", KEY)])
def test_a_rerun_leaves_the_same_rows(spark, tmp_path, columns):
    path = str(tmp_path / "t")
    df = _rows(spark, [(1, 1, "a"), (1, 2, "b"), (2, 3, "a"), (12, 4, "b")])
    for _ in range(2):
        publish.replace_by_key(df, path, columns)
        assert _read(spark, path) == [(1, 1, "a"), (1, 2, "b"), (12, 4, "b"), (2, 3, "a")]


@pytest.mark.parametrize("columns", [(KEY,), BOTH, ("kind", KEY)])
def test_a_key_is_replaced_whole_and_others_stay(spark, tmp_path, columns):
    """Also the partitions that get no rows now; and key 1 is not key 12."""
    path = str(tmp_path / "t")
    first = [(1, 1, "a"), (1, 2, "b"), (1, 3, None), (2, 4, "a"), (12, 5, "b")]
    publish.replace_by_key(_rows(spark, first), path, columns)
    publish.replace_by_key(_rows(spark, [(1, 9, "a"), (3, 8, "c")]), path, columns)
    assert _read(spark, path) == [(1, 9, "a"), (12, 5, "b"), (2, 4, "a"), (3, 8, "c")]


def test_partition_values_with_special_characters(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = ["a/b", "c=d", "e f:%g", "", None, "ü"]
    publish.replace_by_key(_rows(spark, [(1, i, k) for i, k in enumerate(odd)]), path, BOTH)
    publish.replace_by_key(_rows(spark, [(1, i, k) for i, k in enumerate(odd)]), path, BOTH)
    assert spark.read.parquet(path).count() == len(odd)
    publish.replace_by_key(_rows(spark, [(1, 0, "a/b"), (1, 3, "")]), path, BOTH)
    assert _read(spark, path) == [(1, 0, "a/b"), (1, 3, None)]


def test_without_the_key_partition_rows_are_appended(spark, tmp_path):
    path = str(tmp_path / "t")
    df = _rows(spark, [(1, 1, "a")])
    for columns in ((), ()):
        publish.replace_by_key(df, path, columns)
    assert spark.read.parquet(path).count() == 2
    other = str(tmp_path / "u")
    for _ in range(2):
        publish.replace_by_key(df, other, ("kind",))
    assert spark.read.parquet(other).count() == 2


def test_an_empty_output_replaces_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = _rows(spark, [(1, 1, "a"), (2, 2, "b")])
    publish.replace_by_key(df, path, BOTH)
    publish.replace_by_key(df.where("v > 5"), path, BOTH)
    assert spark.read.parquet(path).count() == 2


def test_a_step_may_read_the_table_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_by_key(_rows(spark, [(1, 1, "a"), (2, 2, "b")]), path, BOTH)
    grown = spark.read.parquet(path).withColumns({"v": F.col("v") + 1, KEY: F.col(KEY).cast("bigint")})
    publish.replace_by_key(grown, path, BOTH)
    assert _read(spark, path) == [(1, 2, "a"), (2, 3, "b")]


@pytest.mark.parametrize("columns", [(), (KEY,), BOTH])
def test_a_null_key_fails_and_publishes_nothing(spark, tmp_path, columns):
    path = str(tmp_path / "t")
    publish.replace_by_key(_rows(spark, [(1, 1, "a")]), path, columns)
    with pytest.raises(Exception, match="is null"):
        publish.replace_by_key(_rows(spark, [(1, 2, "b"), (None, 3, "b")]), path, columns)
    assert _read(spark, path) == [(1, 1, "a")]


def test_outputs_that_cannot_be_published(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(publish.PublishError, match=KEY):
        publish.replace_by_key(spark.range(1), path)
    with pytest.raises(publish.PublishError, match="bigint"):
        publish.replace_by_key(spark.sql(f"SELECT 1 AS {KEY}"), path)
    with pytest.raises(publish.PublishError, match="absent"):
        publish.replace_by_key(_rows(spark, [(1, 1, "a")]), path, (KEY, "absent"))
    assert not has_files(spark, path)


def test_new_columns_are_read_after_append(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.write_append(_rows(spark, [(1, 1, "a")]), path, files=1)
    publish.write_append(_rows(spark, [(2, 2, "b", 7)], "v int, kind string, n int"), path, files=1)
    merged = spark.read.option("mergeSchema", True).parquet(path)
    assert {r.v: r.n for r in merged.collect()} == {1: None, 2: 7}


def test_a_hot_key_is_written_by_many_tasks(spark, tmp_path):
    """All rows under one key: the exchange splits above the advisory size."""
    path = str(tmp_path / "t")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "50KB")
    try:
        df = spark.range(200_000, numPartitions=8).select(F.lit(1).cast("bigint").alias(KEY), "id")
        publish.replace_by_key(df, path, (KEY,), files=2)
    finally:
        spark.conf.unset(advisory)
    assert len(spark.read.parquet(path).inputFiles()) > 4
    assert spark.read.parquet(path).count() == 200_000


def test_types_in_the_catalog():
    assert column_type(T.LongType()) == "bigint"
    assert column_type(T.LongType(), partition=True) == "bigint"
    assert column_type(T.TimestampType()) == "timestamp"
    assert column_type(T.TimestampType(), partition=True) == "string"
    assert column_type(T.ArrayType(T.StringType())) == "array<string>"
    nested = T.StructType([T.StructField("a", T.LongType())])
    assert column_type(nested) == "struct<a:bigint>"
    assert column_type(T.DecimalType(12, 2)) == "decimal(12,2)"


def test_table_over_published_rows(spark, tmp_path):
    path, table = str(tmp_path / "t"), "default.published"
    df = _rows(spark, [(1, 1, "a"), (2, 2, "b")]).select("v", "kind", KEY)
    publish.replace_by_key(df, path, BOTH)
    refresh_table(spark, table, df.schema, path, BOTH)
    assert spark.table(table).columns == ["v", KEY, "kind"]
    assert spark.table(table).count() == 2
    publish.replace_by_key(_rows(spark, [(1, 5, "z")]).select("v", "kind", KEY), path, BOTH)
    refresh_table(spark, table, df.schema, path, BOTH)
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    assert parts == [f"{KEY}=1/kind=z", f"{KEY}=2/kind=b"]
    assert sorted(r.v for r in spark.table(table).collect()) == [2, 5]
    spark.sql(f"DROP TABLE {table}")
    assert has_files(spark, path)  # the table is external


def test_an_existing_table_gets_new_columns(spark, tmp_path):
    path, table = str(tmp_path / "t"), "default.evolving"
    old = _rows(spark, [(1, 1, "a")])
    publish.replace_by_key(old, path, (KEY,))
    refresh_table(spark, table, old.schema, path, (KEY,))
    new = _rows(spark, [(2, 2, "b", 7)], "v int, kind string, n int")
    publish.replace_by_key(new, path, (KEY,))
    refresh_table(spark, table, new.schema, path, (KEY,))
    assert {r.v: r.n for r in spark.table(table).collect()} == {1: None, 2: 7}
    with pytest.raises(CatalogError, match="kind"):
        refresh_table(spark, table, spark.sql(f"SELECT 1 AS kind, 1L AS {KEY}").schema, path, (KEY,))


def test_a_table_needs_its_partition_columns(spark, tmp_path):
    with pytest.raises(CatalogError, match="absent"):
        create_external_table(spark, "default.x", spark.range(1).schema, str(tmp_path), ("absent",))


def test_repair_finds_partitions_written_elsewhere(spark, tmp_path):
    path, table = str(tmp_path / "t"), "default.repaired"
    df = _rows(spark, [(1, 1, "a")])
    publish.replace_by_key(df, path, (KEY,))
    create_external_table(spark, table, df.schema, path, (KEY,))
    publish.replace_by_key(_rows(spark, [(2, 2, "b")]), path, (KEY,))
    assert spark.table(table).count() == 1
    repair_partitions(spark, table)
    assert spark.table(table).count() == 2


def test_another_partition_list_is_refused_before_anything_is_written(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "1L AS business_effective_timestamp", "'a' AS kind")
    path = str(tmp_path / "t")
    publish.replace_by_key(df, path, ["business_effective_timestamp"])
    for columns in (["business_effective_timestamp", "kind"], []):
        with pytest.raises(publish.PublishError, match="is partitioned by"):
            publish.replace_by_key(df, path, columns)
    assert spark.read.parquet(path).count() == 3


# --- runs that stop anywhere -------------------------------------------------------------


class _Stopped(RuntimeError):
    pass


def _stop_at(monkeypatch, name, call):
    """The ``call``-th call of a file operation does not happen, nor does anything after it."""
    real, calls = getattr(publish, name), []

    def stopped(*args):
        calls.append(args)
        if len(calls) >= call:
            raise _Stopped(name)
        return real(*args)

    monkeypatch.setattr(publish, name, stopped)


FIRST = [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 4, "a")]
SECOND = [(1, 7, "a"), (1, 8, "d"), (3, 9, "a")]
AFTER = sorted([(1, 7, "a"), (1, 8, "d"), (2, 4, "a"), (3, 9, "a")], key=str)


@pytest.mark.parametrize("columns", [BOTH, ("kind", KEY)])
@pytest.mark.parametrize(
    "name,call", [("delete_folder", n) for n in range(1, 8)] + [("move", n) for n in range(1, 4)]
)
def test_a_run_that_stops_while_it_swaps_is_finished_by_the_next(
    spark, tmp_path, monkeypatch, columns, name, call
):
    path = str(tmp_path / "t")
    publish.replace_by_key(_rows(spark, FIRST), path, columns)
    with monkeypatch.context() as patch:
        _stop_at(patch, name, call)
        with pytest.raises(_Stopped):
            publish.replace_by_key(_rows(spark, SECOND), path, columns)
    # Nothing is read twice, and no row of another key is touched.
    left = _read(spark, path)
    assert len(left) == len(set(left)) and (2, 4, "a") in left
    manifest = publish.finish_intents(spark, path)
    assert _read(spark, path) == AFTER
    assert len(manifest.added) == 3
    publish.replace_by_key(_rows(spark, SECOND), path, columns)
    assert _read(spark, path) == AFTER
    assert not any((tmp_path / "t" / folder).exists() and list((tmp_path / "t" / folder).iterdir())
                   for folder in ("_staging", "_intents"))


def test_a_run_that_stops_before_it_is_recorded_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.replace_by_key(_rows(spark, FIRST), path, BOTH)
    with monkeypatch.context() as patch:
        _stop_at(patch, "write_text", 1)
        with pytest.raises(_Stopped):
            publish.replace_by_key(_rows(spark, SECOND), path, BOTH)
    assert _read(spark, path) == sorted(FIRST, key=str)
    assert publish.finish_intents(spark, path) == publish.Manifest()
    assert _read(spark, path) == sorted(FIRST, key=str)


@pytest.mark.parametrize("call", [1, 2])
def test_appended_rows_are_there_once_though_a_run_stops(spark, tmp_path, monkeypatch, call):
    path = str(tmp_path / "t")
    publish.write_append(_rows(spark, FIRST), path, ("kind",))
    with monkeypatch.context() as patch:
        _stop_at(patch, "move", call)
        with pytest.raises(_Stopped):
            publish.write_append(_rows(spark, SECOND), path, ("kind",))
    publish.write_append(_rows(spark, [(5, 5, "e")]), path, ("kind",))
    assert _read(spark, path) == sorted([*FIRST, *SECOND, (5, 5, "e")], key=str)


def test_the_manifest_tells_what_was_put_in_place_and_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish.replace_by_key(_rows(spark, [*FIRST, (1, 5, None)]), path, BOTH)
    assert first.columns == BOTH and set(first.removed) == set()
    assert set(first.added) == {("1", "a"), ("1", "b"), ("1", "c"), ("2", "a"), ("1", None)}
    second = publish.replace_by_key(_rows(spark, SECOND), path, BOTH)
    assert set(second.added) == {("1", "a"), ("1", "d"), ("3", "a")}
    assert set(second.removed) == {("1", "b"), ("1", "c"), ("1", None)}
    both = first.then(second)
    assert set(both.added) == {("2", "a"), ("1", "a"), ("1", "d"), ("3", "a")}
    assert set(both.removed) == set(second.removed)


def test_partitions_are_registered_without_a_listing(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "t"), "default.by_manifest"
    odd = [(1, 1, "a/b"), (1, 2, None), (2, 3, "it's")]
    df = _rows(spark, odd)
    refresh_table(spark, table, df.schema, path, BOTH, publish.replace_by_key(df, path, BOTH))

    def listed(*args):
        raise AssertionError("the whole table is listed")

    monkeypatch.setattr(catalog, "repair_partitions", listed)
    for rows in ([(1, 8, "c=d"), (1, 9, "")], [(3, 5, "ü%"), (1, 1, "a/b")]):
        new = _rows(spark, rows)
        refresh_table(spark, table, new.schema, path, BOTH, publish.replace_by_key(new, path, BOTH))
        columns = [KEY, "v", "kind"]
        told = sorted(map(tuple, spark.table(table).select(columns).collect()), key=str)
        assert told == _read(spark, path)
        parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        assert len(parts) == len({(r[0], r[2]) for r in told})
    spark.sql(f"DROP TABLE {table}")


def test_another_table_of_that_name_is_refused_before_anything_is_written(spark, tmp_path):
    path, table = str(tmp_path / "t"), "default.someone_elses"
    df = _rows(spark, [(1, 1, "a")])
    publish.replace_by_key(df, path, (KEY,))
    refresh_table(spark, table, df.schema, path, (KEY,))
    assert check_table(spark, table, df.schema, path + "/", (KEY,))
    for there, columns, schema, match in (
        (str(tmp_path / "u"), (KEY,), df.schema, "lies at"),
        (path, BOTH, df.schema, "is partitioned by"),
        (path, (), df.schema, "is partitioned by"),
        (path, (KEY,), _rows(spark, [], "v string, kind string").schema, "type differs for v"),
        (path, ("absent",), df.schema, "absent"),
    ):
        with pytest.raises(CatalogError, match=match):
            check_table(spark, table, schema, there, columns)
    spark.sql(f"DROP TABLE {table}")
    assert not check_table(spark, table, df.schema, path, (KEY,))
    spark.sql(f"CREATE TABLE {table} (v INT) USING JSON LOCATION '{path}'")
    with pytest.raises(CatalogError, match="not parquet"):
        check_table(spark, table, df.schema, path, ())
    spark.sql(f"DROP TABLE {table}")
