import json
import os
import time
from pathlib import Path

import pytest

from stepweave.__main__ import main
from stepweave.config import STEP_TYPE, ConfigError, parse_job, write_files
from stepweave.operators import catalog
from stepweave.operators.joblog import JobLog, refresh_log_table
from stepweave.operators.lookups import BROADCAST_SETTING
from stepweave.operators.publish import EFFECTIVE_KEY as KEY
from stepweave.plans.job import run_job, run_job_file
from stepweave.plans.step import StepFailed
from stepweave.session import (
    matching_folders,
    run_scratch,
    scratch_path,
    shared_folder,
    sweep_scratch,
)

GIVEN = {"jobName": "nightly", "batchId": "20210502120001", "s3SecretKey": "hush"}


def _step(table, sql, **more):
    return {
        "stepType": STEP_TYPE.title(),
        "stepCategory": "object",
        "hiveTableName": table,
        "sourceJoinSQL": sql,
        "partitionColumnList": [KEY],
        **more,
    }


def _config(base, *steps, **more):
    return {
        "projectName": "p",
        "basePath": str(base),
        "projectDB": "default",
        "jobLogTableName": "log_" + base.name,
        "jobType": "daily",
        "stepList": list(steps),
        **more,
    }


def test_defaults_and_limits():
    cases = {"": 20, "x": 20, "5.0": 20, "0": 1, "-3": 1, "7": 7, "41": 40}
    assert {v: write_files(v) for v in cases} == cases


def test_parsing(tmp_path):
    step = _step(
        " t ",
        " SELECT 1 ",
        numOfWriteRepartition=99,
        partitionColumnList=[" a ", {"value": "b"}],
        sourceJoinTableList={"sourcePath": "/s", "viewName": "v", "cacheFlag": "TRUE"},
        lookupList=[
            {
                "lookupListName": "l",
                "lookupListType": "ID",
                "lookupListSourcePath": "/l",
                "lookupListSourceSQL": "SELECT 1",
            }
        ],
        preDerivedColumnList=[{"colExpression": "1", "colAlias": "x"}],
        postDerivedColumnList="",
    )
    relation = {**step, "stepCategory": "Relationship"}
    other = {**step, "stepCategory": "other"}
    ignored = {**step, "stepType": "ingestion"}
    config = _config(
        tmp_path, step, relation, other, ignored, sourceJoinSnapshotTablesList="a, b ,,c"
    )
    job = parse_job(json.dumps(config), GIVEN)
    assert (job.name, job.batch_id, job.job_type) == ("nightly", 20210502120001, "daily")
    assert job.snapshot_views == ("a", "b", "c")
    assert len(job.steps) == 3
    first = job.steps[0]
    assert (first.table, first.sql, first.write_files) == ("t", "SELECT 1", 40)
    assert first.partition_columns == ("a", "b")
    assert [len(s.lookups) for s in job.steps] == [1, 0, 0]
    assert len(job.sources()) == len(job.lookups()) == 1
    assert job.sources()[0].cache and job.lookups()[0].kind == "id"
    assert job.table_name(first) == "default.t"
    assert job.table_path(first) == f"{tmp_path}/t"
    assert first.pre[0].alias == "x" and first.post == ()
    # Only object and relationship steps contribute sources.
    assert parse_job(_config(tmp_path, other), GIVEN).sources() == []


def test_bucket_and_folder_make_the_base_path(tmp_path):
    config = _config(tmp_path)
    del config["basePath"]
    config |= {"s3Bucket": "some-bucket", "s3ProjectFolder": "a/b"}
    assert parse_job(config, GIVEN).log_path.startswith("s3a://some-bucket/a/b/log_")


@pytest.mark.parametrize(
    "change", [{"projectDB": None}, {"stepList": [{"stepType": STEP_TYPE}]}, {"stepList": 5}]
)
def test_missing_settings_are_named(tmp_path, change):
    with pytest.raises(ConfigError):
        parse_job({**_config(tmp_path), **change}, GIVEN)


def test_the_batch_id_is_a_number(tmp_path):
    for bad in ({}, {"batchId": "x"}):
        with pytest.raises(ConfigError, match="batchId"):
            parse_job(_config(tmp_path), bad)


def test_job_log(spark, tmp_path):
    path, table = str(tmp_path / "log"), "default.some_log"
    log = JobLog(spark, path, "j", 7)
    log.info("s1", "m1")
    log.warn("s2", "m2")
    log.flush()
    log.flush()
    log.error("s3", "m3")
    refresh_log_table(spark, table, path)
    rows = spark.table(table).orderBy("step").collect()
    assert [(r.level, r.step, r.msg, r.job_name, r.batch_id) for r in rows] == [
        ("INFO", "s1", "m1", "j", 7),
        ("WARN", "s2", "m2", "j", 7),
        ("ERROR", "s3", "m3", "j", 7),
    ]
    assert len(rows[0].time) == len("2021-01-01 00:00:00")
    assert len(spark.read.parquet(path).inputFiles()) == 2
    JobLog(spark, path, "j", 8).error("s", "m")
    refresh_log_table(spark, table, path)
    assert spark.table(table).count() == 4


def _whole_job(spark, base, sf_dir):
    source = lambda view, **more: {
        "sourcePath": f"{sf_dir}/{view}.parquet",
        "viewName": view,
        **more,
    }
    step = _step(
        "orders_" + base.name,
        "SELECT o_orderkey AS order_id, CAST(o_custkey AS DOUBLE) AS cust_id, "
        f"concat(',', o_custkey, ',') AS codes, CAST(20210927000000 + month(o_orderdate) AS BIGINT) "
        f"AS {KEY}, o_orderstatus AS status FROM orders",
        sourceJoinTableList=[source("orders", cacheFlag="true")],
        lookupList=[
            {
                "lookupListName": "customers",
                "lookupListType": "id",
                "lookupListSourcePath": f"{sf_dir}/customer.parquet",
                "lookupListSourceSQL": "SELECT c_custkey, c_name FROM customers",
            }
        ],
        partitionColumnList=[KEY, "status"],
        preDerivedColumnList=[
            {
                "colExpression": "CAST(batchId AS LONG)",
                "colSource": "param",
                "colSourceExpression": "batchId",
                "colAlias": "run",
            }
        ],
        postDerivedColumnList=[
            {
                "colExpression": "lookupValueByIdList('customers', codes, ',', ';', 'NA')",
                "colAlias": "names",
            }
        ],
    )
    return _config(base, step), step["hiveTableName"]


def test_a_whole_job(spark, tmp_path, sf_dir):
    config, name = _whole_job(spark, tmp_path, sf_dir)
    for _ in range(2):
        assert run_job(spark, config, GIVEN) == [f"default.{name}"]
    rows = spark.table(name)
    assert rows.columns == ["run", "order_id", "cust_id", "codes", "names", KEY, "status"]
    assert dict(rows.dtypes)["cust_id"] == "bigint"
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("o")
    spark.read.parquet(f"{sf_dir}/customer.parquet").createOrReplaceTempView("c")
    expected = spark.sql(
        "SELECT o_orderkey, o_custkey, c_name, o_orderstatus FROM o JOIN c ON o_custkey = c_custkey"
    )
    got = rows.select("order_id", "cust_id", "names", "status")
    assert got.count() == expected.count() and got.exceptAll(expected).isEmpty()
    assert {r.run for r in rows.select("run").distinct().collect()} == {20210502120001}
    log = spark.table(config["jobLogTableName"])
    sizes = log.where("msg LIKE 'customers has %'").select("msg").distinct().collect()
    assert [r.msg for r in sizes] == ["customers has 150 keys"]
    assert log.where("level <> 'INFO'").isEmpty()


def test_later_steps_may_read_earlier_stages(spark, tmp_path):
    first, second = "a_" + tmp_path.name, "b_" + tmp_path.name
    config = _config(
        tmp_path,
        _step(
            first,
            f"SELECT 1.5D AS x_id, 1L AS {KEY}",
            preDerivedColumnList=[{"colExpression": "x_id + 1", "colAlias": "y"}],
        ),
        _step(
            second,
            f"SELECT s.x_id AS raw, c.x_id AS x_id, o.y, o.{KEY} FROM dfSource0__default_{first} s "
            f"JOIN dfSource__default_{first} c USING ({KEY}) "
            f"JOIN dfSource__DerivedColumns__default_{first} o USING ({KEY})",
        ),
    )
    run_job(spark, config, GIVEN)
    row = spark.table(second).first()
    assert (row.raw, row.x_id, row.y) == (1.5, 1, 2)


def test_the_command_line(spark, tmp_path, sf_dir):
    config, name = _whole_job(spark, tmp_path, sf_dir)
    path = tmp_path / "job=1.json"
    path.write_text(json.dumps(config))
    main([f"{k}={v}" for k, v in {**GIVEN, "configFileFullPath": str(path)}.items()])
    assert spark.table(name).count() > 0


def test_a_job_from_a_file(spark, tmp_path, sf_dir):
    config, name = _whole_job(spark, tmp_path, sf_dir)
    path = tmp_path / "job.json"
    path.write_text(json.dumps(config, indent=2))
    assert run_job_file(spark, {**GIVEN, "configFileFullPath": str(path)}) == [f"default.{name}"]


def test_the_first_failure_stops_the_job(spark, tmp_path):
    good = f"SELECT 1 AS v, 1L AS {KEY}"
    steps = [
        _step("good_" + tmp_path.name, good),
        _step("bad_" + tmp_path.name, good.replace("1 AS v", "absent AS v")),
        _step("late_" + tmp_path.name, good),
    ]
    config = _config(tmp_path, *steps)
    with pytest.raises(Exception, match="absent"):
        run_job(spark, config, GIVEN)
    assert (tmp_path / steps[0]["hiveTableName"]).exists()
    assert not (tmp_path / steps[1]["hiveTableName"]).exists()
    assert not (tmp_path / steps[2]["hiveTableName"]).exists()
    log = spark.read.parquet(f"{tmp_path}/{config['jobLogTableName']}")
    errors = log.where("level = 'ERROR'").collect()
    assert len(errors) == 1
    assert errors[0].step == f"run_job, default.{steps[1]['hiveTableName']}, Generate output"
    assert errors[0].msg.startswith("failed: ")


@pytest.mark.parametrize(
    "change,message",
    [
        ({"sourceJoinSQL": "SELECT 1 AS v"}, KEY),
        ({"sourceJoinSQL": f"SELECT CAST(NULL AS BIGINT) AS {KEY}, 1 AS v"}, "is null"),
        ({"preDerivedColumnList": [{"colExpression": "p", "colSource": "param",
          "colSourceExpression": "p", "colAlias": "x"}]}, "there is no parameter"),
        ({"postDerivedColumnList": [{"colExpression": "lookupValueByNoList('t')",
          "colAlias": "x"}]}, "lookupValueByNoList"),
        ({"partitionColumnList": ["absent"]}, "absent"),
    ],
)
def test_failures_are_clear_and_publish_nothing(spark, tmp_path, change, message):
    step = _step("t_" + tmp_path.name, f"SELECT 1 AS v, 1L AS {KEY}", **change)
    config = _config(tmp_path, step)
    with pytest.raises(Exception, match=message):
        run_job(spark, config, GIVEN)
    assert not list(tmp_path.glob("t_*/**/*.parquet"))
    log = spark.read.parquet(f"{tmp_path}/{config['jobLogTableName']}")
    assert log.where("level = 'ERROR'").count() == 1


def test_a_source_that_is_missing_fails_the_job(spark, tmp_path):
    step = _step(
        "t_" + tmp_path.name,
        f"SELECT 1L AS {KEY} FROM s",
        sourceJoinTableList=[{"sourcePath": f"{tmp_path}/none", "viewName": "s"}],
    )
    config = _config(tmp_path, step, sourceJoinSnapshotTablesList="s")
    with pytest.raises(Exception, match="no snapshot"):
        run_job(spark, config, GIVEN)
    log = spark.read.parquet(f"{tmp_path}/{config['jobLogTableName']}")
    assert log.where("level = 'ERROR'").first().step == "run_job, prepare"


def test_no_steps_is_a_warning(spark, tmp_path):
    config = _config(tmp_path)
    assert run_job(spark, config, GIVEN) == []
    assert [r.level for r in spark.table(config["jobLogTableName"]).collect()] == ["WARN"]


def test_an_existing_table_is_never_listed(spark, tmp_path, sf_dir, monkeypatch):
    config, name = _whole_job(spark, tmp_path, sf_dir)
    run_job(spark, config, GIVEN)
    rows = spark.table(name).count()

    def listed(*args):
        raise AssertionError("the whole table is listed")

    monkeypatch.setattr(catalog, "repair_partitions", listed)
    for batch in ("20210502120001", "20210502120002"):
        run_job(spark, config, GIVEN | {"batchId": batch})
        assert spark.table(name).count() == rows
        assert {r.run for r in spark.table(name).select("run").distinct().collect()} == {int(batch)}
    log = spark.table(config["jobLogTableName"])
    assert log.select("batch_id").distinct().count() == 2


def test_a_table_at_another_place_stops_the_step_before_it_writes(spark, tmp_path, sf_dir):
    config, name = _whole_job(spark, tmp_path / "first", sf_dir)
    run_job(spark, config, GIVEN)
    rows = spark.table(name).count()
    moved = config | {"basePath": str(tmp_path / "second")}
    with pytest.raises(StepFailed, match="lies at"):
        run_job(spark, moved, GIVEN)
    assert not (tmp_path / "second" / name).exists()
    assert spark.table(name).count() == rows


@pytest.mark.parametrize("sql", [None, "SELECT no_such_column FROM orders"])
def test_scratch_goes_after_a_good_and_a_failed_job(spark, tmp_path, sf_dir, sql):
    config, _ = _whole_job(spark, tmp_path, sf_dir)
    config["jobType"] = "historical"
    if sql:
        config["stepList"][0]["sourceJoinSQL"] = sql
    spark.conf.set(BROADCAST_SETTING, "-1")  # lookups are files too
    seen = []
    try:
        if sql:
            with pytest.raises(StepFailed):
                run_job(spark, config, GIVEN)
        else:
            run_job(spark, config, GIVEN)
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    seen = matching_folders(spark, f"{shared_folder(spark)}/stepweave/runs/*")
    assert seen == []


def test_scratch_of_dead_runs_is_swept(spark):
    with run_scratch(spark):
        live = scratch_path(spark, "live")
        spark.range(1).write.parquet(live)
        dead = f"{shared_folder(spark)}/stepweave/runs/dead"
        spark.range(1).write.parquet(f"{dead}/x")
        long_ago = time.time() - 3600
        for file in [Path(dead), *Path(dead).rglob("*")]:
            os.utime(file, (long_ago, long_ago))
        assert len(sweep_scratch(spark, 0.5)) == 1
        assert not Path(dead).exists() and Path(live).exists()
    assert not Path(live).exists()
    assert Path(scratch_path(spark, "kept")).parent.name == "stepweave"
