from types import SimpleNamespace

import itertools

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stepweave.config import Job, Source
from stepweave.session import shared_folder
from stepweave.sources import files, inventory, parquet


def _job(**given):
    base = dict(name="j", batch_id=1, database="default", base_path="/b", log_table="l")
    return Job(**{**base, **given})


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_its_shared_folder():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master),
        )

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    assert shared_folder(session("local[2]"))


def test_merged_scan_unites_drifting_schemas(spark, tmp_path):
    path = str(tmp_path / "drift")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(path)
    spark.sql("SELECT 2 AS a, true AS c").write.mode("append").parquet(path)
    rows = {r.a: (r.b, r.c) for r in parquet.scan_parquet_merged(spark, path).collect()}
    assert rows == {1: ("x", None), 2: (None, True)}


def test_merged_scan_refuses_conflicting_types(spark, tmp_path):
    path = str(tmp_path / "conflict")
    spark.sql("SELECT 1 AS a").write.parquet(path)
    spark.sql("SELECT 'x' AS a").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        parquet.scan_parquet_merged(spark, path)


@pytest.mark.parametrize(
    "ids,newest",
    [
        (["20210101000000", "20210927120000", "20201231000000"], "20210927120000"),
        (["99", "100"], "100"),
        (["a", "b"], "b"),
    ],
)
def test_latest_snapshot(spark, tmp_path, ids, newest):
    path = str(tmp_path / "snap")
    for snapshot in ids:
        spark.range(1).select(F.lit(snapshot).alias("v")).write.parquet(
            f"{path}/batch_id={snapshot}"
        )
    (tmp_path / "snap" / "batch_id=99999999999999").mkdir()  # a folder without files
    (tmp_path / "snap" / "_SUCCESS").touch()
    df = parquet.scan_latest_snapshot(spark, path + "/")
    assert df.columns == ["v"]
    assert [r.v for r in df.collect()] == [newest]


def test_no_snapshot_is_an_error(spark, tmp_path):
    (tmp_path / "batch_id=1").mkdir()
    with pytest.raises(parquet.SourceError, match="no snapshot"):
        parquet.scan_latest_snapshot(spark, str(tmp_path))
    with pytest.raises(parquet.SourceError):
        parquet.scan_latest_snapshot(spark, str(tmp_path / "absent"))


def test_materialised_source_keeps_rows_and_cuts_lineage(spark, sf_dir):
    source = f"{sf_dir}/lineitem.parquet"
    job = _job(job_type="historical")
    df = parquet.load_source(spark, Source(source, "li"), job)
    plain = spark.read.parquet(source)
    assert df.schema == plain.schema
    assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()
    assert all(shared_folder(spark) in f for f in df.inputFiles())


def test_load_source_chooses_the_mode(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id AS v", "id AS batch_id").write.partitionBy("batch_id").parquet(path)
    daily = _job(job_type="daily", snapshot_views=("snap",))
    assert parquet.load_source(spark, Source(path, "snap"), daily).columns == ["v"]
    assert spark.table("snap").count() == 1
    # The list of snapshot views is case-sensitive.
    assert parquet.load_source(spark, Source(path, "SNAP"), daily).columns == ["v", "batch_id"]
    assert parquet.load_source(spark, Source(path, "snap"), _job()).count() == 3
    assert spark.table("snap").count() == 3  # the last registration wins


def test_cached_sources_are_on_disk_only(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(3).write.parquet(path)
    df = parquet.load_source(spark, Source(path, "c", cache=True), _job())
    level = df.storageLevel
    assert level.useDisk and not level.useMemory
    df.unpersist()


def test_table_exists(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS default.here (a INT) USING PARQUET")
    assert parquet.table_exists(spark, "default.here")
    assert not parquet.table_exists(spark, "default.not_here")


def test_file_inventory(spark, tmp_path):
    for name in ["a/1.txt", "a/2.txt", "b/c/3.txt"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("xy")
    everything = files.file_inventory(spark, str(tmp_path)).orderBy("path").collect()
    assert [r.path.rsplit("/", 1)[1] for r in everything] == ["1.txt", "2.txt", "3.txt"]
    assert {r["size"] for r in everything} == {2}
    after = files.file_inventory(spark, str(tmp_path), start_after=everything[0].path, limit=1)
    assert [r.path for r in after.collect()] == [everything[1].path]
    listed = files._listed(spark, str(tmp_path), everything[0].path, None)
    assert listed.columns == after.columns and dict(listed.dtypes) == dict(after.dtypes)
    assert sorted(map(tuple, listed.collect())) == [tuple(r) for r in everything[1:]]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_read_text(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(b"a\r\nb\n\nc\n")
    path = str(tmp_path / "t.txt")
    assert [r.value for r in files.read_lines(spark, path).collect()] == ["a", "b", "", "c"]
    assert files.read_whole(spark, path).first().value == "a\r\nb\r\n\r\nc"
    assert files.read_whole(spark, path, "\n").first().value == "a\nb\n\nc"
    assert files.read_whole(spark, path, None).first().value == "a\r\nb\n\nc\n"


def _maps(spark, tmp_path, text, **given):
    (tmp_path / "h.txt").write_text(text)
    df = files.read_header_map(spark, str(tmp_path / "h.txt"), **given)
    return [r.attributes for r in df.collect()]


def test_header_map(spark, tmp_path):
    text = "id,name,note\n1,a,x\n2,b\n3,,\n\n,,z\n,,\n\"q,r\",s\n"
    assert _maps(spark, tmp_path, text) == [
        {"id": "1", "name": "a", "note": "x"},
        {"id": "2", "name": "b"},
        {"id": "3"},
        {"id": ""},
        {"id": "", "name": "", "note": "z"},
        {},
        {"id": '"q', "name": 'r"', "note": "s"},
    ]


def test_header_map_splits_on_a_pattern(spark, tmp_path):
    assert _maps(spark, tmp_path, "a|b\n1|2\n", delimiter=r"\|") == [{"a": "1", "b": "2"}]


def test_header_map_with_a_name_twice_keeps_the_last_field(spark, tmp_path):
    assert _maps(spark, tmp_path, "a,a,b\n1,2,3\n4\n") == [{"a": "2", "b": "3"}, {"a": "4"}]


def test_header_map_line_like_the_header(spark, tmp_path):
    assert _maps(spark, tmp_path, "a,b\na,b\n") == [{"a": "a", "b": "b"}]


def test_header_map_with_too_many_fields_is_an_error(spark, tmp_path):
    with pytest.raises(PySparkException, match="more fields than the header"):
        _maps(spark, tmp_path, "a\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        _maps(spark, tmp_path, "")


def test_header_map_of_an_object_in_many_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = _maps(spark, tmp_path, "a,b\n" + "".join(f"{i},x\n" for i in range(3000)))
        assert sorted(int(m["a"]) for m in got) == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split", [None, "40"])
def test_header_maps_of_several_objects(spark, tmp_path, monkeypatch, split):
    """Each has a header of its own; one is empty, one has its header only."""
    texts = {"a": "x,y\n1,2\nx,y\n" + "7,8\n" * 30, "b": "y,z,y\n3,4,5\n6\n", "c": "", "d": "q\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        monkeypatch.setattr(files, "BROADCAST_OBJECTS", 1)
    try:
        df = files.read_header_map(spark, str(tmp_path), object_column="of")
        got = sorted((r.of.rsplit("/", 1)[1], sorted(r.attributes.items())) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [("a.txt", [("x", "1"), ("y", "2")]), ("a.txt", [("x", "x"), ("y", "y")])]
    want += [("a.txt", [("x", "7"), ("y", "8")])] * 30
    want += [("b.txt", [("y", "5"), ("z", "4")]), ("b.txt", [("y", "6")])]
    assert got == sorted(want)
    (tmp_path / "none").mkdir()
    for name in "cd":
        (tmp_path / "none" / name).write_text("")
    with pytest.raises(ValueError, match="no header"):
        files.read_header_map(spark, str(tmp_path / "none"))


def _tree(tmp_path):
    names = [f"d{d}/e{e}/f{f}.bin" for d in range(4) for e in range(5) for f in range(6)]
    names += ["d1.bin", "d1/e1.bin", "z/_hidden/x", "z/.x", "z/_k=1/y", "a b%/ü.bin"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    shown = [n for n in names if "_hidden" not in n and "/.x" not in n]
    return sorted(f"file:{tmp_path}/{name}" for name in shown)


def test_an_inventory_is_in_the_order_of_its_paths(spark, tmp_path):
    want = _tree(tmp_path)
    path = str(tmp_path)
    assert sorted(r.path for r in files.file_inventory(spark, path).collect()) == want
    for start in (None, want[0], want[17], want[-1], f"file:{tmp_path}/d1/e2", f"file:{tmp_path}/d2/"):
        behind = [p for p in want if start is None or p > start]
        found = files.file_inventory(spark, path, start_after=start)
        assert sorted(r.path for r in found.collect()) == behind
        for limit in (0, 1, 9, 1000):
            first = files.file_inventory(spark, "file:" + path, start, limit).collect()
            assert [r.path for r in first] == behind[:limit]
    assert [r.path for r in files.file_inventory(spark, want[3].removeprefix("file:")).collect()] == [want[3]]
    (tmp_path / "empty").mkdir()
    assert files.file_inventory(spark, str(tmp_path / "empty")).isEmpty()


def test_an_inventory_lists_what_it_needs_only(tmp_path):
    want = _tree(tmp_path)
    lister = inventory.Lister(str(tmp_path))
    everything = list(lister.files(lister.start(), None))
    assert [p.path for p in everything] == want
    pages = lister.pages
    for start, limit, most in ((None, 3, 4), (want[60], 3, 6), (want[-2], 5, 6)):
        lister = inventory.Lister(str(tmp_path))
        list(itertools.islice(lister.files(lister.start(), start), limit))
        assert lister.pages <= most < pages / 4
