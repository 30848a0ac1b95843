"""Readers and writers: options, round trips and running twice."""

import datetime as dt
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.sources import readers, workspace, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_jdbc_options():
    spark = MagicMock()
    readers.scan_jdbc(spark, "jdbc:x", "T", {"user": "u"})
    spark.read.jdbc.assert_called_with(url="jdbc:x", table="T", properties={"user": "u"})
    readers.scan_jdbc(spark, "jdbc:x", "T", {}, column="ID", bounds=(1, 100), num_partitions=8)
    spark.read.jdbc.assert_called_with(
        url="jdbc:x", table="T", properties={}, column="ID", lowerBound=1, upperBound=100, numPartitions=8
    )
    readers.scan_jdbc(spark, "jdbc:x", "T", {}, predicates=["ID < 5", "ID >= 5"])
    assert spark.read.jdbc.call_args.kwargs["predicates"] == ["ID < 5", "ID >= 5"]
    with pytest.raises(ValueError, match="bounds"):
        readers.scan_jdbc(spark, "jdbc:x", "T", {}, column="ID")


def test_plain_landing_file(spark, tmp_path):
    payload = '{"event_id":"e1","note":"a|b \\\\ \\"c\\"","loan_id":"L"}'
    (tmp_path / "landing.dat").write_text(
        f"k1|0|1001|2024-01-01T00:00:00Z|{payload}\nk2|1|1002||\nk3|zero|1|t|x\nk4|1|2\n"
    )
    found = readers.scan_landing(spark, str(tmp_path), schemas.schema("landing_event"))
    assert rows(found) == [
        ("k1", 0, 1001, "2024-01-01T00:00:00Z", payload, False),
        ("k2", 1, 1002, None, None, False),
        (None, None, None, None, "k3|zero|1|t|x", True),
        (None, None, None, None, "k4|1|2", True),
    ]


def test_lines_that_do_not_fit_fail_the_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a|1\nb|two\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.scan_pipe_csv(spark, str(tmp_path), spark.createDataFrame([], "a string, b int").schema).collect()


def test_pipe_round_trip(spark, tmp_path):
    values = [("", None), ("a|b", 'q"uote'), ("back\\slash", "{'x'}"), (" spaced ", "\\"), (None, "")]
    values += [("a\nb", "\r"), ("\\n", '\\"|'), ('"', "\\\\n\n"), ("\\N", "x")]
    frame = spark.createDataFrame(values, "a string, b string")
    writers.write_pipe_csv(frame, str(tmp_path / "p"), null_value="\\N")
    back = readers.scan_pipe_csv(spark, str(tmp_path / "p"), frame.schema, null_value="\\N")
    assert rows(back) == rows(frame)


def test_evolving_columns(spark, tmp_path):
    path = str(tmp_path / "e")
    writers.write_path(spark.sql("select 1 as a"), path)
    both = writers.write_evolving(spark.sql("select 2 as a, 'x' as b"), path)
    assert rows(both) == [(1, None), (2, "x")]
    replaced = writers.write_evolving(spark.sql("select 3 as a, 'y' as c"), path, mode="overwrite")
    assert rows(replaced) == [(3, "y")]


def days(spark, *pairs):
    return spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in pairs], "date date, v int")


def test_replace_partition_twice_and_with_an_empty_day(spark, tmp_path):
    path = str(tmp_path / "d")
    writers.replace_partition(days(spark, ("2024-01-01", 1), ("2024-01-02", 9)), path, "date", "2024-01-01")
    second = days(spark, ("2024-01-02", 2))
    for _ in range(2):
        stored = writers.replace_partition(second, path, "date", dt.date(2024, 1, 2))
    assert rows(stored.select("date", "v")) == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)]
    emptied = writers.replace_partition(second.filter("false"), path, "date", "2024-01-01")
    assert rows(emptied.select("date", "v")) == [(dt.date(2024, 1, 2), 2)]


ODD = ["A&B", "007", "08", "a=b", "ü", "a b", "50%", "x/y", "2024-01-05", "{[", None]


def test_partition_values_come_back_as_they_were(spark, tmp_path):
    path = str(tmp_path / "o")
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(ODD)], "v int, k string")
    stored = writers.write_path(frame, path, partition_by=["k"])
    assert rows(stored.select("v", "k")) == rows(frame)
    for n, value in enumerate(ODD):
        new = spark.createDataFrame([(100 + n, value)], "v int, k string")
        stored = writers.replace_partition(new, path, "k", value)
    assert rows(stored.select("v", "k")) == sorted([(100 + i, v) for i, v in enumerate(ODD)], key=str)
    for value in ODD:
        stored = writers.replace_partition(frame.filter("false"), path, "k", value)
    assert stored.count() == 0
    with pytest.raises(Exception, match="empty text"):
        writers.write_path(spark.sql("select 1 as v, '' as k"), path, partition_by=["k"])


def test_write_verified_counts_what_is_stored(spark, tmp_path):
    path = str(tmp_path / "v")
    frame = spark.range(100).selectExpr("id", "id % 3 as part")
    assert writers.write_verified(frame, path, partition_by=["part"]) == 100
    assert writers.write_verified(frame.limit(5), path, mode="append", partition_by=["part"]) == 105
    assert writers.write_verified(frame, path, partition_by=["part"]) == 100
    assert sorted(p.name for p in (tmp_path / "v").glob("part=*")) == ["part=0", "part=1", "part=2"]


def test_even_files_splits_nothing_away(spark, tmp_path):
    frame = spark.range(0, 3000, 1, 8).selectExpr("id", "if(id % 3 = 0, 0, id % 50) as part")
    stored = writers.write_path(frame, str(tmp_path / "e"), partition_by=["part"], even=True)
    assert stored.count() == 3000
    files = list((tmp_path / "e").glob("part=*/*.parquet"))
    assert len(files) < 8 * 50


def test_overwrite_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(spark.range(3), "tallyline_test_table", path=path)
    stored = writers.overwrite_table(spark.range(2), "tallyline_test_table", path=path)
    assert stored.count() == 2
    assert readers.scan_table(spark, "tallyline_test_table").count() == 2
    assert readers.table_or_empty(spark, "tallyline_test_table", stored.schema).count() == 2
    spark.sql("drop table tallyline_test_table")


def test_ordered_columns(spark, tmp_path):
    stored = writers.write_ordered(spark.sql("select 1 as b, 2 as a, 3 as c"), ["a", "b"], str(tmp_path / "o"))
    assert stored.columns == ["a", "b"]


def test_incremental_bounds(spark):
    frame = spark.range(5).selectExpr("id", "make_timestamp(2024, 1, cast(id + 1 as int), 0, 0, 0) as d", "elt(cast(id % 3 as int) + 1, 'ACTIVE', 'PENDING', 'CLOSED') as status")
    since = F.lit("2024-01-03").cast("timestamp")
    assert [r["id"] for r in readers.scan_incremental(frame, "d", since).collect()] == [2, 3, 4]
    assert [r["id"] for r in readers.scan_incremental(frame, "d", since, ["id"], inclusive=False).collect()] == [3, 4]
    tagged = readers.scan_incremental_tagged(frame, "d", since, "s.t", "B1", order=["d", "id"], max_partitions=1)
    assert [r["id"] for r in tagged.collect()] == [3, 4]
    assert {(r["source_table"], r["extraction_batch_id"]) for r in tagged.collect()} == {("s.t", "B1")}


def test_shared_folder_is_required_on_a_cluster(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    cluster = MagicMock()
    cluster.conf.get = lambda key, default=None: {"spark.master": "yarn"}.get(key, default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(cluster)
    cluster.conf.get = lambda key, default=None: {"spark.checkpoint.dir": "s3a://b/x/"}.get(key, default)
    assert workspace.shared_folder(cluster) == "s3a://b/x"


def test_local_session_without_the_setting_gets_one_folder():
    local = MagicMock()
    local.conf.get = lambda key, default=None: {"spark.master": "local[2]", "spark.app.id": "a-1"}.get(key, default)
    folder = workspace.shared_folder(local)
    assert folder == workspace.shared_folder(local)
    assert workspace.new_path(local, "x").startswith(folder)
    assert workspace.new_path(local, "x") != workspace.new_path(local, "x")
