"""Tables published together: nothing half done, nothing written twice."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallyline.plans import amendments, domain, regulatory
from tallyline.sources import keyed, releases

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark):
    name = f"released_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def frames(spark, n):
    return {
        "a": lambda _: spark.range(n).withColumn("v", F.lit(n)),
        "b": lambda done: done["a"].withColumn("w", F.col("v") * 2),
    }


def counts(spark, folder, database=None):
    names = ("a", "b")
    found = [releases.read(spark, str(folder), t).count() for t in names]
    if database:
        assert [spark.table(f"{database}.{t}").count() for t in names] == found
    return found


def test_a_run_that_dies_between_tables_leaves_both(spark, tmp_path, database):
    releases.release(spark, str(tmp_path), frames(spark, 3), database=database)

    def dies(_):
        raise RuntimeError("died")

    with pytest.raises(RuntimeError):
        releases.release(spark, str(tmp_path), {**frames(spark, 5), "b": dies}, database=database)
    assert counts(spark, tmp_path, database) == [3, 3]

    def refuses(name, rows):
        if name == "b":
            raise ValueError("check failed")

    with pytest.raises(ValueError, match="check failed"):
        releases.release(spark, str(tmp_path), frames(spark, 6), refuses, database=database)
    assert counts(spark, tmp_path, database) == [3, 3]
    releases.release(spark, str(tmp_path), frames(spark, 7), database=database)
    assert counts(spark, tmp_path, database) == [7, 7]


def test_catalog_tables_left_behind_are_pointed_again(spark, tmp_path, database, monkeypatch):
    releases.release(spark, str(tmp_path), frames(spark, 3), database=database)
    real = releases.point

    def once(rows, table, *rest):
        if table.endswith(".b"):
            raise RuntimeError("died")
        real(rows, table, *rest)

    with monkeypatch.context() as m:
        m.setattr(releases, "point", once)
        with pytest.raises(RuntimeError):
            releases.release(spark, str(tmp_path), frames(spark, 5), database=database)
    # both can be read whole, the second one as it was
    assert [spark.table(f"{database}.{t}").count() for t in "ab"] == [5, 3]
    releases.release(spark, str(tmp_path), frames(spark, 8), database=database)
    assert counts(spark, tmp_path, database) == [8, 8]


def test_each_table_is_written_once_and_old_runs_go(spark, tmp_path):
    for n in (2, 3, 4):
        releases.release(spark, str(tmp_path), frames(spark, n))
    assert {p.name for p in tmp_path.iterdir()} == {"a", "b", "_runs"}
    assert {p.name for p in (tmp_path / "a").iterdir()} == {"run=00000002", "run=00000003"}
    assert releases.last_run(spark, str(tmp_path)) == 3
    with pytest.raises(FileNotFoundError):
        releases.read(spark, str(tmp_path / "none"), "a")


def test_partitions_and_columns_of_catalog_tables(spark, tmp_path, database):
    def run(rows):
        releases.release(
            spark, str(tmp_path), {"t": lambda _: rows}, partition_by={"t": ["day"]}, database=database
        )
        return sorted(map(tuple, spark.table(f"{database}.t").collect()))

    rows = spark.createDataFrame([(1, "it's 5%"), (2, "x"), (3, "x"), (4, None)], "id int, day string")
    assert run(rows) == [(1, "it's 5%"), (2, "x"), (3, "x"), (4, None)]
    assert run(rows.filter("id = 3")) == [(3, "x")]
    assert run(rows.filter("id <> 3")) == [(1, "it's 5%"), (2, "x"), (4, None)]
    run(rows.filter("id < 3").withColumn("extra", F.col("id") * 10))
    assert {(r["id"], r["extra"]) for r in spark.table(f"{database}.t").collect()} == {(1, 10), (2, 20)}
    with pytest.raises(ValueError, match="extra"):
        run(rows)


def test_reports_are_published_together(spark, tmp_path, database):
    def run(transactions):
        return regulatory.release_reports(
            domain.customers(spark, FOLDER),
            domain.accounts(spark, FOLDER),
            transactions,
            domain.branches(spark, FOLDER),
            domain.branch_details(spark, FOLDER),
            str(tmp_path),
            database=database,
        )

    good = run(domain.transactions(spark, FOLDER))
    before = good.branch_summary.count(), good.customer_transactions.count()
    owed = domain.transactions(spark, FOLDER).withColumn("AMOUNT", -F.col("AMOUNT"))
    with pytest.raises(ValueError, match="check failed"):
        run(owed)
    names = ("branch_summary_report", "aml_customer_transactions")
    assert tuple(spark.table(f"{database}.{t}").count() for t in names) == before
    assert {p.name for p in tmp_path.iterdir()} == {*names, "_runs"}


def test_amendments_are_published_together(spark, tmp_path):
    landing, template = domain.landing(spark, FOLDER), domain.template(spark)
    first = amendments.release_batch(landing, template, str(tmp_path)).count()
    with pytest.raises(Exception, match="insufficient input records"):
        amendments.release_batch(landing.limit(1), template, str(tmp_path), minimum=2)
    for name in ("raw", "assessed"):
        assert releases.read(spark, str(tmp_path), name).count() == first
    assert len(keyed.runs(spark, str(tmp_path))) == 1
