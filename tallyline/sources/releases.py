"""Publishing several tables as one: each run has folders of its own, and counts from its marker on.

A table is written once, below ``<folder>/<table>/run=N``, and checked there. When all tables
of the run are written and have passed, the run's marker is put, and with it all tables are
published together; nothing is copied, and a run that dies before leaves every table of
the last one. Catalog tables are then pointed at the run's folders, which moves no data either; a
later run points them again if this one dies in between. The runs before the last are removed, but
for those that readers may still have open.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyline.sources import keyed
from tallyline.sources.readers import scan_path
from tallyline.sources.writers import NULL_FOLDER, write_path

Step = Callable[[dict[str, DataFrame]], DataFrame]


def last_run(spark: SparkSession, folder: str) -> int:
    """Number of the published run, 0 before the first."""
    done = keyed.runs(spark, folder)
    return done[-1].number if done else 0


def read(
    spark: SparkSession, folder: str, name: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """A table of the published run; ``schema`` keeps the types of partition columns."""
    number = last_run(spark, folder)
    if not number:
        raise FileNotFoundError(f"nothing is published below {folder}")
    return scan_path(spark, keyed.folder_of(folder, name, number), fmt, schema)


def release(
    spark: SparkSession,
    folder: str,
    steps: Mapping[str, Step],
    check: Callable[[str, DataFrame], None] | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    database: str | None = None,
    fmt: str = "parquet",
    keep: int = 2,
) -> dict[str, DataFrame]:
    """Write the tables of a run in order, check each, and publish all or none.

    A step gets the tables written before it and returns its rows. ``check`` raises for a table
    that must not be published; what the run wrote is then left to the next run, which writes over
    it. With ``database`` the catalog tables of that name show the run, created where they do
    not exist. The last ``keep`` runs stay on disk.
    """
    number = last_run(spark, folder) + 1
    stored: dict[str, DataFrame] = {}
    for name, step in steps.items():
        columns = (partition_by or {}).get(name)
        stored[name] = write_path(
            step(stored), keyed.folder_of(folder, name, number), fmt=fmt, partition_by=columns
        )
        if check is not None:
            check(name, stored[name])
    keyed.finish(spark, folder, keyed.Run(number, len(steps)))
    if database is not None:
        for name, rows in stored.items():
            point(rows, f"{database}.{name}", keyed.folder_of(folder, name, number), (partition_by or {}).get(name), fmt)
    for name in steps:
        for old in keyed.runs(spark, folder):
            if old.number <= number - keep:
                keyed.remove(spark, keyed.folder_of(folder, name, old.number))
    return stored


def point(
    rows: DataFrame, table: str, path: str, partition_by: Sequence[str] | None = None, fmt: str = "parquet"
) -> None:
    """Let a catalog table show the folder that holds ``rows``.

    New columns are added to the table first, and older readers see NULL in them; a column that is
    gone or has another type fails, as the table could not show both.
    """
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{parts} LOCATION '{_quoted(path)}'")
    else:
        shown = {f.name: f.dataType for f in spark.table(table).schema}
        given = {f.name: f.dataType for f in rows.schema}
        changed = [c for c, kind in shown.items() if given.get(c) != kind]
        if changed:
            raise ValueError(f"columns of {table} are gone or have another type: {changed}")
        fresh = [f"`{c}` {kind.simpleString()}" for c, kind in given.items() if c not in shown]
        if fresh:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(fresh)})")
        if partition_by:
            _forget_partitions(spark, table)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(path)}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


def _forget_partitions(spark: SparkSession, table: str) -> None:
    """Drop the catalog's list of partitions, which lie below the former folder; files stay."""

    def named(part: str) -> str:
        column, value = part.split("=", 1)
        # names of folders have special characters as percent codes
        return f"`{column}` = " + ("NULL" if value == NULL_FOLDER else f"'{_quoted(unquote(value))}'")

    listed = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    if listed:
        parts = ", ".join(f"PARTITION ({', '.join(map(named, parts))})" for parts in listed)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
