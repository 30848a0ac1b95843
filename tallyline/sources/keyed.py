"""Stored tables with one current row per key: a base in buckets of keys, and the changes since.

Below a path lie ``base/run=N/key_bucket=B`` with all current rows as of run N, ``changes/run=N``
with the rows that run N made current, and ``_runs`` with a marker per finished run. A run
writes its own folders only and counts from its marker on, which is put last; so a run that
fails leaves the table as it was, and the next one writes over what it left behind. What
a run writes grows with the keys it changes. When the changes since the base reach a quarter of
its size, a new base is written; so each row is rewritten about once per quarter of the table
that changes. The number of buckets follows the size of the table.

A row with ``is_gone`` says that its key has no current row; it stays, so that what is known of
the key and when it went is not lost.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tallyline.operators.windows import latest_per_key
from tallyline.sources.writers import even_files

GONE, RUN, BUCKET = "is_gone", "run", "key_bucket"
BASE, CHANGES, RUNS = "base", "changes", "_runs"
BUCKET_BYTES = 128 << 20
# Share of the base that the changes may reach before a new base is written.
COMPACT_AT = 0.25


class Run(NamedTuple):
    number: int
    buckets: int  # of a base; 0 for changes


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored below a path of any file system that Spark reads."""
    files, folder = _files(spark, path)
    return files.exists(folder)


def size(spark: SparkSession, path: str) -> int:
    files, folder = _files(spark, path)
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _files(spark, path)
    files.delete(folder, True)


def runs(spark: SparkSession, path: str) -> list[Run]:
    """Finished runs in order."""
    files, folder = _files(spark, f"{path}/{RUNS}")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(Run(*map(int, name.split("-"))) for name in names)


def finish(spark: SparkSession, path: str, run: Run) -> None:
    """Make a run count. Fails if another one finished under its number."""
    files, marker = _files(spark, f"{path}/{RUNS}/{run.number:08d}-{run.buckets}")
    if any(r.number >= run.number for r in runs(spark, path)):
        raise FileExistsError(f"run {run.number} of {path} is finished already")
    files.create(marker, False).close()


def codec(fmt: str) -> str | None:
    """Compression of stored rows, much of which are keys and hashes that zstd halves."""
    return "zstd" if fmt == "parquet" else None


def writer(rows: DataFrame, fmt: str):
    """A writer in place of what is there."""
    out = rows.write.format(fmt).mode("overwrite")
    return out.option("compression", codec(fmt)) if codec(fmt) else out


def folder_of(path: str, part: str, number: int) -> str:
    return f"{path}/{part}/{RUN}={number:08d}"


def with_gone(schema: StructType) -> StructType:
    """A table's schema with the flag of gone keys."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema] + [StructField(GONE, BooleanType(), True)])


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def named_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """Buckets that hold the keys; at most as many as there are."""
    return [r[0] for r in keys.select(key_bucket(key, buckets)).distinct().collect()]


def scan_part(
    spark: SparkSession, path: str, part: str, schema: StructType, low: int, high: int, fmt: str = "parquet"
) -> DataFrame | None:
    """Rows of a part that runs above ``low`` and up to ``high`` wrote, with the run; None if it has no folder."""
    if not exists(spark, f"{path}/{part}"):
        return None
    fields = [*schema.fields, StructField(RUN, IntegerType(), True)]
    rows = spark.read.format(fmt).schema(StructType(fields)).load(f"{path}/{part}")
    return rows.filter((F.col(RUN) > low) & (F.col(RUN) <= high))


def heads(
    spark: SparkSession, path: str, schema: StructType, key: str, keys: DataFrame | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The newest row of each key, gone ones included; with ``keys`` those of these keys only.

    The base is read where the keys' buckets are. Rows of the base give way to changes of their
    key, which are found by keys alone.
    """
    done = runs(spark, path)
    base = [r for r in done if r.buckets][-1]
    schema = with_gone(schema)
    fields = [*schema.fields, StructField(BUCKET, IntegerType(), True)]
    rows = spark.read.format(fmt).schema(StructType(fields)).load(folder_of(path, BASE, base.number))
    if keys is not None and base.buckets > 1:
        rows = rows.filter(F.col(BUCKET).isin(named_buckets(keys, key, base.buckets)))
    rows = of_keys(rows.drop(BUCKET), keys, key)
    changed = scan_part(spark, path, CHANGES, schema, base.number, done[-1].number, fmt)
    if changed is None or done[-1].number == base.number:
        return rows
    newest = latest_per_key(of_keys(changed, keys, key), [key], [RUN]).drop(RUN)
    return of_keys(rows, newest, key, "left_anti").unionByName(newest)


def of_keys(rows: DataFrame, keys: DataFrame | None, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among the keys (or is not), NULL being a key like others.

    Keys may repeat: neither join needs them once, and making them so would take a shuffle and
    a table of them in each task.
    """
    if keys is None:
        return rows
    named = keys.select(F.col(key).alias("__key"))
    return rows.join(named, rows[key].eqNullSafe(named["__key"]), how)


def write_heads(
    changed: DataFrame, path: str, key: str, number: int, buckets: int | None = None, fmt: str = "parquet"
) -> Run:
    """Write the changed heads of a run: the base of a new table, changes of another. To be finished.

    ``changed`` is stored already, so its size is known from its files.
    """
    spark = changed.sparkSession
    if runs(spark, path):
        writer(changed, fmt).save(folder_of(path, CHANGES, number))
        return Run(number, 0)
    return _write_base(changed, path, key, number, buckets or 1 + size_of(changed) // BUCKET_BYTES, fmt)


def size_of(stored: DataFrame) -> int:
    """Bytes of the files that a stored frame reads."""
    return sum(size(stored.sparkSession, f) for f in stored.inputFiles())


def _write_base(rows: DataFrame, path: str, key: str, number: int, buckets: int, fmt: str) -> Run:
    placed = even_files(rows.withColumn(BUCKET, key_bucket(key, buckets)), BUCKET)
    writer(placed, fmt).partitionBy(BUCKET).save(folder_of(path, BASE, number))
    return Run(number, buckets)


def compact(
    spark: SparkSession, path: str, schema: StructType, key: str, buckets: int | None = None,
    fmt: str = "parquet", at: float = COMPACT_AT,
) -> bool:
    """Write a new base if the changes have reached their share of the old one.

    The base before the last, and changes up to it, are removed; the last one stays for those
    who began to read it.
    """
    done = runs(spark, path)
    bases = [r.number for r in done if r.buckets]
    old = size(spark, folder_of(path, BASE, bases[-1]))
    fresh = sum(size(spark, folder_of(path, CHANGES, r.number)) for r in done if r.number > bases[-1])
    if not fresh or fresh < at * old:
        return False
    number = done[-1].number + 1
    rows = heads(spark, path, schema, key, fmt=fmt)
    finish(spark, path, _write_base(rows, path, key, number, buckets or 1 + (old + fresh) // BUCKET_BYTES, fmt))
    for r in done:
        if r.number < bases[-1]:
            remove(spark, folder_of(path, BASE if r.buckets else CHANGES, r.number))
    return True
