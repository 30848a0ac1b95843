"""History table: a closed row per past version, an open row per key that is still there.

A record's history is a line of events: versions, each with the time from which it holds, and
departures, after which no version holds until the record comes back. A version ends where
the next event starts. Departures are not rows of the history; they are seen where a version
ends and no other one starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallyline.functions.protection import checksum_md5
from tallyline.operators.governance import OPEN_END
from tallyline.sources import keyed
from tallyline.sources.writers import write_path

KEY = "business_key"
START, END, CURRENT = "effective_start_date", "effective_end_date", "is_current"
CHECKSUM = "source_checksum"
CHANGE = "change_hash"
SURROGATE = "surrogate_key"
CLOSED, REPLACED = "closed", "replaced"


def surrogate_key() -> Column:
    """Key of one version: a hash of business key, start and content.

    It is the same on every run and needs no counter shared between tasks.
    """
    start = F.date_format(START, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return checksum_md5([F.col(KEY), start, F.col(CHANGE)])


def first_versions(incoming: DataFrame) -> DataFrame:
    """Open history rows for records never seen before."""
    kind = incoming.schema[START].dataType
    rows = incoming.withColumns({END: F.lit(OPEN_END).cast(kind), CURRENT: F.lit(True)})
    return rows.select(surrogate_key().alias(SURROGATE), "*")


def _departures(departed: DataFrame | None, like: DataFrame) -> DataFrame:
    """(key, start) of departures, none by default."""
    if departed is None:
        return like.select(KEY, START).limit(0)
    return departed.select(F.col(KEY).cast(like.schema[KEY].dataType), F.col(START).cast(like.schema[START].dataType))


def _packed(rows: DataFrame) -> DataFrame:
    """The rows without what can be worked out again: surrogate keys made here, and the text of hexadecimal hashes."""
    own = F.coalesce(F.col(SURROGATE) == surrogate_key(), F.lit(False))
    rows = rows.withColumns({"__own": own, SURROGATE: F.when(~own, F.col(SURROGATE))})
    for k, c in enumerate(_hashes(rows)):
        code = F.unhex(c)
        rows = rows.withColumns({f"__code{k}": code, c: F.when(F.lower(F.hex(code)) == F.col(c), None).otherwise(F.col(c))})
    return rows


def _unpacked(rows: DataFrame) -> DataFrame:
    """What ``_packed`` was given."""
    hashes = _hashes(rows)
    rows = rows.withColumns({c: F.coalesce(c, F.lower(F.hex(f"__code{k}"))) for k, c in enumerate(hashes)})
    rows = rows.withColumn(SURROGATE, F.when(F.col("__own"), surrogate_key()).otherwise(F.col(SURROGATE)))
    return rows.drop("__own", *[f"__code{k}" for k in range(len(hashes))])


def _hashes(rows: DataFrame) -> list[str]:
    return [c for c in (CHANGE, CHECKSUM) if c in rows.columns and isinstance(rows.schema[c].dataType, StringType)]


def _timeline(
    stored: DataFrame, incoming: DataFrame, departed: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """All events of the keys, each with its end, after a batch; rows of keys without events in it as they were.

    ``known`` are departures stored before. Added columns: ``__fresh`` for events of the
    batch, ``__gone`` for departures, ``__end`` and ``__open``, the end and state that the row
    had before. A version equal to the event before it and a departure of what is not there are
    no events. Rows are dealt out by key once, for all steps.
    """
    columns = stored.columns
    kind = stored.schema[END].dataType

    def events_of(rows: DataFrame, fresh: bool, gone: bool) -> DataFrame:
        return rows.withColumns({"__fresh": F.lit(fresh), "__gone": F.lit(gone)})

    events = events_of(_packed(stored), False, False)
    # a new version's surrogate key is made after the rows have moved
    fresh = _packed(incoming.withColumn(SURROGATE, F.lit(None).cast("string"))).withColumn("__own", F.lit(True))
    parts = [events_of(fresh, True, False), events_of(departed, True, True)]
    for part in [*parts, *([] if known is None else [events_of(known, False, True)])]:
        events = events.unionByName(part, allowMissingColumns=True)
    events = _unpacked(events.repartition(KEY).withColumn("__own", F.coalesce("__own", F.lit(False))))

    row = ~F.col("__fresh") & ~F.col("__gone")
    rows_first = Window.partitionBy(KEY).orderBy(row.desc(), START, END)
    follows = F.lead(F.when(row, F.col(START))).over(rows_first)
    events = events.withColumns({"__next": follows, "__named": F.bool_or("__fresh").over(Window.partitionBy(KEY))})
    left = row & F.col("__named") & ~F.col(CURRENT) & ~F.coalesce(F.col("__next") == F.col(END), F.lit(False))
    # a row, and where it ends without a next one the departure after it, from one reading of the rows
    both = F.array(F.lit(False), F.lit(True))
    events = events.withColumn("__gap", F.explode(F.when(left, both).otherwise(F.array(F.lit(False)))))
    at = F.when(F.col("__gap"), F.col(END).cast(stored.schema[START].dataType)).otherwise(F.col(START))
    values = {c: F.when(~F.col("__gap"), F.col(c)) for c in columns if c not in (KEY, START)}
    old = {"__end": F.when(row & ~F.col("__gap"), F.col(END)), "__open": F.when(row & ~F.col("__gap"), F.col(CURRENT))}
    events = events.withColumns(values | old | {START: at, "__gone": F.col("__gone") | F.col("__gap")})

    by_start = Window.partitionBy(KEY).orderBy(START, "__fresh", CHANGE)
    state = F.struct("__gone", CHANGE)
    events = events.withColumn("__before", F.lag(state).over(by_start))
    same = F.col("__before").eqNullSafe(state)
    nothing_left = F.col("__gone") & F.col("__before").isNull()
    events = events.filter(~((F.col("__fresh") | F.col("__gone")) & (same | nothing_left)))
    after = events.withColumn("__next", F.lead(START).over(by_start))
    end = F.coalesce(F.col("__next"), F.lit(OPEN_END)).cast(kind)
    after = after.withColumns(
        {
            END: F.when(F.col("__named"), end).otherwise(F.col(END)),
            CURRENT: F.when(F.col("__named"), F.col("__next").isNull()).otherwise(F.col(CURRENT)),
        }
    )
    return after.select(*columns, "__fresh", "__gone", "__end", "__open")


def scd2_merge(history: DataFrame, incoming: DataFrame, departed: DataFrame | None = None) -> DataFrame:
    """History after a batch of versions and departures, any number per business key.

    A version is new when its change hash differs from that of the version before it by start
    date. Each version ends where the next event of its key starts, and the last is open; so a
    version that arrives late becomes a closed row between its neighbours. ``departed`` (key,
    start) closes the version that holds at that time; a record that comes back has a new
    version even if it has not changed. Running the same batch again changes nothing. NULL is a
    key like others. Rows of keys that the batch does not name pass through as they are. History
    and batch are dealt out by key once, whatever their sizes; ``merge_stored`` is for batches
    that are small beside the history.
    """
    after = _timeline(history, incoming, _departures(departed, history)).filter(~F.col("__gone"))
    return after.select(*history.columns)


def closed_rows(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame | None:
    """Stored rows of past versions, as the last run to touch them left them; None before there are any."""
    last = keyed.runs(spark, path)[-1].number
    rows = keyed.scan_part(spark, path, CLOSED, schema, 0, last, fmt)
    if rows is None:
        return None
    kept = StructType([schema[SURROGATE]])
    replaced = keyed.scan_part(spark, path, REPLACED, kept, 0, last, fmt)
    if replaced is not None:
        replaced = replaced.groupBy(F.col(SURROGATE).alias("__key")).agg(F.max(keyed.RUN).alias("__run"))
        old = (rows[SURROGATE] == replaced["__key"]) & (rows[keyed.RUN] < replaced["__run"])
        rows = rows.join(replaced, old, "left_anti")
    return rows.drop(keyed.RUN)


def read_stored(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The whole history below a path."""
    current = keyed.heads(spark, path, schema, KEY, fmt=fmt).filter(~F.col(keyed.GONE)).drop(keyed.GONE)
    closed = closed_rows(spark, path, schema, fmt)
    return current if closed is None else current.unionByName(closed)


def open_keys(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Keys with an open row."""
    return keyed.heads(spark, path, schema, KEY, fmt=fmt).filter(~F.col(keyed.GONE)).select(KEY)


def merge_stored(
    incoming: DataFrame,
    path: str,
    staging: str,
    buckets: int | None = None,
    fmt: str = "parquet",
    departed: DataFrame | None = None,
) -> DataFrame:
    """Merge a batch into the history below ``path`` and return the whole history.

    Open rows are a keyed table (``keyed``), with a mark for keys that left. Closed rows are only ever added,
    in a folder per run and sorted by their end, so that a reader of some period skips the
    files of others. What a run writes is what it changes: an open row and a closed one for
    each new version. Closed rows are read only if a version starts before the last known event
    of its key, and from its start on; a closed row that such a version cuts short is added
    again and the old one named in ``replaced``. The changes are worked out once, below ``staging``, which is
    removed in the end. Nothing counts before the run is finished, and a batch that changes
    nothing writes nothing.
    """
    spark = incoming.sparkSession
    schema = first_versions(incoming).schema
    known, leaving = None, _departures(departed, incoming)
    stored = spark.createDataFrame([], schema)
    done = keyed.runs(spark, path)
    if done:
        events = incoming.select(KEY, START).unionByName(leaving)
        mine = write_path(keyed.heads(spark, path, schema, KEY, events, fmt), f"{staging}/heads", fmt=fmt, codec=keyed.codec(fmt))
        stored = mine.filter(~F.col(keyed.GONE)).drop(keyed.GONE)
        known = mine.filter(keyed.GONE).select(KEY, START)
        first = events.groupBy(F.col(KEY).alias("__key")).agg(F.min(START).alias("__first"))
        late = mine.join(first, mine[KEY].eqNullSafe(first["__key"])).filter(F.col("__first") < F.col(START))
        late = write_path(late.select(KEY, "__first"), f"{staging}/late", fmt=fmt)
        since = late.agg(F.min("__first")).first()[0]
        closed = closed_rows(spark, path, schema, fmt) if since is not None else None
        if closed is not None:
            kind = schema[END].dataType
            stored = stored.unionByName(keyed.of_keys(closed.filter(F.col(END) >= F.lit(since).cast(kind)), late, KEY))
    after = _timeline(stored, incoming, leaving, known)
    moved = F.col(END) != F.col("__end")
    after = after.withColumns(
        {
            "__head": F.col(CURRENT) & F.col("__fresh"),
            "__closed": ~F.col("__gone") & ~F.col(CURRENT) & (F.col("__fresh") | moved),
            "__replaced": F.coalesce(~F.col("__open") & moved, F.lit(False)),
        }
    )
    changed = write_path(after.filter("__head or __closed"), f"{staging}/changes", fmt=fmt, codec=keyed.codec(fmt))
    sums = [F.coalesce(F.sum(F.col(c).cast("int")), F.lit(0)) for c in ("__head", "__closed", "__replaced")]
    n_heads, n_closed, n_replaced = changed.agg(*sums).first()
    if not done or n_heads or n_closed:
        _write_run(changed, path, schema, buckets, fmt, n_closed, n_replaced)
    keyed.remove(spark, staging)
    return read_stored(spark, path, schema, fmt)


def _write_run(
    changed: DataFrame, path: str, schema: StructType, buckets: int | None, fmt: str, n_closed: int, n_replaced: int
) -> None:
    spark = changed.sparkSession
    done = keyed.runs(spark, path)
    number = done[-1].number + 1 if done else 1
    gone = F.col("__gone")
    heads = changed.filter("__head").withColumns(
        {END: F.when(gone, F.col(START)).otherwise(F.col(END)), CURRENT: ~gone, keyed.GONE: gone}
    )
    run = keyed.write_heads(heads.select(*schema.names, keyed.GONE), path, KEY, number, buckets, fmt)
    for part, count, columns in ((CLOSED, n_closed, schema.names), (REPLACED, n_replaced, [SURROGATE])):
        folder = keyed.folder_of(path, part, number)
        if count:
            rows = changed.filter(f"__{part}").select(*columns)
            rows = rows.sortWithinPartitions(END) if part == CLOSED else rows
            keyed.writer(rows, fmt).save(folder)
        else:
            keyed.remove(spark, folder)  # what a failed run may have left
    keyed.finish(spark, path, run)
    keyed.compact(spark, path, schema, KEY, buckets, fmt)


def exists(df: DataFrame, path: str) -> bool:
    """Whether anything is stored below a path of any file system that Spark reads."""
    return keyed.exists(df.sparkSession, path)
