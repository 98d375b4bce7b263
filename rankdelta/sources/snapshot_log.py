"""A snapshot table with an append log (SRC-6, SRC-8, SRC-9, SRC-10).

Layout below the table's path::

    data/batch=<attempt>/capture_date=<d>/part-*.parquet
    catalogue/batch=<attempt>/part-*.parquet
    log/<version>.json

Every append writes its rows and a catalogue of its snapshots (one row per
channel, capture time and stamp) into folders of its own, and then commits them
with one log entry: batch name, folder, first and last id, number of rows.  Days
are folders; a day's rows lie in the order of their channels, so the number of files
grows with days and bytes, not with channels, and Parquet's statistics find a channel.  The
entry's file is created only if that version is not there yet, so of two writers
one wins and the other takes new ids and the next version.  Readers take the
folders that the log names; what a lost attempt left is never read, and a batch
that is already in the log is not written again.

Ids, baselines and partitions to touch all come from log and catalogue: an
append or a purge costs what its batch costs, not what the table holds.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdelta.schema import PURGE_KEYS, SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA
from rankdelta.sources.snapshots import ntz, point_scan, purge_duplicates, stamp_batch

PARTITION_COLS = ("capture_date",)
DAY_KEY = ("channel", "capture_date")  # what a purge compares: the channel's day
# ``stamp_us`` is ``created_at`` as microseconds since 1970: Parquet skips row groups
# by the statistics of integers, but Spark pushes no filter on zone-less timestamps.
DATA_SCHEMA = T.StructType([*SNAPSHOT_SCHEMA.fields, T.StructField("stamp_us", T.LongType()),
                            T.StructField("capture_date", T.DateType()), T.StructField("batch", T.StringType())])
LAID_BY = ("capture_date", "channel", "created_at", "rank", "id")
EPOCH = dt.datetime(1970, 1, 1)
CATALOGUE_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType()), T.StructField("capture_date", T.DateType()),
    T.StructField("captured_at", T.TimestampNTZType()), T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("n_rows", T.LongType()), T.StructField("batch", T.StringType())])
LOG_SCHEMA = "version long, op string, name string, folder string, first_id long, last_id long, rows long, purged boolean"
RETRIES = 20  # versions that an append tries when other writers commit first


@dataclass(frozen=True)
class Entry:
    """One commit: a batch's folder now, and the ids it was given."""

    version: int
    op: str
    name: str = ""
    folder: str = ""
    first_id: int = 0
    last_id: int = 0
    rows: int = 0
    purged: bool = False


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _commit(spark: SparkSession, path: str, entry: Entry) -> bool:
    """Write a log entry unless its version is taken."""
    fs, p = _fs(spark, f"{path}/log/{entry.version:010d}.json")
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write((json.dumps(asdict(entry)) + "\n").encode())
    out.close()
    return True


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The log in order; an entry whose writer died while writing it counts as a version without effect."""
    fs, p = _fs(spark, f"{path}/log")
    if not fs.exists(p):
        return []
    rows = spark.read.schema(LOG_SCHEMA).json(f"{path}/log").filter("op is not null").collect()  # a row per append
    return sorted((Entry(**r.asDict()) for r in rows), key=lambda e: e.version)


def _next_version(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, f"{path}/log")
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(m[1]) + 1 for n in names if (m := re.fullmatch(r"(\d+)\.json", n))), default=0)


def committed(log: list[Entry]) -> dict[str, Entry]:
    """Batch name -> its entry now; a replacement keeps the batch's place."""
    state: dict[str, Entry] = {}
    for e in log:
        if e.op in ("append", "replace"):
            state[e.name] = e
    return state


def create_table(spark: SparkSession, path: str) -> None:
    """SRC-7: an empty table, unless there is one."""
    if _next_version(spark, path) == 0:
        _commit(spark, path, Entry(0, "create"))


def next_id(spark: SparkSession, path: str) -> int:
    """One more than the largest id given out; read from the log alone."""
    return max((e.last_id for e in entries(spark, path)), default=0) + 1


def _read(spark: SparkSession, path: str, kind: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path}/{kind}")
    return reader.parquet(*[f"{path}/{kind}/batch={f}" for f in folders])


def read_table(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """The committed rows (of some batches): snapshot columns, ``capture_date``, ``batch``."""
    return _stored(spark, path, names).drop("stamp_us")


def _stored(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    state = committed(entries(spark, path))
    return _read(spark, path, "data", DATA_SCHEMA, [e.folder for n, e in state.items() if names is None or n in names])


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """One row per snapshot of each committed batch, without reading the data."""
    return _read(spark, path, "catalogue", CATALOGUE_SCHEMA, [e.folder for e in committed(entries(spark, path)).values()])


def _write(spark: SparkSession, path: str, folder: str, rows: DataFrame) -> tuple[int, int, int]:
    """Rows and their catalogue into folders of their own: (rows, first id, last id).

    Rows are dealt to tasks by ranges of (day, channel, stamp, rank): a task writes the
    files of few days, however many channels there are, and a day with most of the rows is
    split.  Inside a file the same order lets Parquet's statistics skip the rest.
    """
    data = rows.select(*SNAPSHOT_COLUMNS, F.timestamp_diff("MICROSECOND", ntz(EPOCH), F.col("created_at")).alias("stamp_us"),
                       F.to_date("captured_at").alias("capture_date"))
    data = data.repartitionByRange(*LAID_BY).sortWithinPartitions(*LAID_BY)
    data.write.partitionBy(*PARTITION_COLS).parquet(f"{path}/data/batch={folder}")
    back = _read(spark, path, "data", DATA_SCHEMA, [folder])
    back.groupBy("channel", "capture_date", "captured_at", "created_at").agg(F.count(F.lit(1)).alias("n_rows")) \
        .write.parquet(f"{path}/catalogue/batch={folder}")
    got = back.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).first()
    return got["n"], got["a"] or 0, got["b"] or 0


def _drop(spark: SparkSession, path: str, folder: str) -> None:
    for kind in ("data", "catalogue"):
        fs, p = _fs(spark, f"{path}/{kind}/batch={folder}")
        fs.delete(p, True)


def append_batch(spark: SparkSession, df: DataFrame, path: str, name: str | None = None, created_at: dt.datetime | None = None, *,
                 keep_stamps: bool = False, enabled: bool = True) -> Entry | None:
    """SRC-8: append ``df`` as the batch ``name``; ids continue the table's, one stamp for the batch.

    A batch that is in the log already is not appended again: its entry is
    returned, so a caller repeats a lost attempt with the same name.  Without a
    name every call is a batch of its own.  ``keep_stamps``: history keeps its own
    ``created_at``.  An empty batch writes nothing and gives None, as does a
    disabled sink.
    """
    if not enabled:
        return None
    create_table(spark, path)
    name = name or uuid.uuid4().hex
    for _ in range(RETRIES):
        version = _next_version(spark, path)
        done = committed(entries(spark, path)).get(name)
        if done:
            return done
        start, folder = next_id(spark, path), uuid.uuid4().hex
        rows = stamp_batch(df.select(*SNAPSHOT_COLUMNS).withColumnRenamed("created_at", "_own"), start, created_at)
        rows = rows.withColumn("created_at", F.col("_own")) if keep_stamps else rows
        n, first, last = _write(spark, path, folder, rows)
        if not n:
            _drop(spark, path, folder)
            return None
        entry = Entry(version, "append", name, folder, first, last, n)
        if _commit(spark, path, entry):
            return entry
        _drop(spark, path, folder)  # another writer took these ids
    raise RuntimeError(f"{RETRIES} other writers committed first")


def purge_batch(spark: SparkSession, path: str, name: str) -> Entry:
    """SRC-10 for one batch: it loses the rows whose key an earlier batch or an earlier row of it has.

    Only the days that the batch touches are read of the earlier batches, found
    from its catalogue and pruned before any file is opened; only the batch itself
    is written again.
    """
    state = committed(entries(spark, path))
    mine = state[name]
    earlier = [n for n, e in state.items() if e.first_id < mine.first_id]
    new = purge_duplicates(read_table(spark, path, [name]))
    if earlier:
        days = _read(spark, path, "catalogue", CATALOGUE_SCHEMA, [mine.folder]).filter("n_rows > 0").select(*DAY_KEY).distinct()
        days = days.withColumnsRenamed({c: f"_{c}" for c in DAY_KEY})
        old = read_table(spark, path, earlier)
        same_day = [old[c].eqNullSafe(days[f"_{c}"]) for c in DAY_KEY]
        old = old.join(days, same_day, "left_semi").select(*[F.col(k).alias(f"_{k}") for k in PURGE_KEYS])
        new = new.join(old, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PURGE_KEYS], "left_anti")
    for _ in range(RETRIES):
        folder = uuid.uuid4().hex
        n, _, _ = _write(spark, path, folder, new)
        entry = Entry(_next_version(spark, path), "replace", name, folder, mine.first_id, mine.last_id, n, True)
        if _commit(spark, path, entry):
            return entry
        _drop(spark, path, folder)
    raise RuntimeError(f"{RETRIES} other writers committed first")


def purge_table(spark: SparkSession, path: str) -> list[Entry]:
    """Purge the batches that have not been purged yet, in the order of their ids."""
    todo = [e for e in committed(entries(spark, path)).values() if not e.purged]
    return [purge_batch(spark, path, e.name) for e in sorted(todo, key=lambda e: e.first_id)]


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of lost attempts and of replaced batches; run it while nothing else writes or reads."""
    used = {e.folder for e in committed(entries(spark, path)).values()}
    fs, p = _fs(spark, f"{path}/data")
    found = [f.getPath().getName().removeprefix("batch=") for f in fs.listStatus(p)] if fs.exists(p) else []
    lost = [f for f in found if f not in used]
    for f in lost:
        _drop(spark, path, f)
    return lost


def snapshot_at(spark: SparkSession, path: str, channel: str, at: dt.datetime | str, columns: list[str] | None = None,
                limit: int | None = None) -> DataFrame:
    """SRC-6: the rows that ``channel`` stored with the stamp ``at``, by rank, the first ``limit`` if given.

    The catalogue names the days to open; inside their files channel and stamp are
    pushed filters that skip row groups, and the order is a top-k read.
    """
    at = dt.datetime.fromisoformat(at) if isinstance(at, str) else at
    days = read_catalogue(spark, path).filter((F.col("channel") == channel) & (F.col("created_at") == ntz(at)))
    lo, hi = days.agg(F.min("capture_date"), F.max("capture_date")).first()
    stamp = (at - EPOCH) // dt.timedelta(microseconds=1)
    rows = _stored(spark, path).filter((F.col("channel") == channel) & (F.col("stamp_us") == stamp))
    if lo is not None:
        rows = rows.filter(F.col("capture_date").between(F.lit(lo), F.lit(hi)))
    return point_scan(rows, limit, at=at, columns=columns)
