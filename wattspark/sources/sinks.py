"""Sinks and table upkeep."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from wattspark.functions.columns import day

# Days each table is kept, and its partition column.
RETENTION_DAYS = {"readings": 90, "minute_aggregates": 30, "raw_archive": 30, "der": 5 * 365}
CLUSTERING = {"event_ts": ("pole_id", "meter_id"), "window_start": ("pole_id",), "event_start": ("pole_id", "meter_id")}

LAYOUT = ("event_date", "stream", "batch")  # folders of a table that streams append to
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a null


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that match a pattern."""
    found = _files(spark, pattern).globStatus(_path(spark, pattern)) or []
    return [s.getPath().toString() for s in found]


def require_table(spark: SparkSession, path: str) -> None:
    """Raise unless the target is there: its sink only ever appends."""
    if not exists(spark, path):
        raise FileNotFoundError(f"target table does not exist: {path}")


def write_clustered(
    df: DataFrame, path: str, ts: str = "event_ts", stream: str = "load", batch: str | int | None = None
) -> None:
    """Add rows to a table in folders of date, stream and batch, clustered within.

    What the same batch of the stream wrote before to the dates of ``df`` is replaced, by the commit of
    Spark's writer: files are written aside, and a job that fails leaves the table as it was. Without
    a ``batch`` the rows are one of their own. Writers of different streams and batches never touch the same
    folder, so a table may have several, and dates may expire meanwhile.

    Rows are range-partitioned by date, cluster keys and time. The ranges are
    sampled from the data, so a busy day or a busy meter gets several files and
    each file holds a narrow span of keys, which Parquet statistics can skip.
    """
    keys = CLUSTERING[ts]
    named = df.withColumns(
        {"event_date": F.to_date(ts), "stream": F.lit(stream), "batch": F.lit(str(uuid.uuid4().hex if batch is None else batch))}
    )
    ranged = named.repartitionByRange("event_date", *keys, ts).sortWithinPartitions("event_date", *keys, ts)
    replacing(ranged, LAYOUT).parquet(path)


def replacing(df: DataFrame, folders: tuple[str, ...]) -> DataFrameWriter:
    """Writer that replaces the folders of which ``df`` has rows, and no others."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders)


def append_batch(df: DataFrame, path: str, stream: str, batch: str | int, ts: str = "event_ts") -> None:
    """Append one micro-batch to a table, whatever it holds already; safe to repeat."""
    write_clustered(df, path, ts, stream, batch)


def archive_batch(
    readings: DataFrame,
    path: str,
    stream: str,
    batch: str | int,
    folders: tuple[str, ...] = ("pole_id", "dt", "hr", "min"),
    files_per_folder: int = 4,
) -> None:
    """One micro-batch into the raw archive, in folders of its own below; safe to repeat.

    A folder's rows go to ``files_per_folder`` tasks by meter, so a pole that dominates is spread.
    """
    unused = [c for c in ARCHIVE_FOLDERS[1:] if c not in folders]
    spread = F.pmod(F.hash("meter_id"), F.lit(files_per_folder))
    named = archive_columns(readings).drop(*unused).withColumns({"stream": F.lit(stream), "batch": F.lit(str(batch))})
    dealt = named.repartition(*[F.col(c) for c in folders], spread)
    replacing(dealt, (*folders, "stream", "batch")).options(**ARCHIVE_OPTIONS).json(path)


def merge_rows(df: DataFrame, path: str, keys: tuple[str, ...] = ("event_id",), ts: str = "event_start") -> None:
    """Add rows to a table in folders of dates; a row whose key is there already replaces it.

    Writing the same rows again leaves the table as it was. ``keys`` decide the time, so a key stays
    within its date, and only the dates of ``df`` are read and replaced; rows without a time are a date
    of their own. Rows of equal key in ``df`` become one. The table has one writer at a time; a job that
    was cut short while dates were being replaced is finished by the next (see ``_pending``).
    """
    spark = df.sparkSession
    _finish_pending(spark, path)
    fresh = f"{path}/_fresh/{uuid.uuid4().hex}"
    df.withColumn("event_date", F.to_date(ts)).dropDuplicates(list(keys)).write.parquet(fresh)
    rows = spark.read.parquet(fresh)
    if _date_folders(spark, path):
        # no more rows than there are dates
        dates = [r[0] for r in rows.select("event_date").distinct().collect()]
        same = [F.col(f"_there.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in keys]
        of_dates = F.col("event_date").isin([d for d in dates if d is not None])
        if None in dates:
            of_dates = of_dates | F.col("event_date").isNull()
        there = spark.read.parquet(path).filter(of_dates).alias("_there")
        kept = there.join(rows.alias("_new"), same, "left_anti")
        rows = rows.unionByName(kept.select(*rows.columns))
    _pending(rows, path, ts, ("event_date",), [])
    remove(spark, fresh)


def compact(spark: SparkSession, path: str, dates: list[str | date], ts: str = "event_ts") -> None:
    """Rewrite the given dates of a table, clustered, in as few files as their size asks for.

    For dates that no stream writes to any more. Their batches become one. While their folders are replaced,
    readers do not find them all; a job that is cut short is finished by the next call.
    """
    _finish_pending(spark, path)
    days = [date.fromisoformat(str(d)) for d in dates]
    folders = [f"event_date={d}" for d in days if exists(spark, f"{path}/event_date={d}")]
    if not folders:
        return
    rows = spark.read.parquet(path).filter(F.col("event_date").isin(days))
    named = rows.withColumns({"stream": F.lit("compacted"), "batch": F.lit(uuid.uuid4().hex)})
    _pending(named, path, ts, LAYOUT, folders)


def _pending(rows: DataFrame, path: str, ts: str, layout: tuple[str, ...], folders: list[str]) -> None:
    """Replace folders of a table by rows that may come from it.

    The rows are first written whole below ``_pending``, with a note of what is to be done; only then the
    ``folders`` that end are deleted and the rows written into the table, which can be repeated.
    """
    spark, keys = rows.sparkSession, CLUSTERING[ts]
    ranged = rows.repartitionByRange("event_date", *keys, ts).sortWithinPartitions("event_date", *keys, ts)
    ranged.write.mode("overwrite").parquet(f"{path}/_pending/rows")
    note = json.dumps({"layout": layout, "folders": folders, "order": [*keys, ts]})
    out = _files(spark, path).create(_path(spark, f"{path}/_pending/note"), True)
    out.write(bytearray(note.encode()))
    out.close()
    _finish_pending(spark, path)


def _finish_pending(spark: SparkSession, path: str) -> None:
    if not exists(spark, f"{path}/_pending/note"):
        return
    note = json.loads(spark.read.text(f"{path}/_pending/note", wholetext=True).first()[0])
    for folder in note["folders"]:
        remove(spark, f"{path}/{folder}")
    rows = spark.read.parquet(f"{path}/_pending/rows")
    ranged = rows.repartitionByRange("event_date", *note["order"]).sortWithinPartitions("event_date", *note["order"])
    replacing(ranged, tuple(note["layout"])).parquet(path)
    remove(spark, f"{path}/_pending/note")
    remove(spark, f"{path}/_pending")


def _date_folders(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    names = [s.getPath().getName() for s in _files(spark, path).listStatus(_path(spark, path))]
    return [n for n in names if n.startswith("event_date=")]


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a replaced table that are complete, the oldest first."""
    notes = _files(spark, path).globStatus(_path(spark, f"{path}/_complete/*")) or []
    return sorted(int(n.getPath().getName()) for n in notes)


def current(spark: SparkSession, path: str) -> str:
    """Folder of the newest complete version of a replaced table."""
    found = _versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version of {path}")
    return f"{path}/version={found[-1]}"


def replace_table(df: DataFrame, path: str) -> None:
    """Create the table or replace its contents.

    Each call writes a version beside the others, and one small file, created last, makes it the current
    one: a reader finds either the old rows or the new, a job that fails leaves the old, and the rows
    may come from the table itself. The version before stays for readers that have begun. The table has
    one writer at a time; it is read by ``current``.
    """
    spark = df.sparkSession
    files, there = _files(spark, path), _versions(spark, path)
    version = there[-1] + 1 if there else 1
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    files.create(_path(spark, f"{path}/_complete/{version}"), True).close()
    for old in there[:-1]:
        remove(spark, f"{path}/_complete/{old}")
        remove(spark, f"{path}/version={old}")


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def retained(df: DataFrame, as_of: str | date, days: int, date_column: str = "event_date") -> DataFrame:
    """Rows of partitions still within the retention period."""
    return df.filter(F.col(date_column) >= F.date_sub(day(as_of), days))


def drop_expired(
    spark: SparkSession, path: str, as_of: str | date, days: int, column: str = "event_date"
) -> list[str]:
    """Delete the folders of whole expired dates; returns the dates dropped.

    The date's folder may be below others, as ``dt`` is below the pole in the raw archive; only folder
    names are looked at. Rows without a time are in no date; their batches expire by when they were written.
    """
    first_kept = datetime.strptime(str(as_of), "%Y-%m-%d").replace(tzinfo=timezone.utc) - timedelta(days=days)
    files, dropped, above = _files(spark, path), set(), path
    while not (found := files.globStatus(_path(spark, f"{above}/{column}=*")) or []):
        above += "/*=*"
        if not files.globStatus(_path(spark, above)):
            return []
    for status in found:
        value = status.getPath().getName().split("=", 1)[1]
        if value == NO_DATE:
            _drop_older(spark, status.getPath().toString(), first_kept)
        elif value < first_kept.date().isoformat():
            files.delete(status.getPath(), True)
            dropped.add(value)
    return sorted(dropped)


def _drop_older(spark: SparkSession, folder: str, time: datetime) -> None:
    """Delete the batches below a folder whose files were all written before ``time``."""
    files, batches = _files(spark, folder), folder
    while not (found := files.globStatus(_path(spark, f"{batches}/batch=*")) or []):
        batches += "/*=*"
        if not files.globStatus(_path(spark, batches)):
            return
    for status in found:
        if status.getModificationTime() < time.timestamp() * 1000:
            files.delete(status.getPath(), True)


def remove(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def archive_columns(readings: DataFrame) -> DataFrame:
    """Readings with the folder columns of the raw archive."""
    ts = F.col("event_ts")
    return readings.withColumns(
        {
            "dt": F.date_format(ts, "yyyy-MM-dd"),
            "hr": F.date_format(ts, "HH"),
            "min": F.date_format(ts, "mm"),
        }
    )


ARCHIVE_FOLDERS = ("pole_id", "dt", "hr", "min")
# Archive format; microseconds are spelled out.
ARCHIVE_OPTIONS = {
    "ignoreNullFields": "false",
    "compression": "gzip",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def write_archive(readings: DataFrame, path: str, folders: tuple[str, ...] = ARCHIVE_FOLDERS) -> None:
    """Compressed JSON lines under ``pole_id=/dt=/hr=/min=``, or under fewer of these."""
    archive_batch(readings, path, "load", uuid.uuid4().hex, folders)
