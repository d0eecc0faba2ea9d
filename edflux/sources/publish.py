"""Replacing a result without a moment in which the old one is lost, and dated snapshots.

:func:`replace` writes the new rows beside the target, in a staging folder (or table) of their
own, and only then puts them in its place. A job that fails while it reads, computes or writes leaves the
target as it was; so does a failure between the two renames, as the old rows are put back.
The rows may come from the target itself, since nothing of it is touched before they are written.
On file systems where a rename is a copy (object stores) the swap takes as long as the copy.

:func:`write_snapshot` keeps one partition for each day: writing a day again replaces that day
alone (Spark's dynamic partition overwrite, committed at the end of the job).

Each write's shuffle files go when it ends (:func:`shuffles_released`), so a job of several
writes holds those of one at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_DAY = "fecha_corte"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PACKED = "zstd"  # the records' text repeats its names in each row


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is run within it leaves no shuffle files behind.

    Else they stay until the driver's JVM collects the garbage that refers to them, which a driver
    that has little to do may put off to the end of the job. Spark removes those of the writers' jobs;
    those of a SQL ``INSERT`` (a later day of a table) still wait for the garbage.
    """
    held = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if held is None else spark.conf.set(SHUFFLE_CLEANUP, held)


@contextmanager
def stored_for_now(df: DataFrame, location: str) -> Iterator[DataFrame]:
    """The rows of ``df``, stored as Parquet in the shared folder ``location`` as long as the block runs.

    For rows that several eager writes read: what they cost is paid once, and the shuffles
    they come from aren't held beside those of the writes.
    """
    spark = df.sparkSession
    fs, path = _fs(spark, location)
    try:
        with shuffles_released(spark):
            df.write.option("compression", PACKED).parquet(location)
        yield spark.read.schema(df.schema).parquet(location)
    finally:
        fs.delete(path(location), True)


def _beside(location: str, what: str) -> str:
    """A new hidden neighbour of ``location`` (readers skip names that start with ``_``)."""
    folder, _, name = location.rstrip("/").rpartition("/")
    return f"{folder}/_{name}.{what}-{uuid.uuid4().hex}" if folder or location.startswith("/") else f"_{name}.{what}-{uuid.uuid4().hex}"


def replace_path(spark: SparkSession, location: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a staging folder, then put that in the place of ``location``."""
    location = location.rstrip("/")
    staged, old = _beside(location, "new"), _beside(location, "old")
    fs, path = _fs(spark, location)
    try:
        write(staged)
        _swap(fs, path(location), path(staged), path(old))
    finally:
        fs.delete(path(staged), True)  # nothing is there after the swap
    fs.delete(path(old), True)
    spark.catalog.refreshByPath(location)


def _swap(fs, target, staged, old) -> None:
    """Move ``staged`` to ``target``, and what is there to ``old``; back again if that fails."""
    held, moved = fs.exists(target), False
    if not held:
        fs.mkdirs(target.getParent())
    elif not fs.rename(target, old):
        raise OSError(f"{target} can't be moved")
    try:
        moved = fs.rename(staged, target)
    finally:
        if held and not moved:
            fs.rename(old, target)
    if not moved:
        raise OSError(f"{staged} can't be moved to {target}")


def replace_table(spark: SparkSession, name: str, write: Callable[[str], None]) -> None:
    """Let ``write`` make a staging table, then give it the name of the table ``name``."""
    mark = uuid.uuid4().hex
    staged, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    held = spark.catalog.tableExists(name)
    moved = False
    try:
        write(staged)
        if held:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
            moved = True
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        moved = False
    except Exception:
        if moved:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    if held:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


# ------------------------------------------------------------------ dated snapshots


def write_snapshot(df: DataFrame, location: str, day: date | str, fmt: str = "parquet") -> None:
    """Store ``df`` as the snapshot of ``day``; other days stay. ``fmt``: parquet, csv or table.

    In a table the snapshot day is the last column and a partition.
    """
    with shuffles_released(df.sparkSession):
        _store_day(df, location, date.fromisoformat(str(day)), fmt)


def _store_day(df: DataFrame, location: str, day: date, fmt: str) -> None:
    rows = df.withColumn(SNAPSHOT_DAY, F.lit(day))
    if fmt == "table":
        if df.sparkSession.catalog.tableExists(location):
            own = [f"`{c}`" for c in df.sparkSession.table(location).columns if c != SNAPSHOT_DAY]
            into = f"INSERT OVERWRITE TABLE {location} PARTITION ({SNAPSHOT_DAY} = DATE'{day}')"
            df.sparkSession.sql(f"{into} SELECT {', '.join(own)} FROM {{rows}}", rows=df)
        else:
            rows.write.partitionBy(SNAPSHOT_DAY).option("compression", PACKED).saveAsTable(location)
        return
    options = {"header": True, "quote": '"', "escape": '"', "dateFormat": "yyyy-MM-dd"} if fmt == "csv" else {"compression": PACKED}
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT_DAY).options(**options)
    writer.format(fmt).save(location)


def snapshot_days(spark: SparkSession, location: str, fmt: str = "parquet") -> list[date]:
    """The stored days, oldest first, from the names of the partitions alone."""
    if fmt == "table":
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {location}").collect()] if spark.catalog.tableExists(location) else []
    else:
        fs, path = _fs(spark, location)
        names = [s.getPath().getName() for s in fs.listStatus(path(location))] if fs.exists(path(location)) else []
    found = (re.fullmatch(rf"{SNAPSHOT_DAY}=(\d{{4}}-\d\d-\d\d)", n) for n in names)
    return sorted(date.fromisoformat(m[1]) for m in found if m)


def pick_day(days: list[date], as_of: date | str | None, location: str) -> date:
    """The last of ``days``, or the last one that isn't after ``as_of``."""
    held = [d for d in days if as_of is None or d <= date.fromisoformat(str(as_of))]
    if not held:
        raise FileNotFoundError(f"{location} holds no snapshot" + (f" up to {as_of}" if as_of else ""))
    return held[-1]
