"""Helpers shared by the corpus operators: row ids, written intermediate tables, size-checked joins."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput.session import shared_dir, table_path

UID = "_uid"
#: Rows (each under about 100 bytes) that a broadcast table may hold at most; more rows are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Characters that count as white space in the word and byte contracts.
SPACES = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: a zip in the shared folder, added as a Python file."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark, 'stayput')}/{root.name}-{uuid.uuid4().hex}.zip")
    files = target.getFileSystem(sc._jsc.hadoopConfiguration())
    out = files.create(target)
    out.write(held.getvalue())
    out.close()
    files.deleteOnExit(target)
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)


def mapped(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def with_uid(df: DataFrame) -> DataFrame:
    """Number the rows of a stored table. Both reads of one table give a row the same number, as its file splits are the same."""
    return df.withColumn(UID, F.monotonically_increasing_id())


ROW = "_row"


def wrapped(df: DataFrame) -> DataFrame:
    """(_row, _uid): whole rows of a stored table in one struct, so that no name of theirs can clash with a helper column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), F.monotonically_increasing_id().alias(UID))


def unwrapped(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(ROW).getField(c).alias(c) for c in columns])


#: Spark 4.1: the shuffle files of a query go when it ends. Else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders of staged tables.
_FOLDERS: WeakKeyDictionary = WeakKeyDictionary()


def _files(spark: SparkSession, path: str) -> tuple:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: fixes row ids and cuts lineage.

    The table lives on storage that all executors share, so a lost executor loses nothing;
    Hadoop deletes it when the session ends, ``discard`` before. What the write shuffled goes as it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'stayput')}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if was is None else spark.conf.set(SHUFFLE_CLEANUP, was)
    files, target = _files(spark, path)
    files.deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, nor any frame made of them; frames that are not staged tables stay."""
    for df in tables:
        if path := _FOLDERS.pop(df, None):
            files, target = _files(df.sparkSession, path)
            files.delete(target, True)
            files.cancelDeleteOnExit(target)


def join_checked(df: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
                 limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``small`` when it is counted to hold at most ``limit`` rows, else join by a shuffle that AQE can split."""
    if small.limit(limit + 1).count() <= limit:
        small = F.broadcast(small)
    return df.join(small, on, how)


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
