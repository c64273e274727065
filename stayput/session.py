"""Spark session and shared-folder helpers."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "stayput",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster use the provided session.

    AQE is on (coalesces small shuffles, splits skewed join partitions at run
    time); the UI stays off.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STAYPUT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python workers answer over local sockets: a short pass of the tree learner takes about half the time
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint location, ``spark.checkpoint.dir`` of the session.

    Where that is unset, a local master (tests, local runs) uses a folder in its warehouse; on any
    other master this is an error, as executors would write to folders that the others cannot see.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/") + "/" + name


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of its own under the shared location, deleted by Hadoop when the session ends."""
    path = f"{shared_dir(spark, name)}/{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: a zip in the shared folder, added as a Python file."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
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


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into a folder of its own under the shared location and read it back: later passes read it instead of making it again."""
    path = f"{scratch(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"
