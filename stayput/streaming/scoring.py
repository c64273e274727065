"""Stateless streaming scoring.

JSON subscriber records arrive as text files; each micro-batch is parsed
with an explicit schema, scored with the same column functions as the batch
path, tiered, and written by ``foreachBatch``: good rows to the scored sink,
unparsable lines to a reject sink (instead of failing the request); each
micro-batch owns one ``batch_id=N`` folder, so replays are idempotent. No state
is kept, so no watermark is needed; the checkpoint folder makes the query
restartable after a lost executor or driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayput.operators import decide
from stayput.plans import training
from stayput.sources import versions
from stayput.sources.io import CORRUPT, RECORD_SCHEMA, json_struct

STREAM_SCHEMA = T.StructType([T.StructField("customerID", T.StringType()), *RECORD_SCHEMA.fields])


def parse_stream(raw: DataFrame, schema: T.StructType = STREAM_SCHEMA) -> DataFrame:
    """Adds the parsed record columns plus ``_ok`` (false for malformed lines)."""
    parsed = raw.select(F.col("value"), json_struct(F.col("value"), schema).alias("r"))
    ok = F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()
    return parsed.select("value", F.coalesce(ok, F.lit(False)).alias("_ok"),
                         *[f"r.{f.name}" for f in schema.fields])


def newest_scorer(spark: SparkSession, root: str) -> Callable[[DataFrame], DataFrame]:
    """A scorer that looks up the newest complete version under ``root`` each time it is applied, so once per micro-batch.

    A running stream takes a new model between two batches, never within one; a version is read once. The rows
    also get ``model_version``, the name of its folder.
    """
    held: dict[str, Callable] = {}

    def scorer(df: DataFrame) -> DataFrame:
        path = versions.newest(spark, root)
        if path is None:
            raise FileNotFoundError(f"no complete version under {root}")
        if path not in held:
            model = training.model_scorer(versions.load(spark, root, path))
            held.clear()
            held[path] = model
        return held[path](df).withColumn("model_version", F.lit(path.rsplit("/", 1)[-1]))

    return scorer


def score_stream(spark: SparkSession, source_dir: str, scorer: Callable[[DataFrame], DataFrame],
                 sink_dir: str, checkpoint_dir: str, reject_dir: str | None = None,
                 available_now: bool = True, max_files_per_trigger: int = 1000):
    """Start the scoring stream; returns the ``StreamingQuery``.

    ``scorer`` maps parsed records to records + ``probability``; ``training.model_scorer`` imputes and
    encodes through the fitted plan, ``newest_scorer`` takes up new models as they are saved. A record needs no id; only text that does not parse is rejected.
    """
    raw = (spark.readStream.schema("value string").option("maxFilesPerTrigger", max_files_per_trigger)
           .text(source_dir))
    parsed = parse_stream(raw)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one folder per micro-batch, overwritten on replay: a batch re-run after a
        # failure replaces its own output instead of appending duplicates
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)   # both sinks read one parse of it
        good = batch.where("_ok").drop("value", "_ok")
        scored = decide.with_value_at_risk(scorer(good))
        scored.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")
        if reject_dir is not None:
            batch.where(~F.col("_ok")).select("value") \
                .write.mode("overwrite").parquet(f"{reject_dir}/batch_id={batch_id}")
        batch.unpersist()

    writer = parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
