"""Saved models as versions (S5, S6): a folder of its own for each, complete once its manifest is there; the newest by file time wins."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput.operators.score import TREE_SCHEMA, TreeModel, as_table, tree_rows
from stayput.plans.feature_plan import FeaturePlan
from stayput.plans.training import TrainedModel
from stayput.sources.io import latest_version

MANIFEST = "manifest.json"
TREES = "trees"


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def save(spark: SparkSession, root: str, plan: FeaturePlan, model, labels: list, name: str | None = None) -> str:
    """Write the plan's tables and the model's tree table as a new version under ``root``; returns its folder.

    All tables are written first, then the manifest under a temporary name, which a rename makes visible at once: a save that
    breaks off leaves a folder that no reader takes for a version.
    """
    path = f"{root}/{name or 'version'}-{uuid.uuid4().hex}"
    tables = {**plan.state_tables(spark), TREES: as_table(spark, model.rows())}
    for table, df in tables.items():
        df.write.parquet(f"{path}/{table}")
    body = json.dumps({"tables": sorted(tables), "labels": labels, "keep_nulls": plan.keep_nulls, "order": plan.state.feature_names})
    part, files = _path(spark, f"{path}/.{MANIFEST}.part")
    out = files.create(part)
    out.write(bytearray(body.encode()))
    out.close()
    if not files.rename(part, _path(spark, f"{path}/{MANIFEST}")[0]):
        raise OSError(f"the manifest of {path} could not be put in place")
    return path


def registry(spark: SparkSession, root: str) -> DataFrame:
    """(path, saved_at, manifest): every complete version under ``root``, with the file time of its manifest."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", MANIFEST).load(root)
    return found.select(F.regexp_replace("path", f"/{MANIFEST}$", "").alias("path"), F.col("modificationTime").alias("saved_at"),
                        F.col("content").cast("string").alias("manifest"))


def newest(spark: SparkSession, root: str) -> str | None:
    """Folder of the version that was saved last, whatever its name (equal times: the greatest path); None if there is none."""
    if not _path(spark, root)[1].exists(_path(spark, root)[0]):
        return None
    return latest_version(registry(spark, root)).first()["path"]


def load(spark: SparkSession, root: str, path: str | None = None) -> TrainedModel:
    """The plan and the model of a version (the newest unless ``path`` names one), ready to predict."""
    path = path or newest(spark, root)
    if path is None:
        raise FileNotFoundError(f"no complete version under {root}")
    kept = json.loads(registry(spark, path).first()["manifest"])
    tables = {t: spark.read.parquet(f"{path}/{t}") for t in kept["tables"]}
    trees = TreeModel(tree_rows(tables.pop(TREES).select(*TREE_SCHEMA.fieldNames())))
    plan = FeaturePlan.from_tables(tables, keep_nulls=kept["keep_nulls"])
    return TrainedModel(plan, trees, {}, [], None, None, kept["labels"])
