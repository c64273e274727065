"""Training (T6-T12) around the boosted trees of ``boost``; MLlib's trees are kept as a yardstick.

Every fit is itself distributed (executors build split histograms). The random search fits each candidate on each stratified fold's
rest, many fits a pass, and takes the exact AUC of all held-out folds from one long table.
The search space is a small list of parameter maps built on the driver.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput import presets
from stayput.operators import boost
from stayput.operators.encode import assemble
from stayput.operators.evaluate import ranking_metrics

#: Fits that grow side by side: each adds 8 bytes to every row that is kept.
FITS_AT_ONCE = 25


def gbt_params(p: Mapping) -> dict:
    """Map booster-style names onto GBTClassifier params (nearest equivalents).

    ``num_leaves``, ``reg_alpha``, ``reg_lambda``, ``max_leaves`` have no MLlib
    counterpart and are dropped; ``boost.Setting`` takes them all.
    """
    out = {}
    if "n_estimators" in p:
        out["maxIter"] = int(p["n_estimators"])
    if "max_depth" in p:
        depth = int(p["max_depth"])
        out["maxDepth"] = 30 if depth < 0 else min(30, depth)   # -1 = unlimited -> MLlib's maximum
    if "learning_rate" in p:
        out["stepSize"] = float(p["learning_rate"])
    if "subsample" in p:
        out["subsamplingRate"] = float(p["subsample"])
    if "colsample_bytree" in p:
        out["featureSubsetStrategy"] = str(float(p["colsample_bytree"]))
    if "min_child_weight" in p:
        out["minInstancesPerNode"] = max(1, int(p["min_child_weight"]))
    if "min_child_samples" in p:
        out["minInstancesPerNode"] = max(1, int(p["min_child_samples"]))
    if "gamma" in p:
        out["minInfoGain"] = float(p["gamma"])
    if "max_bin" in p:
        out["maxBins"] = int(p["max_bin"])
    return out


def classifier(features_col: str = "features", label_col: str = "label", weight_col: str | None = None,
               seed: int = presets.SEED, **params) -> GBTClassifier:
    gbt = GBTClassifier(featuresCol=features_col, labelCol=label_col, seed=seed,
                        maxBins=presets.MAX_BINS, lossType="logistic", cacheNodeIds=True,
                        checkpointInterval=10, maxMemoryInMB=512)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return gbt.setParams(**params) if params else gbt


def class_ratio(df: DataFrame, label: str = "label") -> float:
    """T5: negatives per positive, rounded to 4; 1.0 without positives."""
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
    return round(row["n"] / row["p"], 4) if row["p"] else 1.0


def weight_column(ratio: float, label: str = "label"):
    """A positive row weighs ``ratio``, a negative one 1."""
    return F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0))


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """T5 as a weight column, from the rows of ``df`` itself."""
    return df.withColumn(out, weight_column(class_ratio(df, label), label))


def sample_candidates(space: Mapping[str, Sequence] = presets.SEARCH_SPACE, n: int = presets.SEARCH_CANDIDATES,
                      seed: int = presets.SEED) -> list[dict]:
    """N seeded draws from the grid of per-parameter lists, without repetition (the whole grid if it is smaller)."""
    keys = sorted(space)
    lists = [list(space[k]) for k in keys]
    total = math.prod(map(len, lists))
    found = []
    for place in random.Random(seed).sample(range(total), min(n, total)):
        cand = {}
        for k, values in zip(keys, lists):
            place, at = divmod(place, len(values))
            cand[k] = values[at]
        found.append(cand)
    return found


@dataclass
class Search:
    """Mean and population standard deviation of each candidate's held-out fold AUCs."""

    avgMetrics: list
    stdMetrics: list
    folds: int

    def getNumFolds(self) -> int:
        return self.folds


def held_out_auc(df: DataFrame, candidates: Sequence[Mapping], features: Sequence[str], label: str = "label", fold_col: str = "fold",
                 ratio: float = 1.0, num_folds: int = presets.CV_FOLDS, key: Sequence[str] = (), at_once: int = FITS_AT_ONCE,
                 seed: int = presets.SEED) -> DataFrame:
    """(candidate, fold, roc_auc): exact held-out ROC AUC (ties half) of each candidate and fold, from one table and one job.

    Rows are binned once. ``at_once`` fits grow side by side and share each pass over the rows; all held-out scores then form one long
    table, whose metrics are taken by (candidate, fold). A fold whose held-out rows are of one class has a null AUC.
    """
    bounds = boost.fit_edges(df, features)
    held = boost.blocks(df, features, bounds, label, fold_col, key=key).persist(StorageLevel.MEMORY_AND_DISK)
    places = [(c, f) for c in range(len(candidates)) for f in range(num_folds)]
    models = []
    for k in range(0, len(places), at_once):
        jobs = [boost.Job(boost.Setting.of(candidates[c], ratio), [x for x in range(num_folds) if x != f]) for c, f in places[k:k + at_once]]
        models += boost.fit_many(held, features, bounds, jobs, seed)
    out = ranking_metrics(boost.held_out(held, models, places), "label", "score", by=["candidate", "fold"], keep=True) \
        .select("candidate", "fold", "roc_auc").persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    held.unpersist()
    return out


def random_search(df: DataFrame, candidates: Sequence[Mapping], features: Sequence[str], label: str = "label", fold_col: str = "fold",
                  ratio: float = 1.0, num_folds: int = presets.CV_FOLDS, key: Sequence[str] = (), at_once: int = FITS_AT_ONCE,
                  seed: int = presets.SEED) -> Search:
    """Mean and deviation of each candidate's held-out AUCs; no refit of the best one.

    ``ratio`` weighs positive rows, or a candidate's own ``scale_pos_weight``. One small row per candidate and fold reaches the driver.
    """
    auc = held_out_auc(df, candidates, features, label, fold_col, ratio, num_folds, key, at_once, seed)
    per: list[list[float]] = [[] for _ in candidates]
    for r in auc.where("roc_auc IS NOT NULL").orderBy("candidate", "fold").collect():
        per[r["candidate"]].append(r["roc_auc"])
    auc.unpersist()
    mean = [sum(x) / len(x) if x else float("-inf") for x in per]
    std = [math.sqrt(sum((a - m) ** 2 for a in x) / len(x)) if x else None for x, m in zip(per, mean)]
    return Search(mean, std, num_folds)


def fit_log(spark: SparkSession, cv_model, candidates: list[dict]) -> DataFrame:
    """One row per candidate: position, folds, mean and std of the fold AUCs, parameters.

    Candidates and folds are counted separately (a candidate is k fits).
    """
    stds = list(getattr(cv_model, "stdMetrics", []) or [None] * len(candidates))
    folds = cv_model.getNumFolds()
    rows = [(i + 1, len(candidates), folds, float(s), None if sd is None else float(sd),
             {k: str(v) for k, v in c.items()})
            for i, (c, s, sd) in enumerate(zip(candidates, cv_model.avgMetrics, stds))]
    schema = "candidate int, total int, folds int, score double, score_std double, params map<string,string>"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.current_timestamp())


def train_mllib(df: DataFrame, params: Mapping, features_col: str = "features", label_col: str = "label",
                weight_col: str | None = None) -> GBTClassificationModel:
    """MLlib's first-order boosted trees with the nearest parameters, as a yardstick for ``boost.fit``."""
    return classifier(features_col, label_col, weight_col, **gbt_params(params)).fit(df)


def cv_auc(df: DataFrame, params: Mapping, features: Sequence[str], label: str = "label", fold_col: str = "fold",
           k: int = presets.CV_FOLDS, ratio: float = 1.0, key: Sequence[str] = ()) -> DataFrame:
    """(fold, roc_auc) on held-out folds, all rounds of each fit, the folds side by side; positives weighed as in the final fit."""
    return held_out_auc(df, [params], features, label, fold_col, ratio, k, key, at_once=k).select("fold", "roc_auc")


def cv_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(F.avg("roc_auc").alias("cv_auc_mean"), F.stddev_pop("roc_auc").alias("cv_auc_std"))


def importance(spark: SparkSession, model, names: Sequence[str], n: int | None = None) -> DataFrame:
    """Feature importances (share of the total gain) sorted descending (top n)."""
    imp = model.importances() if isinstance(model, boost.Boosted) else model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(nm, float(v)) for nm, v in zip(names, imp)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(n) if n else df


def early_stop_info(spark: SparkSession, model: boost.Boosted, max_iter: int) -> DataFrame:
    """The best round (which the model keeps), the rounds built, those asked for, whether training stopped early, the best loss."""
    best = min(model.losses) if model.losses else None
    return spark.createDataFrame([(model.best_round, model.rounds_built, max_iter, model.stopped, best)],
                                 "best_round int, rounds_built int, max_iter int, stopped_early boolean, best_loss double")


def training_summary(spark: SparkSession, info: Mapping) -> DataFrame:
    """One-row summary record."""
    items = sorted(info.items())
    return spark.createDataFrame([tuple(str(v) for _, v in items)], ", ".join(f"{k} string" for k, _ in items))


def assemble_features(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    return assemble(df, names, out)
