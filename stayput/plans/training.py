"""Training plan: split first, fit the FeaturePlan on train only, search, fit, evaluate.

Stages: stratified split (T1) -> FeaturePlan.fit(train) -> folds (T3) ->
random search (T6) -> final fit with patience on val (T7) -> evaluation
bundle by split (V14) -> CV AUC (T8). State and model (a tree table) persist
as parquet (S5).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput import presets
from stayput.operators import boost, clean, evaluate, score, split, train
from stayput.plans.feature_plan import FeaturePlan
from stayput.session import shared_dir

log = logging.getLogger(__name__)

#: A named small setting for smoke runs; the defaults of ``fit`` are the full search.
SMALL_SEARCH = {"n_estimators": [10], "max_depth": [3, 4], "learning_rate": [0.2, 0.3],
                "subsample": [0.8, 1.0]}


#: Codes of the splits in the ``part`` column.
TRAIN, VALID, TEST = 0, 1, 2


@dataclass
class TrainedModel:
    plan: FeaturePlan
    model: object
    params: dict
    candidates: list
    cv_model: object         # fold AUCs of the search; None after a fallback
    data: DataFrame          # split + features + label, kept in memory until ``release``
    labels: list = field(default_factory=lambda: ["No", "Yes"])
    search_error: str | None = None

    def release(self) -> None:
        """Give back the kept rows; the plan and the model stay usable."""
        if self.data is not None:
            self.data.unpersist()


def target_codes(df: DataFrame, target: str) -> list[str]:
    """The two values of the target in sorted order; a target with other than two values is no binary target."""
    values = [r[0] for r in df.select(F.col(target).cast("string").alias("v")).where("v is not null").distinct()
              .orderBy("v").limit(3).collect()]
    if len(values) != 2:
        raise ValueError(f"{target} needs two values, it has {'more' if len(values) > 2 else len(values)}")
    return values


def prepare(df: DataFrame, key: str = "customerID", target: str = presets.TARGET,
            fractions=presets.SPLIT_FRACTIONS, fit_on: str = "train",
            labels: list[str] | None = None, keep_nulls: bool = False) -> tuple[FeaturePlan, DataFrame]:
    """Drop copies of rows, split, then fit the FeaturePlan on the train rows (``fit_on="all"`` fits on every
    row before splitting, as the original flow did — available for parity only). The rows carry ``label`` and ``part``."""
    spark = df.sparkSession
    shared_dir(spark, "training")  # makes the checkpoint dir available to the tree learner
    labels = labels or target_codes(df, target)
    # the split is read by every fit job below: compute it once
    s = split.stratified_split(clean.dedupe(df), key, target, fractions).persist(StorageLevel.MEMORY_AND_DISK)
    fit_rows = s.where(F.col("split") == "train") if fit_on == "train" else s
    plan = FeaturePlan(target=target, id_columns=[key], keep_nulls=keep_nulls).fit(fit_rows.drop("split"))
    feats = plan.transform(s)
    feats = feats.withColumn("label", F.when(F.col(target).cast("string") == labels[1], 1.0).otherwise(0.0)) \
        .withColumn("part", F.when(F.col("split") == "train", TRAIN).when(F.col("split") == "val", VALID).otherwise(TEST))
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    feats.count()       # binning and scoring read the features; the split is no longer needed
    s.unpersist()
    return plan, feats


@dataclass
class Searched:
    """A prepared table and the outcome of the search on its train rows."""

    plan: FeaturePlan
    data: DataFrame
    key: str
    labels: list
    ratio: float
    base: dict
    candidates: list
    cv_model: object         # fold AUCs of the search; None after a fallback
    best: dict
    error: str | None = None


def search(df: DataFrame, key: str = "customerID", target: str = presets.TARGET,
           space=presets.SEARCH_SPACE, n_candidates: int = presets.SEARCH_CANDIDATES, k: int = presets.CV_FOLDS,
           weighted: bool = True, at_once: int = train.FITS_AT_ONCE, fractions=presets.SPLIT_FRACTIONS,
           fit_on: str = "train", base=None, keep_nulls: bool = False) -> Searched:
    """Prepare the rows and search the space on the train rows; see ``fit`` for the arguments."""
    labels = target_codes(df, target)
    plan, feats = prepare(df, key, target, fractions, fit_on, labels, keep_nulls)
    leafwise = "num_leaves" in space
    base = dict((presets.BASE_PARAMS_LEAFWISE if leafwise else presets.BASE_PARAMS) if base is None else base)
    trn = feats.where(F.col("part") == TRAIN)
    ratio = train.class_ratio(trn) if weighted else 1.0     # of train rows only
    trn = split.assign_folds(trn, key, "label", k=k)
    cands = train.sample_candidates(space, n_candidates)
    try:
        found = train.random_search(trn, [{**base, **c} for c in cands], plan.state.feature_names, ratio=ratio, num_folds=k, key=[key],
                                    at_once=at_once)
        best = cands[max(range(len(cands)), key=lambda i: found.avgMetrics[i])]
    except Exception as failure:
        log.warning("search failed, using the fallback parameters: %s", failure)
        best = dict(presets.FALLBACK_PARAMS_LEAFWISE if leafwise else presets.FALLBACK_PARAMS)
        return Searched(plan, feats, key, labels, ratio, base, cands, None, best, str(failure)[:500])
    return Searched(plan, feats, key, labels, ratio, base, cands, found, best)


def finish(s: Searched, patience: int = presets.EARLY_STOPPING_ROUNDS, final=None) -> TrainedModel:
    """The final fit with the best candidate's parameters (and those of ``final`` instead of its own), stopped on the val rows."""
    params = {**s.base, **s.best, **(final or {})}
    model = boost.fit(s.data, s.plan.state.feature_names, params, part="part", train=(TRAIN,), valid=(VALID,), patience=patience,
                      ratio=s.ratio, key=[s.key])
    return TrainedModel(s.plan, model, params, s.candidates, s.cv_model, s.data, s.labels, s.error)


def fit(df: DataFrame, key: str = "customerID", target: str = presets.TARGET,
        space=presets.SEARCH_SPACE, n_candidates: int = presets.SEARCH_CANDIDATES, k: int = presets.CV_FOLDS,
        weighted: bool = True, at_once: int = train.FITS_AT_ONCE, fractions=presets.SPLIT_FRACTIONS,
        fit_on: str = "train", base=None, keep_nulls: bool = False,
        patience: int = presets.EARLY_STOPPING_ROUNDS, final=None) -> TrainedModel:
    """Split, search, final fit. The defaults are the full search; ``SMALL_SEARCH`` with few candidates and folds is for
    smoke runs, ``presets.SEARCH_SPACE_LEAFWISE`` (20 candidates, ``presets.SPLIT_FRACTIONS_ALT``) the leaf-wise variant.

    ``base`` holds the parameters that a candidate does not name, ``final`` those that replace the best candidate's in the final
    fit, which stops after ``patience`` flat rounds on the val rows. ``at_once`` fits share each pass. ``keep_nulls`` encodes labels
    only: nulls stay, and each split learns a side for them. A failed search falls back to fixed parameters, and says so.
    """
    return finish(search(df, key, target, space, n_candidates, k, weighted, at_once, fractions, fit_on, base, keep_nulls), patience, final)


def predict(tm: TrainedModel, df: DataFrame) -> DataFrame:
    """M1: raw rows in -> FeaturePlan -> trained features in order, absent ones 0 -> model -> probability, prediction (decoded)."""
    names = tm.plan.state.feature_names
    return score.score_model(clean.add_missing(tm.plan.transform(df), names), tm.model, labels=tm.labels)


def evaluate_splits(tm: TrainedModel) -> DataFrame:
    """V14 for a trained model: counts, accuracy, F1, AUC, AP per split."""
    scored = score.score_model(tm.data, tm.model).withColumn("yhat", F.col("prediction").cast("int"))
    return evaluate.evaluation(scored, "label", "yhat", "probability", by=["split"])


RAW = "_raw_"


def model_scorer(tm: TrainedModel):
    """A scorer for ``decide.scenario_impact`` / batch reports: raw rows in, the same raw
    columns plus ``probability`` out. The raw values ride along under a prefix while the
    plan encodes copies, so overrides can be applied to readable values."""
    def scorer(df: DataFrame) -> DataFrame:
        carried = df.select(*[F.col(c).alias(RAW + c) for c in df.columns], *df.columns)
        names = tm.plan.state.feature_names
        scored = score.score_model(clean.add_missing(tm.plan.transform(carried), names), tm.model)
        return scored.select(*[F.col(RAW + c).alias(c) for c in df.columns], "probability")
    return scorer
