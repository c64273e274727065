"""FeaturePlan (E11): flags -> impute -> features -> encode -> z-score -> fill, fit once, reuse.

``fit`` runs a fixed, small number of aggregation jobs (one numeric profile
for missing cells and moments, medians, value counts with modes, dictionary); ``transform`` is a single narrow
projection with the fitted values as literals (no shuffle), so batch and
streaming scoring share it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stayput import presets
from stayput.operators import clean, encode, features


@dataclass
class PlanState:
    target: str | None
    id_columns: list[str]
    numeric: list[str]
    categorical: list[str]
    missing_flags: list[str]
    medians: dict
    modes: dict
    encoders: DataFrame
    stats: dict
    feature_names: list[str] = field(default_factory=list)
    dictionaries: tuple | None = None       # small encoder dictionaries, read once


class FeaturePlan:
    def __init__(self, target: str | None = presets.TARGET, id_columns=presets.ID_COLUMNS,
                 exclude_ids: bool = True, keep_nulls: bool = False):
        self.target = target
        self.id_columns = list(id_columns)
        self.exclude_ids = exclude_ids
        self.keep_nulls = keep_nulls
        self.state: PlanState | None = None

    def fit(self, df: DataFrame) -> "FeaturePlan":
        clean.validate(df, self.target, rows=-1)          # schema check only
        excl = self.id_columns if self.exclude_ids else []
        num, cat = clean.column_kinds(df, self.target, exclude=excl)
        if self.keep_nulls:     # the variant for learners that take nulls: label codes only
            self.state = PlanState(self.target, excl, num, cat, [], {}, {}, encode.fit_labels(df, cat), {})
            self.state.dictionaries = encode.small_dictionaries(self.state.encoders)
            self.state.feature_names = [c for c in df.columns if c != self.target and c not in excl]
            return self
        profile = clean.numeric_profile(df, num)         # one pass: missing cells, moments, first bracket of the medians
        clean.validate(df, self.target, rows=profile[None])
        flags = [c for c in num if profile[c]["n"] < profile[None]]
        medians = clean.fit_median(df, num, profile=profile)
        # one pass over the categorical columns feeds both the modes and the dictionary:
        # after mode imputation the distinct values are exactly the non-null ones
        # (an all-null column becomes the single value "Unknown")
        counts = clean.value_counts(df, cat).persist() if cat else None
        found = {r["column"]: r["mode"] for r in clean.modes_from_counts(counts).collect()} if cat else {}
        modes = {c: found.get(c, "Unknown") for c in cat}
        if cat:
            pairs = counts.select("column", "value")
            empty = [c for c in cat if c not in found]
            if empty:
                pairs = pairs.unionByName(df.sparkSession.createDataFrame(
                    [(c, "Unknown") for c in empty], "column string, value string"))
            enc = encode.labels_from_pairs(pairs).persist()
        else:
            enc = encode.fit_labels(df, [])
        stats = clean.imputed_moments(profile, medians)
        self.state = PlanState(self.target, self.id_columns if self.exclude_ids else [], num, cat,
                               flags, medians, modes, enc, stats)
        self.state.dictionaries = encode.small_dictionaries(enc)   # materializes the dictionary
        if counts is not None:
            counts.unpersist()
        names = [c for c in self.transform(df).columns
                 if c != self.target and c not in self.state.id_columns]
        self.state.feature_names = names
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        if s is None:
            raise ValueError("FeaturePlan is not fitted")
        if s.dictionaries is None:
            s.dictionaries = encode.small_dictionaries(s.encoders)
        if self.keep_nulls:
            return encode.apply_labels(df, s.encoders, s.categorical, unseen=0, keep_nulls=True,
                                       missing_as_null=True, dictionaries=s.dictionaries)
        out = clean.add_missing_flags(df, [c for c in s.missing_flags if c in df.columns])
        out = clean.apply_impute(out, s.medians, s.modes, widen=s.missing_flags)
        out = features.engineer(out)
        out = encode.apply_labels(out, s.encoders, s.categorical, unseen=0, dictionaries=s.dictionaries)
        return clean.fill_zero(features.apply_zscore(out, s.stats))

    def features(self, df: DataFrame, fill=0) -> DataFrame:
        """Transform and align to the trained feature order (P3 / P4), keeping ids and target."""
        t = self.transform(df)
        keep = [c for c in self.state.id_columns + ([self.target] if self.target else []) if c in t.columns]
        aligned = clean.align_features(t, self.state.feature_names, fill=fill)
        return t.select(*keep, *[aligned[c] for c in aligned.columns]) if keep else aligned

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    # -- state as small tables (S5) ------------------------------------------------
    def state_tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        s = self.state
        impute = [(c, "median", v, None) for c, v in s.medians.items()] + \
                 [(c, "mode", None, v) for c, v in s.modes.items()]
        return {
            "encoders": s.encoders,
            "impute": spark.createDataFrame(impute, "column string, kind string, num_value double, str_value string"),
            "stats": spark.createDataFrame([(c, v["mean"], v["std"]) for c, v in s.stats.items()],
                                           "column string, mean double, std double"),
            "features": spark.createDataFrame(list(enumerate(s.feature_names)), "position int, name string"),
            "columns": spark.createDataFrame(
                [(c, "numeric") for c in s.numeric] + [(c, "categorical") for c in s.categorical]
                + [(c, "missing_flag") for c in s.missing_flags] + [(c, "id") for c in s.id_columns]
                + ([(s.target, "target")] if s.target else []), "name string, role string"),
        }

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame], keep_nulls: bool = False) -> "FeaturePlan":
        roles = tables["columns"].collect()
        by_role = {}
        for r in roles:
            by_role.setdefault(r["role"], []).append(r["name"])
        target = (by_role.get("target") or [None])[0]
        plan = cls(target=target, id_columns=by_role.get("id", []), exclude_ids=True, keep_nulls=keep_nulls)
        imp = tables["impute"].collect()
        plan.state = PlanState(
            target, by_role.get("id", []), by_role.get("numeric", []), by_role.get("categorical", []),
            by_role.get("missing_flag", []),
            {r["column"]: r["num_value"] for r in imp if r["kind"] == "median"},
            {r["column"]: r["str_value"] for r in imp if r["kind"] == "mode"},
            tables["encoders"],
            {r["column"]: {"mean": r["mean"], "std": r["std"]} for r in tables["stats"].collect()},
            [r["name"] for r in tables["features"].orderBy("position").collect()],
        )
        # keep the listed order of numeric / categorical columns as written
        return plan
