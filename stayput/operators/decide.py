"""Decision operators: tiers, value at risk, reasons, actions, what-if impact.

All per-row and narrow: rule lists become ``array<struct>`` columns that are
exploded (a Generate node in the same stage); the what-if scenarios are a
literal array exploded per customer, so no join and no shuffle is needed
until the per-customer best action (one hash aggregation by customer).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayput import presets
from stayput.functions.columns import bin_left_closed, ne_null_true, round_half_even, sigmoid
from stayput.operators import score


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# D1-D4, D9
# ---------------------------------------------------------------------------
def risk_tier(p: str | Column, cuts=presets.TIER_CUTS, top: str = presets.TIER_TOP) -> Column:
    """Left-closed cut points (p < 0.30 LOW, < 0.50 MEDIUM, < 0.70 HIGH, else CRITICAL)."""
    return bin_left_closed(p, cuts, top)


def tier_label(tier: str | Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in presets.TIER_LABELS.items() for x in kv])
    return F.try_element_at(m, _c(tier))


def months_remaining(contract: str | Column, tenure: str | Column) -> Column:
    """Two-year max(6, 24 - t mod 24); one-year max(3, 12 - t mod 12); else 6."""
    t = _c(tenure)      # fractional months stay fractional
    expr = None
    for name, cycle, floor in presets.CONTRACT_MONTHS:
        val = F.greatest(F.lit(floor), F.lit(cycle) - F.pmod(t, F.lit(cycle)))
        cond = _c(contract) == name
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(presets.MONTHS_FLAT))


def with_value_at_risk(df: DataFrame, p: str = "probability", monthly: str = "MonthlyCharges",
                       tenure: str = "tenure", contract: str = "Contract") -> DataFrame:
    """attrition_probability (percent, 2 dp), risk_tier, months_remaining, clv, clv_at_risk."""
    return (df
            .withColumn("attrition_probability", round_half_even(F.col(p) * 100, 2))
            .withColumn("risk_tier", risk_tier(p))
            .withColumn("months_remaining", months_remaining(contract, tenure))
            .withColumn("clv", F.col(monthly) * F.col("months_remaining"))
            .withColumn("clv_at_risk",
                        round_half_even(F.col("clv") * (F.col("attrition_probability") / 100), 2)))


def stay_or_leave(p: str | Column, threshold: float = presets.DECISION_THRESHOLD) -> Column:
    """Strict ``p > threshold`` label."""
    return F.when(_c(p) > threshold, F.lit("Likely to leave")).otherwise(F.lit("Likely to stay"))


# ---------------------------------------------------------------------------
# D5 risk drivers, D6 playbook
# ---------------------------------------------------------------------------
def _entry(label: str, value: Column, level: str, note_key: tuple[str, str] | None = None) -> Column:
    note = presets.DRIVER_NOTES.get(note_key or (label, level), "")
    return F.struct(F.lit(label).alias("label"), value.cast("string").alias("value"),
                    F.lit(level).alias("level"), F.lit(note).alias("note"))


def _not_subscribed(col: Column, internet: Column) -> Column:
    return col.isin(*presets.INACTIVE_SERVICE_VALUES) & ne_null_true(internet, "No")


def risk_driver_array(contract="Contract", tenure="tenure", payment="PaymentMethod",
                      internet="InternetService", tech="TechSupport", security="OnlineSecurity",
                      monthly="MonthlyCharges") -> Column:
    """Ordered ``array<struct<label,value,level,note>>`` of the seven driver rules."""
    c, t, pm, it = _c(contract), _c(tenure), _c(payment), _c(internet)
    ts, os_, mc = _c(tech), _c(security), _c(monthly)
    name, value = presets.DRIVER_LABELS, presets.DRIVER_VALUES
    contract_e = (F.when(c == "Month-to-month", _entry(name["contract"], c, "HIGH"))
                  .when(c == "One year", _entry(name["contract"], c, "MEDIUM"))
                  .otherwise(_entry(name["contract"], c, "SAFE")))
    months = F.concat(t.cast("string"), F.lit(" months"))
    tenure_e = (F.when(t < presets.TENURE_NEW, _entry(name["tenure"], months, "HIGH"))
                .when(t < presets.TENURE_EARLY, _entry(name["tenure"], months, "MEDIUM"))
                .otherwise(_entry(name["tenure"], months, "SAFE")))
    pay_e = (F.when(pm == "Electronic check", _entry(name["payment"], pm, "HIGH"))
             .when(F.lower(pm).contains(presets.AUTOMATIC_MARKER), _entry(name["payment"], pm, "SAFE"))
             .otherwise(_entry(name["payment"], pm, "MEDIUM")))
    inet_e = (F.when(it == "Fiber optic",
                     _entry(name["internet"], it, "MEDIUM", (name["internet"], "FIBER")))
              .when(it == "No", _entry(name["internet"], F.lit(value["no internet"]), "MEDIUM",
                                       (name["internet"], "NONE")))
              .otherwise(_entry(name["internet"], it, "SAFE")))
    tech_e = (F.when(_not_subscribed(ts, it), _entry(name["tech"], F.lit(value["missing"]), "MEDIUM"))
              .when(ts == "Yes", _entry(name["tech"], F.lit(value["present"]), "SAFE")))
    sec_e = (F.when(_not_subscribed(os_, it), _entry(name["security"], F.lit(value["missing"]), "LOW"))
             .when(os_ == "Yes", _entry(name["security"], F.lit(value["present"]), "SAFE")))
    # "$<charges, 0 decimals>/mo": rint is round-half-even on the double, as Python's format
    charge_value = F.concat(F.lit("$"), F.rint(mc).cast("bigint").cast("string"), F.lit("/mo"))
    charge_e = F.when((mc > presets.HIGH_CHARGE) & (t < presets.SHORT_TENURE),
                      _entry(name["charges"], charge_value, "HIGH"))
    arr = F.array(contract_e, tenure_e, pay_e, inet_e, tech_e, sec_e, charge_e)
    return F.array_compact(arr)


def risk_drivers(df: DataFrame, id_col: str = "customerID", **cols) -> DataFrame:
    """D5 long form: (id, position, label, value, level, note), position from 1."""
    return (df.select(id_col, F.posexplode(risk_driver_array(**cols)).alias("pos", "d"))
            .select(id_col, (F.col("pos") + 1).cast("int").alias("position"),
                    "d.label", "d.value", "d.level", "d.note"))


def _action(key: str) -> Column:
    for k, title, detail, priority in presets.PLAYBOOK:
        if k == key:
            return F.struct(F.lit(title).alias("title"), F.lit(detail).alias("detail"),
                            F.lit(priority).alias("priority"))
    raise KeyError(key)


def playbook_array(p="probability", contract="Contract", payment="PaymentMethod",
                   internet="InternetService", tech="TechSupport", security="OnlineSecurity",
                   tenure="tenure") -> Column:
    """Ordered ``array<struct<title,detail,priority>>``; falls back to "Monitor & Maintain"."""
    pc, c, pm, it = _c(p), _c(contract), _c(payment), _c(internet)
    ts, os_, t = _c(tech), _c(security), _c(tenure)
    manual = F.coalesce(~F.lower(pm).contains(presets.AUTOMATIC_MARKER), F.lit(True))
    arr = F.array(
        F.when(pc > presets.OUTREACH_THRESHOLD, _action("outreach")),
        F.when(c == "Month-to-month", _action("annual")),
        F.when(manual, _action("autopay")),
        F.when(_not_subscribed(ts, it), _action("techsupport")),
        F.when(_not_subscribed(os_, it), _action("security")),
        F.when(t < presets.SHORT_TENURE, _action("loyalty")),
    )
    acts = F.array_compact(arr)
    return F.when(F.size(acts) == 0, F.array(_action("monitor"))).otherwise(acts)


def retention_playbook(df: DataFrame, id_col: str = "customerID", **cols) -> DataFrame:
    """D6 long form: (id, position, title, detail, priority)."""
    return (df.select(id_col, F.posexplode(playbook_array(**cols)).alias("pos", "a"))
            .select(id_col, (F.col("pos") + 1).cast("int").alias("position"),
                    "a.title", "a.detail", "a.priority"))


# ---------------------------------------------------------------------------
# D7 scenario impact, D8 best action, D10 text
# ---------------------------------------------------------------------------
def scenario_array(scenarios: Sequence = presets.SCENARIOS) -> Column:
    """Literal array of scenario structs (action, rank, overrides..., charge_factor)."""
    items = []
    for rank, (action, overrides, factor) in enumerate(scenarios):
        fields = [F.lit(action).alias("action"), F.lit(rank).alias("rank")]
        for col in presets.SCENARIO_COLUMNS:
            fields.append(F.lit(overrides.get(col)).cast("string").alias(col))
        fields.append(F.lit(factor).cast("double").alias("charge_factor"))
        needs_internet = any(c in INTERNET_ADDONS for c in overrides)
        fields.append(F.lit(needs_internet).alias("needs_internet"))
        items.append(F.struct(*fields))
    return F.array(*items)


# add-on services that only exist with an internet service
INTERNET_ADDONS = ("TechSupport", "OnlineSecurity", "OnlineBackup")


def apply_scenarios(df: DataFrame, scenarios: Sequence = presets.SCENARIOS,
                    monthly: str = "MonthlyCharges", valid_only: bool = False) -> DataFrame:
    """Each row once per scenario with its overrides applied (a narrow explode).

    The reference applies add-on scenarios to every customer; ``valid_only``
    skips them for customers without an internet service.
    """
    exploded = df.withColumn("_sc", F.explode(scenario_array(scenarios)))
    if valid_only and "InternetService" in df.columns:
        exploded = exploded.where(~(F.col("_sc.needs_internet") & (F.col("InternetService") == "No")))
    out = exploded
    for col in presets.SCENARIO_COLUMNS:
        if col in df.columns:
            out = out.withColumn(col, F.coalesce(F.col(f"_sc.{col}"), F.col(col)))
    out = out.withColumn(
        monthly,
        F.when(F.col("_sc.charge_factor").isNotNull(),
               F.greatest(F.lit(presets.SCENARIO_MIN_CHARGE), F.col(monthly) * F.col("_sc.charge_factor")))
        .otherwise(F.col(monthly)))
    return out.withColumn("action", F.col("_sc.action")).withColumn("action_rank", F.col("_sc.rank")).drop("_sc")


def scenario_impact(df: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                    id_col: str = "customerID", scenarios: Sequence = presets.SCENARIOS,
                    min_delta: float = presets.SCENARIO_MIN_DELTA, valid_only: bool = False) -> DataFrame:
    """Rescore every customer under each scenario; keep |base - new| > min_delta.

    ``scorer`` maps a DataFrame to the same DataFrame plus ``probability``.
    Output: id, action, action_rank, base_probability, new_probability, delta,
    attrition_probability_pct (1 dp), reduction_pp (1 dp).
    """
    base = scorer(df).withColumnRenamed("probability", "base_probability")
    keep = [c for c in base.columns if c in df.columns or c == "base_probability"]
    varied = scorer(apply_scenarios(base.select(*keep), scenarios, valid_only=valid_only))
    delta = F.col("base_probability") - F.col("probability")
    return (varied.where(F.abs(delta) > min_delta)
            .select(id_col, "action", F.col("action_rank").cast("int").alias("action_rank"),
                    "base_probability", F.col("probability").alias("new_probability"),
                    delta.alias("delta"),
                    round_half_even(F.col("probability") * 100, 1).alias("attrition_probability_pct"),
                    round_half_even(delta * 100, 1).alias("reduction_pp")))


def best_action(impact: DataFrame, id_col: str = "customerID") -> DataFrame:
    """The largest reduction per customer; ties go to the earlier scenario."""
    best = F.max(F.struct(F.col("delta"), (-F.col("action_rank")).alias("neg_rank"),
                          F.col("action"), F.col("base_probability"), F.col("new_probability"),
                          F.col("attrition_probability_pct"), F.col("reduction_pp")))
    return (impact.groupBy(id_col).agg(best.alias("b"))
            .select(id_col, "b.action", "b.base_probability", "b.new_probability", "b.delta",
                    "b.attrition_probability_pct", "b.reduction_pp"))


def best_action_in_row(df: DataFrame, trees, id_col: str = "customerID", scenarios: Sequence = presets.SCENARIOS,
                       min_delta: float = presets.SCENARIO_MIN_DELTA, monthly: str = "MonthlyCharges") -> DataFrame:
    """D8 for a small tree ensemble, in one narrow pass: every scenario is scored in the customer's own row and the best one read off.

    Equal to ``best_action(scenario_impact(...))`` with that ensemble; neither an explode nor a shuffle by customer. A customer for whom no
    scenario moves the probability by more than ``min_delta`` has no row.
    """
    rows = score.tree_rows(trees)
    known = set(df.columns)
    changed = {}
    for k, (_, overrides, factor) in enumerate(scenarios):
        for c, value in overrides.items():
            if c in known:
                changed[f"_s{k}_{c}"] = F.lit(value)
        if factor is not None:
            changed[f"_s{k}_{monthly}"] = F.greatest(F.lit(presets.SCENARIO_MIN_CHARGE), F.col(monthly) * F.lit(factor))
    wide = df.withColumns(changed)

    def probability(k: int | None) -> Column:
        mine = [(*r[:2], f"_s{k}_{r[2]}" if f"_s{k}_{r[2]}" in changed else r[2], *r[3:]) for r in rows]
        total = None
        for tree in score.compile_trees(wide, mine):
            total = tree if total is None else total + tree
        return sigmoid(total)

    wide = wide.withColumn("_base", probability(None)).withColumns({f"_p{k}": probability(k) for k in range(len(scenarios))})
    tried = []
    for k, (action, _, _) in enumerate(scenarios):
        p = F.col(f"_p{k}")
        delta = F.col("_base") - p
        tried.append(F.when(F.abs(delta) > min_delta, F.struct(
            delta.alias("delta"), F.lit(-k).alias("neg_rank"), F.lit(action).alias("action"), F.col("_base").alias("base_probability"),
            p.alias("new_probability"), round_half_even(p * 100, 1).alias("attrition_probability_pct"),
            round_half_even(delta * 100, 1).alias("reduction_pp"))))
    best = wide.select(id_col, F.array_max(F.array(*tried)).alias("b")).where("b IS NOT NULL")
    return best.select(id_col, "b.action", "b.base_probability", "b.new_probability", "b.delta", "b.attrition_probability_pct", "b.reduction_pp")


def impact_text(action: str | Column, base_p: str | Column, new_pct: str | Column,
                reduction: str | Column) -> tuple[Column, Column]:
    """``"<action>  (a% → b%)"`` and ``"−x.x pp"``; values rounded half-even first."""
    base_pct = round_half_even(_c(base_p) * 100, 1)
    label = F.format_string("%s  (%.1f%% → %.1f%%)", _c(action), base_pct, _c(new_pct))
    text = F.format_string("−%.1f pp", _c(reduction))
    return label, text
