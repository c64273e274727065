"""DuckDB SQL oracles for the registered queries.

Each text runs on the pre-registered views (customer, lineitem, orders,
labels, ...). The subscriber view and the worked-example ensemble are shared
CTE prefixes; everything else is written per query.
"""

from __future__ import annotations

from stayput import presets

SUBSCRIBERS = """
base AS (
  SELECT c_custkey, c_name AS customerID, c_nationkey, c_mktsegment, c_acctbal,
    CAST((c_custkey * 37) % 73 AS INT) AS tenure,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'One year' WHEN 'HOUSEHOLD' THEN 'Two year' ELSE 'Month-to-month' END AS Contract,
    CASE WHEN c_nationkey % 5 = 0 THEN 'No' WHEN c_nationkey % 5 IN (1, 2) THEN 'DSL' ELSE 'Fiber optic' END AS InternetService,
    CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
      WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
    CASE WHEN c_custkey % 10 = 9 THEN 'No' ELSE 'Yes' END AS PhoneService,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 18.25E0 + (c_acctbal + 1000) / 100 END AS MonthlyCharges
  FROM customer
), subscribers AS (
  SELECT c_custkey, customerID,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
    tenure, PhoneService,
    CASE WHEN PhoneService = 'No' THEN 'No phone service' WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    InternetService,
    CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN c_custkey % 7 < 2 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN c_custkey % 11 < 4 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN c_custkey % 11 < 3 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN c_custkey % 13 < 5 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    Contract,
    CASE WHEN c_custkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    PaymentMethod, MonthlyCharges,
    CASE WHEN tenure = 0 THEN NULL ELSE tenure * MonthlyCharges END AS TotalCharges,
    CASE WHEN 20 * ((CASE WHEN Contract = 'Month-to-month' THEN 1 ELSE 0 END)
                  + (CASE WHEN PaymentMethod = 'Electronic check' THEN 1 ELSE 0 END)
                  + (CASE WHEN InternetService = 'Fiber optic' THEN 1 ELSE 0 END)
                  + (CASE WHEN tenure < 12 THEN 1 ELSE 0 END)) + (c_custkey * 13) % 50 >= 65
         THEN 'Yes' ELSE 'No' END AS Departed
  FROM base
)"""


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({float(v)!r} AS DOUBLE)"


def _tree_sql(nodes: dict, node: int = 0) -> str:
    feature, op, threshold, yes, no, leaf = nodes[node]
    if feature is None:
        return _lit(float(leaf))
    if op in (">", "<", ">=", "<="):
        test = f"{feature} {op} {_lit(float(threshold))}"
    else:
        test = f"{feature} = {_lit(threshold)}"
    return f"(CASE WHEN {test} THEN {_tree_sql(nodes, yes)} ELSE {_tree_sql(nodes, no)} END)"


def ensemble_sql(trees=presets.WORKED_EXAMPLE_TREES) -> str:
    by_tree: dict = {}
    for t, n, f, op, th, y, no, leaf in trees:
        by_tree.setdefault(t, {})[n] = (f, op, th, y, no, leaf)
    return " + ".join(_tree_sql(by_tree[t]) for t in sorted(by_tree))


# scored subscribers: raw score, probability, prediction, tier, value at risk
SCORED = SUBSCRIBERS + f""", scored0 AS (
  SELECT *, {ensemble_sql()} AS raw_score FROM subscribers
), scored1 AS (
  SELECT *, 1 / (1 + exp(-raw_score)) AS probability FROM scored0
), scored AS (
  SELECT *,
    CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
    CASE WHEN Departed = 'Yes' THEN 1 ELSE 0 END AS y,
    round_even(probability * 100 * 100, 0) / 100 AS attrition_probability,
    CASE WHEN probability < 0.30 THEN 'LOW' WHEN probability < 0.50 THEN 'MEDIUM'
         WHEN probability < 0.70 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_tier,
    CAST(CASE WHEN Contract = 'Two year' THEN greatest(6, 24 - ((tenure % 24) + 24) % 24)
         WHEN Contract = 'One year' THEN greatest(3, 12 - ((tenure % 12) + 12) % 12)
         ELSE 6 END AS INT) AS months_remaining
  FROM scored1
), valued AS (
  SELECT *, MonthlyCharges * months_remaining AS clv,
    round_even(MonthlyCharges * months_remaining * (attrition_probability / 100) * 100, 0) / 100 AS clv_at_risk
  FROM scored
)"""


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ---------------------------------------------------------------------------
# M: scoring
# ---------------------------------------------------------------------------
register("m3_ensemble_score", with_ctes(SCORED, """
SELECT customerID, round(raw_score, 6) AS raw_score, round(probability, 6) AS probability, prediction
FROM scored"""))

register("m3_ensemble_score_large", with_ctes(SUBSCRIBERS, f"""
SELECT customerID, round(({ensemble_sql()}) * {sum((i % 5 + 1) / 64 for i in range(40))}E0, 6) AS raw_score FROM subscribers"""))

register("m5_decide_threshold", with_ctes(SCORED, """
SELECT customerID,
  CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS pred_050,
  CASE WHEN probability >= 0.6 THEN 1 ELSE 0 END AS pred_060,
  CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS pred_strict_050
FROM scored"""))

# ---------------------------------------------------------------------------
# D: decisions
# ---------------------------------------------------------------------------
register("d1_risk_tier", with_ctes(SCORED, """
SELECT customerID, round(probability, 6) AS probability, risk_tier,
  CASE risk_tier WHEN 'LOW' THEN 'Low Risk' WHEN 'MEDIUM' THEN 'Medium Risk'
       WHEN 'HIGH' THEN 'High Risk' WHEN 'CRITICAL' THEN 'Critical Risk' END AS tier_label
FROM scored"""))

register("d2_clv_estimate", with_ctes(SCORED, """
SELECT customerID, Contract, tenure, months_remaining, round(clv, 6) AS clv FROM valued"""))

register("d3_clv_at_risk", with_ctes(SCORED, """
SELECT customerID, attrition_probability, clv_at_risk FROM valued"""))

register("d4_percent_probability", with_ctes(SCORED, """
SELECT customerID, attrition_probability FROM scored"""))

register("d9_stay_or_leave", with_ctes(SCORED, """
SELECT customerID, CASE WHEN probability > 0.5 THEN 'Likely to leave' ELSE 'Likely to stay' END AS outcome
FROM scored"""))

# ---------------------------------------------------------------------------
# A: portfolio
# ---------------------------------------------------------------------------
register("a1_portfolio_kpi", with_ctes(SCORED, """
SELECT count(*) AS customers,
  count(*) FILTER (WHERE probability >= 0.5) AS predicted_attrition,
  round(CAST(count(*) FILTER (WHERE probability >= 0.5) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 6) AS predicted_attrition_pct,
  count(*) FILTER (WHERE risk_tier IN ('HIGH', 'CRITICAL')) AS high_critical,
  CAST(sum(CAST(clv_at_risk AS DECIMAL(38, 2))) AS DOUBLE) AS clv_at_risk_total
FROM valued"""))

register("a2_tier_distribution", with_ctes(SCORED + """, tiers AS (
  SELECT * FROM (VALUES (0, 'LOW'), (1, 'MEDIUM'), (2, 'HIGH'), (3, 'CRITICAL')) t(tier_rank, risk_tier)
), agg AS (
  SELECT risk_tier, count(*) AS n, CAST(sum(CAST(clv_at_risk AS DECIMAL(38, 2))) AS DOUBLE) AS v
  FROM valued GROUP BY risk_tier
)""", """
SELECT CAST(t.tier_rank AS INT) AS tier_rank, t.risk_tier, CAST(coalesce(a.n, 0) AS BIGINT) AS customers,
  coalesce(a.v, 0.0) AS clv_at_risk
FROM tiers t LEFT JOIN agg a ON t.risk_tier = a.risk_tier ORDER BY tier_rank"""))

register("a3_probability_histogram", with_ctes(SCORED + """, b AS (
  SELECT least(29, greatest(0, CAST(floor(attrition_probability / (100.0E0 / 30)) AS INT))) AS bin
  FROM scored WHERE attrition_probability IS NOT NULL
)""", """
SELECT bin, round(bin * (100.0E0 / 30), 6) AS bin_start, count(*) AS customers
FROM b GROUP BY bin ORDER BY bin"""))

register("a4_top10", with_ctes(SCORED, """
SELECT customerID, attrition_probability, risk_tier, clv_at_risk, Contract, tenure,
  round(MonthlyCharges, 6) AS MonthlyCharges
FROM valued ORDER BY attrition_probability DESC, customerID ASC LIMIT 10"""))

register("p9_high_risk_filter", with_ctes(SCORED, """
SELECT customerID, attrition_probability FROM scored WHERE attrition_probability >= 50.0"""))

# ---------------------------------------------------------------------------
# helpers for the P / C / F / E oracles
# ---------------------------------------------------------------------------
INPUTS = ", ".join(presets.INPUT_COLUMNS)
SUB_CAT = [c for c in presets.INPUT_COLUMNS
           if c not in ("customerID", "SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges")]
NUMS = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def pairs_sql(table: str, cols, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM {table}{w}" for c in cols)


def dict_sql(table: str, cols, where: str = "") -> str:
    return f"""SELECT col, value, CAST(row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS INT) AS code
  FROM (SELECT DISTINCT col, value FROM ({pairs_sql(table, cols, where)}) p WHERE value IS NOT NULL) d"""


def bins_sql(x: str, edges) -> str:
    parts = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN {i}"
                     for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])))
    return f"CAST(CASE {parts} ELSE -1 END AS INT)"


def flag_sql(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INT)"


INDICATOR_SQL = {
    "has_internet": "InternetService IN ('DSL', 'Fiber optic')",
    "has_phone": "PhoneService = 'Yes'",
    "is_month_to_month": "Contract = 'Month-to-month'",
    "is_automatic_payment": "contains(PaymentMethod, 'automatic')",
    "is_senior": "SeniorCitizen = 1",
    "has_dependents": "Dependents = 'Yes'",
}
TOTAL_SERVICES_SQL = "CAST(" + " + ".join(
    f"(CASE WHEN {c} IS NULL OR {c} NOT IN ('No', 'No internet service') THEN 1 ELSE 0 END)"
    for c in presets.SERVICE_COLUMNS) + " AS INT)"
RISK_SQL = "(" + " + ".join(flag_sql(f"{c} = '{v}'") for c, v in presets.RISK_SCORE_PARTS) + ")"


def engineered_sql() -> str:
    return ",\n    ".join([
        f"{bins_sql('tenure', presets.TENURE_EDGES)} AS tenure_group",
        "tenure / 72.0E0 AS tenure_to_max",
        "CAST(tenure AS DOUBLE) / (MonthlyCharges + 1) AS tenure_monthly_ratio",
        f"{bins_sql('MonthlyCharges', presets.CHARGE_EDGES)} AS charge_group",
        f"{TOTAL_SERVICES_SQL} AS total_services",
        *[f"{flag_sql(cond)} AS {name}" for name, cond in INDICATOR_SQL.items()],
        f"{RISK_SQL} AS attrition_risk_score",
    ])


def signed_sql(col: str) -> str:
    m = presets.SIGNED_MAPS[col]
    whens = " ".join(f"WHEN {_lit(k) if isinstance(k, str) else k} THEN {v}" for k, v in m.items())
    return f"CAST(CASE {col} {whens} END AS INT)"


IMPUTED = SUBSCRIBERS + """, imputed AS (
  SELECT customerID, gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, MultipleLines,
    InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV,
    StreamingMovies, Contract, PaperlessBilling, PaymentMethod,
    coalesce(MonthlyCharges, (SELECT median(MonthlyCharges) FROM subscribers)) AS MonthlyCharges,
    coalesce(TotalCharges, (SELECT median(TotalCharges) FROM subscribers)) AS TotalCharges,
    Departed,
    CAST(MonthlyCharges IS NULL AS INT) AS MonthlyCharges_is_na,
    CAST(TotalCharges IS NULL AS INT) AS TotalCharges_is_na
  FROM subscribers
), zstats AS (
  SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMS) + """
  FROM imputed
)"""

# ---------------------------------------------------------------------------
# P
# ---------------------------------------------------------------------------
register("p1_drop_target", with_ctes(SUBSCRIBERS, f"SELECT {INPUTS} FROM subscribers"))
register("p2_reorder_columns", with_ctes(SUBSCRIBERS, f"SELECT {INPUTS}, Departed FROM subscribers"))
register("p3_align_fill_zero", with_ctes(SUBSCRIBERS, f"""
SELECT {INPUTS}, 0 AS MonthlyCharges_is_na, {bins_sql('tenure', presets.TENURE_EDGES)} AS tenure_group,
  0 AS tenure_to_max, 0 AS tenure_monthly_ratio FROM subscribers"""))
register("p4_align_fill_null", with_ctes(SUBSCRIBERS, f"""
SELECT {INPUTS}, CAST(NULL AS DOUBLE) AS MonthlyCharges_is_na, {bins_sql('tenure', presets.TENURE_EDGES)} AS tenure_group,
  CAST(NULL AS DOUBLE) AS tenure_to_max, CAST(NULL AS DOUBLE) AS tenure_monthly_ratio FROM subscribers"""))
register("p8_profile", with_ctes(SUBSCRIBERS, """
SELECT count(*) AS "rows", 21 AS "columns", 4 AS numeric_columns, 17 AS string_columns,
  CAST(count(*) FILTER (WHERE MonthlyCharges IS NULL) + count(*) FILTER (WHERE TotalCharges IS NULL) AS BIGINT) AS null_cells
FROM subscribers"""))
register("p10_isin_predicate", with_ctes(SUBSCRIBERS, """
SELECT customerID, InternetService FROM subscribers WHERE InternetService IN ('DSL', 'Fiber optic')"""))
register("p11_contains_predicate", """
SELECT o_orderkey, CAST(coalesce(contains(o_orderpriority, 'URGENT'), false) AS INT) AS is_urgent FROM orders""")
register("p12_rename_columns", with_ctes(SUBSCRIBERS, """
SELECT customerID AS customer_id, tenure AS tenure_months, Contract AS contract_type FROM subscribers"""))
register("p13_preview", with_ctes(SUBSCRIBERS, f"""
SELECT {INPUTS}, Departed FROM subscribers ORDER BY customerID LIMIT 5"""))

# ---------------------------------------------------------------------------
# C
# ---------------------------------------------------------------------------
register("c1_dedupe_rows", "SELECT event_id, user_id, event_type FROM (SELECT DISTINCT * FROM events) e")
register("c1_dedupe", """
SELECT CAST(count(*) AS BIGINT) AS rows_before,
  (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_quantity, l_returnflag, l_linestatus FROM lineitem) d) AS rows_after,
  CAST(count(*) AS BIGINT) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_quantity, l_returnflag, l_linestatus FROM lineitem) d) AS removed
FROM lineitem""")
register("c2_missing_flags", with_ctes(SUBSCRIBERS, """
SELECT customerID, CAST(MonthlyCharges IS NULL AS INT) AS MonthlyCharges_is_na,
  CAST(TotalCharges IS NULL AS INT) AS TotalCharges_is_na FROM subscribers"""))
register("c3_median_impute", with_ctes(IMPUTED, """
SELECT customerID, tenure, round(MonthlyCharges, 6) AS MonthlyCharges, round(TotalCharges, 6) AS TotalCharges
FROM imputed"""))
register("c3_median_table_lineitem", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS median FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
register("c4_mode_table", """
WITH c AS (
  SELECT 'o_orderstatus' AS col, o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'o_orderpriority' AS col, o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 2
)
SELECT col AS "column", value AS mode FROM (
  SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value ASC) AS rn FROM c) r WHERE rn = 1""")
register("c5_fill_zero", with_ctes(SUBSCRIBERS, """
SELECT customerID, round(coalesce(MonthlyCharges, 0), 6) AS MonthlyCharges,
  round(coalesce(TotalCharges, 0), 6) AS TotalCharges FROM subscribers"""))
register("c6_derive_total", with_ctes(SUBSCRIBERS, """
SELECT customerID, round(coalesce(TotalCharges, tenure * MonthlyCharges), 6) AS TotalCharges FROM subscribers"""))

# ---------------------------------------------------------------------------
# F
# ---------------------------------------------------------------------------
def _feat(name: str, expr: str, rounded: bool = False) -> None:
    e = f"round({expr}, 6)" if rounded else expr
    register(name, with_ctes(SUBSCRIBERS, f"SELECT customerID, {e} AS {name.split('_', 1)[1]} FROM subscribers"))


_feat("f1_tenure_group", bins_sql("tenure", presets.TENURE_EDGES))
_feat("f2_tenure_to_max", "tenure / 72.0E0", True)
_feat("f3_tenure_monthly_ratio", "CAST(tenure AS DOUBLE) / (MonthlyCharges + 1)", True)
_feat("f4_charge_group", bins_sql("MonthlyCharges", presets.CHARGE_EDGES))
_feat("f5_total_services", TOTAL_SERVICES_SQL)
for _i, (_n, _cond) in enumerate(INDICATOR_SQL.items()):
    _feat(f"f{6 + _i}_{_n}", flag_sql(_cond))
_feat("f12_attrition_risk_score", RISK_SQL)
register("f14_avg_charge", with_ctes(SUBSCRIBERS, """
SELECT customerID, round(CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END, 6) AS AvgCharge
FROM subscribers"""))
register("f15_charge_diff", with_ctes(SUBSCRIBERS, """
SELECT customerID, round(MonthlyCharges - CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END, 6) + 0.0E0 AS ChargeDiff
FROM subscribers"""))
register("f16_signed_encode", with_ctes(SUBSCRIBERS, "SELECT customerID, " + ", ".join(
    f"{signed_sql(c)} AS {c}" for c in presets.SIGNED_MAPS) + " FROM subscribers"))
register("f17_total_count", with_ctes(SUBSCRIBERS, "SELECT customerID, CAST(" + " + ".join(
    f"coalesce({signed_sql(c)}, 0)" for c in presets.SIGNED_COUNT_EVAL) + " AS BIGINT) AS total_count FROM subscribers"))
register("f1_bins_lineitem", f"""
SELECT l_orderkey, l_linenumber, {bins_sql('l_quantity', [0, 10, 20, 30, 40, 50])} AS quantity_bin FROM lineitem""")
register("f13_zscore", with_ctes(IMPUTED, "SELECT customerID, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}_zscore" for c in NUMS) + " FROM imputed, zstats"))
register("f13_zscore_lineitem", """
WITH s AS (SELECT avg(l_extendedprice) AS m1, stddev_samp(l_extendedprice) AS s1,
                  avg(l_quantity) AS m2, stddev_samp(l_quantity) AS s2 FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - m1) / s1, 6) AS l_extendedprice_zscore,
  round((l_quantity - m2) / s2, 6) AS l_quantity_zscore FROM lineitem, s""")

# ---------------------------------------------------------------------------
# E
# ---------------------------------------------------------------------------
register("e1_label_fit", with_ctes(SUBSCRIBERS, f"""
SELECT col AS "column", value, code FROM ({dict_sql('subscribers', SUB_CAT)}) x"""))

_LI_DICT = f"""dict AS ({dict_sql('lineitem', ['l_returnflag', 'l_linestatus'], "l_linestatus = 'F'")})"""
register("e2_label_encode_unseen", f"""
WITH {_LI_DICT}
SELECT l_orderkey, l_linenumber, coalesce(r.code, 0) AS l_returnflag, coalesce(s.code, 0) AS l_linestatus
FROM lineitem
LEFT JOIN dict r ON r.col = 'l_returnflag' AND r.value = l_returnflag
LEFT JOIN dict s ON s.col = 'l_linestatus' AND s.value = l_linestatus""")
register("e3_label_encode_keep_nulls", with_ctes(SUBSCRIBERS + f""", s2 AS (
  SELECT customerID, CASE WHEN MonthlyCharges IS NULL THEN NULL ELSE Contract END AS Contract, PaymentMethod, gender
  FROM subscribers
), dict AS ({dict_sql('s2', ['Contract', 'PaymentMethod', 'gender'])})""", """
SELECT customerID,
  CASE WHEN s2.Contract IS NULL THEN NULL ELSE coalesce(c.code, 0) END AS Contract,
  CASE WHEN s2.PaymentMethod IS NULL THEN NULL ELSE coalesce(p.code, 0) END AS PaymentMethod,
  CAST(NULL AS INT) AS gender
FROM s2
LEFT JOIN dict c ON c.col = 'Contract' AND c.value = s2.Contract
LEFT JOIN dict p ON p.col = 'PaymentMethod' AND p.value = s2.PaymentMethod"""))
register("e4_unseen_values", f"""
WITH {_LI_DICT}
SELECT DISTINCT p.col AS "column", p.value FROM ({pairs_sql('lineitem', ['l_returnflag', 'l_linestatus'])}) p
WHERE p.value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dict d WHERE d.col = p.col AND d.value = p.value)""")
register("e5_partition_encode", f"""
WITH dict AS ({dict_sql('lineitem', ['l_returnflag', 'l_linestatus'])})
SELECT coalesce(r.code, 0) AS l_returnflag, coalesce(s.code, 0) AS l_linestatus, count(*) AS n
FROM lineitem
LEFT JOIN dict r ON r.col = 'l_returnflag' AND r.value = l_returnflag
LEFT JOIN dict s ON s.col = 'l_linestatus' AND s.value = l_linestatus
GROUP BY 1, 2""")
register("e6_target_encode", with_ctes(SUBSCRIBERS + f", dict AS ({dict_sql('subscribers', ['Departed'])})", """
SELECT customerID, coalesce(d.code, 0) AS label FROM subscribers LEFT JOIN dict d ON d.value = Departed"""))
register("e7_decode", with_ctes(SCORED + f", dict AS ({dict_sql('subscribers', ['Departed'])})", """
SELECT customerID, prediction, d.value AS prediction_label FROM scored LEFT JOIN dict d ON d.code = prediction"""))
register("e8_fallback_target", with_ctes(SUBSCRIBERS, """
SELECT customerID, CASE WHEN Departed = 'Yes' THEN 1 WHEN Departed = 'No' THEN 0 ELSE 0 END AS y FROM subscribers"""))
register("e9_one_hot", with_ctes(SUBSCRIBERS, "SELECT customerID, " + ", ".join(
    f"{flag_sql(f'{c} = {_lit(v)}')} AS {q(c + '_' + v)}"
    for c in ["Contract", "InternetService", "PaymentMethod"]
    for v in sorted(presets.CATEGORY_DOMAINS[c])) + " FROM subscribers"))


def _feature_plan_sql() -> str:
    joins, cols = [], []
    for i, c in enumerate(presets.INPUT_COLUMNS):
        if c in SUB_CAT:
            joins.append(f"LEFT JOIN dict d{i} ON d{i}.col = '{c}' AND d{i}.value = imputed.{c}")
            cols.append(f"coalesce(d{i}.code, 0) AS {c}")
        elif c in ("MonthlyCharges", "TotalCharges"):
            cols.append(f"round(imputed.{c}, 6) AS {c}")
        else:
            cols.append(f"imputed.{c}")
    eng = engineered_sql().replace("tenure_to_max", "tenure_to_max_raw") \
        .replace("AS tenure_monthly_ratio", "AS tenure_monthly_ratio_raw")
    body = f"""
SELECT {", ".join(cols)}, Departed, MonthlyCharges_is_na, TotalCharges_is_na,
  tenure_group, round(tenure_to_max_raw, 6) AS tenure_to_max,
  round(tenure_monthly_ratio_raw, 6) AS tenure_monthly_ratio, charge_group, total_services, has_internet,
  has_phone, is_month_to_month, is_automatic_payment, is_senior, has_dependents, attrition_risk_score,
  {", ".join(f"round((imputed.{c} - m_{c}) / s_{c}, 6) AS {c}_zscore" for c in NUMS)}
FROM (SELECT *, {eng} FROM imputed) imputed, zstats
{chr(10).join(joins)}"""
    return with_ctes(IMPUTED + f", dict AS ({dict_sql('imputed', SUB_CAT)})", body)


register("e11_feature_plan", _feature_plan_sql())
register("e10_assemble_vector", "SELECT customerID, round(COLUMNS(* EXCLUDE (customerID, Departed))::DOUBLE, 6) AS '\\0' FROM ("
         + _feature_plan_sql() + ") e")
register("s6_latest_version", "SELECT concat('model-', CAST(max(event_id) AS VARCHAR)) AS path, max(event_id) AS saved_at FROM events")

# ---------------------------------------------------------------------------
# V
# ---------------------------------------------------------------------------
LABELS = "lab AS (SELECT doc_id, quality AS y, 1 - toxic AS yhat FROM labels)"
RANKED = SCORED + ", ranked AS (SELECT *, round(probability, 6) AS score FROM valued)"


def cum_sql(src: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    return f"""sc AS (
  SELECT {sel}score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
  FROM {src} WHERE y IS NOT NULL AND score IS NOT NULL GROUP BY {sel}score
), cum AS (
  SELECT *, sum(pos) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
            sum(neg) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
            lead(pos) OVER ({part}ORDER BY score DESC) AS next_pos,
            lead(neg) OVER ({part}ORDER BY score DESC) AS next_neg,
            row_number() OVER ({part}ORDER BY score DESC) AS rn
  FROM sc
)"""


def rank_metrics_sql(by: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""SELECT {sel}CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, count(*) AS distinct_scores,
  round(CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / (2.0E0 * sum(pos) * sum(neg)), 6) AS roc_auc,
  round(sum(CAST(pos AS DOUBLE) * CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) / sum(pos), 6) AS average_precision
FROM cum{grp}"""


register("v1_accuracy", with_ctes(SCORED, """
SELECT round(avg(CASE WHEN y = prediction THEN 1.0E0 ELSE 0.0E0 END), 6) AS accuracy FROM scored"""))
register("v2_f1", with_ctes(LABELS, """
SELECT count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
  round(CASE WHEN 2 * count(*) FILTER (WHERE y = 1 AND yhat = 1) + count(*) FILTER (WHERE y <> yhat) = 0 THEN 0.0E0
    ELSE 2.0E0 * count(*) FILTER (WHERE y = 1 AND yhat = 1)
      / (2 * count(*) FILTER (WHERE y = 1 AND yhat = 1) + count(*) FILTER (WHERE y <> yhat)) END, 6) AS f1
FROM lab"""))
register("v3_roc_auc", with_ctes(RANKED + ", " + cum_sql("ranked"), rank_metrics_sql()))
register("v3_roc_auc_lineitem", with_ctes(
    "li AS (SELECT CAST(l_returnflag = 'R' AS INT) AS y, l_discount * 10 AS score FROM lineitem), " + cum_sql("li"),
    rank_metrics_sql()))
register("v3_roc_auc_lineitem_price", with_ctes(
    "li AS (SELECT CAST(l_returnflag = 'R' AS INT) AS y, l_extendedprice AS score FROM lineitem), " + cum_sql("li"),
    rank_metrics_sql()))
register("v4_confusion_matrix", with_ctes(LABELS, """
SELECT 0 AS actual, count(*) FILTER (WHERE y = 0 AND yhat = 0) AS pred_0, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS pred_1 FROM lab
UNION ALL
SELECT 1 AS actual, count(*) FILTER (WHERE y = 1 AND yhat = 0) AS pred_0, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS pred_1 FROM lab"""))
register("v5_classification_report", with_ctes(LABELS + """, cc AS (
  SELECT count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp FROM lab
), per AS (
  SELECT *,
    CASE WHEN tn + fn = 0 THEN 0.0E0 ELSE tn / CAST(tn + fn AS DOUBLE) END AS p0,
    CASE WHEN tn + fp = 0 THEN 0.0E0 ELSE tn / CAST(tn + fp AS DOUBLE) END AS r0,
    CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0E0 ELSE 2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) END AS f0,
    CASE WHEN tp + fp = 0 THEN 0.0E0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS p1,
    CASE WHEN tp + fn = 0 THEN 0.0E0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS r1,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0E0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1,
    tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n
  FROM cc
)""", """
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM per
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n = 0 THEN 0.0E0 ELSE (tp + tn) / CAST(n AS DOUBLE) END, 6), CAST(n AS BIGINT) FROM per
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
  round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM per"""))
register("v6_roc_curve", with_ctes(RANKED + ", " + cum_sql("ranked") + """, tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc)""", """
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0E0 AS fpr, 0.0E0 AS tpr
UNION ALL
SELECT round(score, 6), round(fp / CAST(N AS DOUBLE), 6), round(tp / CAST(P AS DOUBLE), 6) FROM cum, tot
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"""))
register("v7_pr_curve", with_ctes(RANKED + ", " + cum_sql("ranked") + """, tot AS (SELECT sum(pos) AS P FROM sc)""", """
SELECT round(score, 6) AS threshold, round(CASE WHEN tp + fp = 0 THEN 0.0E0 ELSE tp / CAST(tp + fp AS DOUBLE) END, 6) AS precision,
  round(CASE WHEN P = 0 THEN 1.0E0 ELSE tp / CAST(P AS DOUBLE) END, 6) AS recall FROM cum, tot
UNION ALL SELECT NULL, 1.0E0, 0.0E0"""))
register("v8_average_precision", with_ctes(
    "li AS (SELECT l_linestatus, CAST(l_returnflag = 'R' AS INT) AS y, l_discount * 10 + l_tax AS score FROM lineitem), "
    + cum_sql("li", "l_linestatus"),
    """SELECT l_linestatus, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / (2.0E0 * sum(pos) * sum(neg)), 6) AS roc_auc,
  round(sum(CAST(pos AS DOUBLE) * CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) / sum(pos), 6) AS average_precision
FROM cum GROUP BY l_linestatus"""))
register("v9_log_loss", with_ctes(SCORED, """
SELECT round(avg(-(y * ln(least(greatest(probability, 1e-15), 1 - 1e-15))
  + (1 - y) * ln(1 - least(greatest(probability, 1e-15), 1 - 1e-15)))), 6) AS log_loss,
  round(avg(CASE WHEN y <> prediction THEN 1.0E0 ELSE 0.0E0 END), 6) AS error_rate FROM scored"""))
CTYPE = """CASE WHEN y = 1 AND yhat = 1 THEN 'TP' WHEN y = 0 AND yhat = 0 THEN 'TN'
  WHEN y = 0 AND yhat = 1 THEN 'FP' WHEN y = 1 AND yhat = 0 THEN 'FN' ELSE 'Unknown' END"""
register("v10_confusion_type", with_ctes(LABELS, f"SELECT doc_id, {CTYPE} AS confusion_type FROM lab"))
register("v11_confusion_type_counts", with_ctes(LABELS, f"""
SELECT {CTYPE} AS confusion_type, count(*) AS n FROM lab GROUP BY 1 ORDER BY n DESC, confusion_type"""))
register("v12_decoded_labels", with_ctes(LABELS, """
SELECT doc_id, CASE y WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS y_true_label,
  CASE yhat WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS y_pred_label FROM lab"""))
register("v13_false_negatives", with_ctes(SCORED, """
SELECT customerID, Contract, tenure, PaymentMethod FROM scored WHERE y = 1 AND prediction = 0"""))


def split_sql(src: str, key: str, label: str, fractions=presets.SPLIT_FRACTIONS, seed: int = presets.SEED) -> str:
    acc, whens = 0.0, []
    items = list(fractions.items())
    for name, f in items[:-1]:
        acc = round(acc + f, 12)
        whens.append(f"WHEN rk < floor(n * {acc!r}) THEN '{name}'")
    return f"""hs AS (
  SELECT *, md5(concat(CAST({key} AS VARCHAR), '{seed}')) AS hh FROM {src}
), rs AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY hh, {key}) - 1 AS rk,
    count(*) OVER (PARTITION BY {label}) AS n FROM hs
), splitted AS (
  SELECT *, CASE {' '.join(whens)} ELSE '{items[-1][0]}' END AS split FROM rs
)"""


register("v14_evaluation_bundle", with_ctes(RANKED + ", " + split_sql("ranked", "customerID", "y") + ", "
                                            + cum_sql("splitted", "split") + """, cnt AS (
  SELECT split, count(*) FILTER (WHERE y = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE y = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE y = 1 AND prediction = 1) AS tp
  FROM splitted GROUP BY split
), rk AS (""" + rank_metrics_sql("split") + ")", """
SELECT cnt.split, tn, fp, fn, tp, round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0E0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1,
  roc_auc, average_precision
FROM cnt JOIN rk ON cnt.split = rk.split"""))

# ---------------------------------------------------------------------------
# T
# ---------------------------------------------------------------------------
register("t1_stratified_split", with_ctes(SUBSCRIBERS + ", " + split_sql("subscribers", "customerID", "Departed"),
                                          "SELECT customerID, Departed, split FROM splitted"))
register("t1_stratified_split_orders", with_ctes(
    split_sql("(SELECT o_orderkey, o_orderstatus FROM orders)", "o_orderkey", "o_orderstatus"),
    "SELECT o_orderstatus, o_orderkey, split FROM splitted"))
register("t2_stratified_split_alt", with_ctes(
    split_sql("(SELECT o_orderkey, o_orderstatus FROM orders)", "o_orderkey", "o_orderstatus",
              presets.SPLIT_FRACTIONS_ALT),
    "SELECT o_orderstatus, split, count(*) AS n FROM splitted GROUP BY 1, 2"))
register("t3_kfold", """
WITH hs AS (SELECT o_orderkey, o_orderstatus, md5(concat(CAST(o_orderkey AS VARCHAR), '42')) AS hh FROM orders),
rs AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY hh, o_orderkey) - 1 AS rk FROM hs)
SELECT o_orderstatus, o_orderkey, CAST(rk % 5 AS INT) AS fold FROM rs""")
register("t3_kfold_null_label", """
WITH hs AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS label,
  md5(concat(CAST(o_orderkey AS VARCHAR), '42')) AS hh FROM orders),
rs AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY hh, o_orderkey) - 1 AS rk FROM hs)
SELECT o_orderkey, label, CAST(rk % 5 AS INT) AS fold FROM rs""")
register("t4_class_distribution", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
register("t5_pos_weight", with_ctes(SCORED, """
SELECT count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y <> 1) AS n_neg,
  CASE WHEN count(*) FILTER (WHERE y = 1) > 0
       THEN round(count(*) FILTER (WHERE y <> 1) / CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE), 4) ELSE 1.0E0 END AS scale_pos_weight
FROM scored"""))

# ---------------------------------------------------------------------------
# D5-D8, D10
# ---------------------------------------------------------------------------
def _note(label: str, level: str) -> str:
    return _lit(presets.DRIVER_NOTES[(label, level)])


def _drivers_sql() -> str:
    n = _note
    nosub = "{c} IN ('No', 'No internet service') AND (InternetService IS NULL OR InternetService <> 'No')"
    return f"""
  SELECT customerID, 1 AS k, 'Contract Type' AS label, Contract AS value,
    CASE WHEN Contract = 'Month-to-month' THEN 'HIGH' WHEN Contract = 'One year' THEN 'MEDIUM' ELSE 'SAFE' END AS level,
    CASE WHEN Contract = 'Month-to-month' THEN {n('Contract Type', 'HIGH')} WHEN Contract = 'One year'
      THEN {n('Contract Type', 'MEDIUM')} ELSE {n('Contract Type', 'SAFE')} END AS note FROM subscribers
  UNION ALL SELECT customerID, 2, 'Tenure', CAST(tenure AS VARCHAR) || ' months',
    CASE WHEN tenure < 6 THEN 'HIGH' WHEN tenure < 18 THEN 'MEDIUM' ELSE 'SAFE' END,
    CASE WHEN tenure < 6 THEN {n('Tenure', 'HIGH')} WHEN tenure < 18 THEN {n('Tenure', 'MEDIUM')} ELSE {n('Tenure', 'SAFE')} END
    FROM subscribers
  UNION ALL SELECT customerID, 3, 'Payment Method', PaymentMethod,
    CASE WHEN PaymentMethod = 'Electronic check' THEN 'HIGH' WHEN contains(lower(PaymentMethod), 'automatic') THEN 'SAFE' ELSE 'MEDIUM' END,
    CASE WHEN PaymentMethod = 'Electronic check' THEN {n('Payment Method', 'HIGH')}
      WHEN contains(lower(PaymentMethod), 'automatic') THEN {n('Payment Method', 'SAFE')} ELSE {n('Payment Method', 'MEDIUM')} END
    FROM subscribers
  UNION ALL SELECT customerID, 4, 'Internet Service', CASE WHEN InternetService = 'No' THEN 'None' ELSE InternetService END,
    CASE WHEN InternetService IN ('Fiber optic', 'No') THEN 'MEDIUM' ELSE 'SAFE' END,
    CASE WHEN InternetService = 'Fiber optic' THEN {n('Internet Service', 'FIBER')}
      WHEN InternetService = 'No' THEN {n('Internet Service', 'NONE')} ELSE {n('Internet Service', 'SAFE')} END
    FROM subscribers
  UNION ALL SELECT customerID, 5, 'Tech Support', CASE WHEN {nosub.format(c='TechSupport')} THEN 'Not subscribed' ELSE 'Active' END,
    CASE WHEN {nosub.format(c='TechSupport')} THEN 'MEDIUM' ELSE 'SAFE' END,
    CASE WHEN {nosub.format(c='TechSupport')} THEN {n('Tech Support', 'MEDIUM')} ELSE {n('Tech Support', 'SAFE')} END
    FROM subscribers WHERE {nosub.format(c='TechSupport')} OR TechSupport = 'Yes'
  UNION ALL SELECT customerID, 6, 'Online Security', CASE WHEN {nosub.format(c='OnlineSecurity')} THEN 'Not subscribed' ELSE 'Active' END,
    CASE WHEN {nosub.format(c='OnlineSecurity')} THEN 'LOW' ELSE 'SAFE' END,
    CASE WHEN {nosub.format(c='OnlineSecurity')} THEN {n('Online Security', 'LOW')} ELSE {n('Online Security', 'SAFE')} END
    FROM subscribers WHERE {nosub.format(c='OnlineSecurity')} OR OnlineSecurity = 'Yes'
  UNION ALL SELECT customerID, 7, 'High Charges / Short Tenure',
    '$' || CAST(CAST(round_even(MonthlyCharges, 0) AS BIGINT) AS VARCHAR) || '/mo', 'HIGH',
    {n('High Charges / Short Tenure', 'HIGH')}
    FROM subscribers WHERE MonthlyCharges > 80 AND tenure < 12"""


register("d5_risk_drivers", with_ctes(SUBSCRIBERS + f", dr AS ({_drivers_sql()})", """
SELECT customerID, CAST(row_number() OVER (PARTITION BY customerID ORDER BY k) AS INT) AS position,
  label, value, level, note FROM dr"""))


def _playbook_sql() -> str:
    pb = {k: (t, d, p) for k, t, d, p in presets.PLAYBOOK}
    nosub = "{c} IN ('No', 'No internet service') AND (InternetService IS NULL OR InternetService <> 'No')"
    rules = [
        ("outreach", "probability > 0.70"),
        ("annual", "Contract = 'Month-to-month'"),
        ("autopay", "coalesce(NOT contains(lower(PaymentMethod), 'automatic'), true)"),
        ("techsupport", nosub.format(c="TechSupport")),
        ("security", nosub.format(c="OnlineSecurity")),
        ("loyalty", "tenure < 12"),
    ]
    parts = [f"SELECT customerID, {i} AS k, {_lit(pb[key][0])} AS title, {_lit(pb[key][1])} AS detail, "
             f"{_lit(pb[key][2])} AS priority "
             f"FROM scored WHERE {cond}" for i, (key, cond) in enumerate(rules)]
    body = "\n  UNION ALL ".join(parts)
    return f"""acts AS ({body}
), allacts AS (
  SELECT * FROM acts
  UNION ALL SELECT customerID, 99, {_lit(pb['monitor'][0])}, {_lit(pb['monitor'][1])}, {_lit(pb['monitor'][2])} FROM scored
  WHERE customerID NOT IN (SELECT customerID FROM acts)
)"""


register("d6_retention_playbook", with_ctes(SCORED + ", " + _playbook_sql(), """
SELECT customerID, CAST(row_number() OVER (PARTITION BY customerID ORDER BY k) AS INT) AS position, title, detail, priority
FROM allacts"""))


def _scenario_sql() -> str:
    rows = []
    for rank, (action, ov, factor) in enumerate(presets.SCENARIOS):
        vals = [_lit(action), str(rank)] + [(_lit(ov[c]) if c in ov else "CAST(NULL AS VARCHAR)")
                                            for c in presets.SCENARIO_COLUMNS]
        vals.append(f"CAST({factor!r} AS DOUBLE)" if factor is not None else "CAST(NULL AS DOUBLE)")
        rows.append("(" + ", ".join(vals) + ")")
    cols = ", ".join(["action", "action_rank", *[f"o_{c}" for c in presets.SCENARIO_COLUMNS], "charge_factor"])
    over = ", ".join(f"coalesce(sc.o_{c}, s.{c}) AS {c}" for c in presets.SCENARIO_COLUMNS)
    keep = [c for c in presets.INPUT_COLUMNS if c not in presets.SCENARIO_COLUMNS and c != "MonthlyCharges"]
    return f"""scen({cols}) AS (VALUES {", ".join(rows)}
), base_p AS (
  SELECT *, 1 / (1 + exp(-({ensemble_sql()}))) AS base_probability FROM subscribers
), varied AS (
  SELECT {", ".join("s." + c for c in keep)}, s.base_probability, sc.action, sc.action_rank, {over},
    CASE WHEN sc.charge_factor IS NOT NULL THEN greatest(1.0E0, s.MonthlyCharges * sc.charge_factor)
         ELSE s.MonthlyCharges END AS MonthlyCharges
  FROM base_p s, scen sc
), rescored AS (
  SELECT *, 1 / (1 + exp(-({ensemble_sql()}))) AS new_probability FROM varied
), impact AS (
  SELECT customerID, action, action_rank, base_probability, new_probability,
    base_probability - new_probability AS delta,
    round_even(new_probability * 100 * 10, 0) / 10 AS attrition_probability_pct,
    round_even((base_probability - new_probability) * 100 * 10, 0) / 10 AS reduction_pp
  FROM rescored WHERE abs(base_probability - new_probability) > 0.005
)"""


register("d7_scenario_impact", with_ctes(SUBSCRIBERS + ", " + _scenario_sql(), """
SELECT customerID, action, round(base_probability, 6) AS base_probability, round(new_probability, 6) AS new_probability,
  round(delta, 6) AS delta, attrition_probability_pct, reduction_pp FROM impact"""))
register("d8_best_action", with_ctes(SUBSCRIBERS + ", " + _scenario_sql(), """
SELECT customerID, action, round(new_probability, 6) AS new_probability, attrition_probability_pct, reduction_pp
FROM (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY delta DESC, action_rank ASC) AS rn FROM impact) r
WHERE rn = 1"""))
register("d10_impact_text", with_ctes(SUBSCRIBERS + ", " + _scenario_sql(), """
SELECT customerID, action,
  printf('%s  (%.1f%% → %.1f%%)', action, round_even(base_probability * 100 * 10, 0) / 10, attrition_probability_pct) AS label,
  printf('−%.1f pp', reduction_pp) AS text
FROM impact"""))

# ---------------------------------------------------------------------------
# R1, A5
# ---------------------------------------------------------------------------
register("r1_stream_scoring", with_ctes(SCORED, """
SELECT customerID, round(probability, 6) AS probability, prediction, risk_tier, attrition_probability, clv_at_risk
FROM valued WHERE c_custkey IN (SELECT user_id FROM events)"""))
register("a5_batch_report", with_ctes(SCORED, """
SELECT customerID, round(probability, 6) AS probability, prediction, attrition_probability, risk_tier,
  months_remaining, clv_at_risk FROM valued"""))

# ---------------------------------------------------------------------------
# M4, M6, null-keeping plan, F17 train variant, S2, S4
# ---------------------------------------------------------------------------
register("m4_sigmoid", with_ctes(SCORED, "SELECT customerID, round(probability, 6) AS p FROM scored"))
register("m6_append_predictions", with_ctes(SCORED, f"""
SELECT {INPUTS}, Departed, round(probability, 6) AS probability, prediction, attrition_probability, risk_tier FROM scored"""))
register("f17_total_count_train", with_ctes(SUBSCRIBERS, "SELECT customerID, CAST(" + " + ".join(
    f"coalesce({signed_sql(c)}, 0)" for c in presets.SIGNED_COUNT_TRAIN) + " AS BIGINT) AS total_count FROM subscribers"))
register("s2_csv_sink_scored", with_ctes(SCORED, """
SELECT customerID, Contract, tenure, MonthlyCharges, round(probability, 6) AS probability, attrition_probability,
  risk_tier, clv_at_risk FROM valued"""))


def _feature_plan_keep_nulls_sql() -> str:
    joins, cols = [], []
    for i, c in enumerate(presets.INPUT_COLUMNS):
        if c in SUB_CAT:
            joins.append(f"LEFT JOIN dict d{i} ON d{i}.col = '{c}' AND d{i}.value = r.{c}")
            cols.append(f"CASE WHEN r.{c} IS NULL THEN NULL ELSE coalesce(d{i}.code, 0) END AS {c}")
        elif c in ("MonthlyCharges", "TotalCharges"):
            cols.append(f"round(r.{c}, 6) AS {c}")
        else:
            cols.append(f"r.{c}")
    body = f"""
SELECT {", ".join(cols)}, Departed FROM subscribers r
{chr(10).join(joins)}"""
    return with_ctes(SUBSCRIBERS + f", dict AS ({dict_sql('subscribers', SUB_CAT)})", body)


register("e11_feature_plan_keep_nulls", _feature_plan_keep_nulls_sql())
register("s4_metrics_json", with_ctes(LABELS + """, cc AS (
  SELECT count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp FROM lab
), per AS (
  SELECT *,
    CASE WHEN tn + fn = 0 THEN 0.0E0 ELSE tn / CAST(tn + fn AS DOUBLE) END AS p0,
    CASE WHEN tn + fp = 0 THEN 0.0E0 ELSE tn / CAST(tn + fp AS DOUBLE) END AS r0,
    CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0E0 ELSE 2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) END AS f0,
    CASE WHEN tp + fp = 0 THEN 0.0E0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS p1,
    CASE WHEN tp + fn = 0 THEN 0.0E0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS r1,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0E0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1,
    tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n
  FROM cc
)""", """
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(s0 AS BIGINT) AS support FROM per
UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n = 0 THEN 0.0E0 ELSE (tp + tn) / CAST(n AS DOUBLE) END, CAST(n AS BIGINT) FROM per
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, CAST(n AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, CAST(n AS BIGINT) FROM per"""))

# ---------------------------------------------------------------------------
# Round trips through CSV and JSON text are exact (shortest round-trip doubles)
# ---------------------------------------------------------------------------
register("s1_csv_roundtrip", with_ctes(SUBSCRIBERS, f"SELECT {INPUTS}, Departed FROM subscribers"))
register("s7_parse_records", with_ctes(SUBSCRIBERS, f"""
SELECT {INPUTS.replace("tenure", "CAST(tenure AS DOUBLE) AS tenure")} FROM subscribers WHERE c_custkey IN (SELECT user_id FROM events)"""))

register("v6_roc_curve_lineitem", with_ctes(
    "li AS (SELECT CAST(l_returnflag = 'R' AS INT) AS y, l_extendedprice AS score FROM lineitem), " + cum_sql("li")
    + ", tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc)", """
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0E0 AS fpr, 0.0E0 AS tpr
UNION ALL
SELECT round(score, 6), round(fp / CAST(N AS DOUBLE), 6), round(tp / CAST(P AS DOUBLE), 6) FROM cum, tot
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"""))

# ---------------------------------------------------------------------------
# Split gains and a one-round ensemble in SQL; a saved version predicts the same
# ---------------------------------------------------------------------------
GAINS = SUBSCRIBERS + """, numbered AS (
  SELECT customerID, CASE WHEN Departed = 'Yes' THEN 1 ELSE 0 END AS label, CAST(tenure AS DOUBLE) AS tenure, MonthlyCharges, TotalCharges,
    CAST(SeniorCitizen AS DOUBLE) AS SeniorCitizen FROM subscribers
), mean AS (SELECT CAST(sum(label) AS DOUBLE) / count(*) AS p, ln(CAST(sum(label) AS DOUBLE) / sum(1 - label)) AS base FROM numbered
), graded AS (
  SELECT n.*, round((p - label) * 16777216) / 16777216 AS g, round(p * (1 - p) * 16777216) / 16777216 AS h FROM numbered n, mean
), long AS (
  SELECT 1 AS f, 'tenure' AS feature, tenure AS x, g, h FROM graded UNION ALL SELECT 2, 'MonthlyCharges', MonthlyCharges, g, h FROM graded
  UNION ALL SELECT 3, 'TotalCharges', TotalCharges, g, h FROM graded UNION ALL SELECT 4, 'SeniorCitizen', SeniorCitizen, g, h FROM graded
), cuts AS (
  SELECT 1 AS f, CAST(unnest(range(3, 73, 3)) AS DOUBLE) AS threshold UNION ALL SELECT 2, CAST(unnest(range(20, 121, 5)) AS DOUBLE)
  UNION ALL SELECT 3, CAST(unnest(range(250, 8001, 250)) AS DOUBLE) UNION ALL SELECT 4, CAST(1 AS DOUBLE)
  UNION ALL SELECT unnest([1, 2, 3, 4]), CAST('inf' AS DOUBLE)
), sums AS (
  SELECT f, feature, threshold, sum(g) AS g, sum(h) AS h, count(*) AS n, coalesce(sum(g) FILTER (WHERE x < threshold), 0) AS gl,
    coalesce(sum(h) FILTER (WHERE x < threshold), 0) AS hl, count(*) FILTER (WHERE x < threshold) AS nl,
    coalesce(sum(g) FILTER (WHERE x IS NULL), 0) AS gm, coalesce(sum(h) FILTER (WHERE x IS NULL), 0) AS hm, count(*) FILTER (WHERE x IS NULL) AS nm
  FROM long JOIN cuts USING (f) GROUP BY f, feature, threshold
), sided AS (
  SELECT f, feature, threshold, false AS nulls_left, g, h, n, gl, hl, nl FROM sums
  UNION ALL SELECT f, feature, threshold, true, g, h, n, gl + gm, hl + hm, nl + nm FROM sums WHERE threshold < CAST('inf' AS DOUBLE)
), gains AS (
  SELECT *, pow(greatest(abs(gl) - 0.5, 0), 2) / (hl + 1.5) + pow(greatest(abs(g - gl) - 0.5, 0), 2) / (h - hl + 1.5)
    - pow(greatest(abs(g) - 0.5, 0), 2) / (h + 1.5) AS gain
  FROM sided WHERE hl >= 2 AND h - hl >= 2 AND nl >= 1 AND n - nl >= 1
)"""
register("t7_split_gains", with_ctes(GAINS, """
SELECT feature, CASE WHEN threshold < CAST('inf' AS DOUBLE) THEN threshold END AS threshold, nulls_left, round(gain, 4) AS gain,
  CAST(nl AS BIGINT) AS n_left, CAST(n - nl AS BIGINT) AS n_right FROM gains"""))
register("m1_one_round_predict", with_ctes(GAINS + """, best AS (
  SELECT * FROM gains ORDER BY gain DESC, f, threshold, nulls_left LIMIT 1
), leaves AS (
  SELECT feature, threshold, nulls_left, -0.3 * sign(gl) * greatest(abs(gl) - 0.5, 0) / (hl + 1.5) AS yes,
    -0.3 * sign(g - gl) * greatest(abs(g - gl) - 0.5, 0) / (h - hl + 1.5) AS no FROM best
), tested AS (
  SELECT customerID, base, yes, no, nulls_left, threshold, CASE feature WHEN 'tenure' THEN tenure WHEN 'MonthlyCharges' THEN MonthlyCharges
    WHEN 'TotalCharges' THEN TotalCharges ELSE SeniorCitizen END AS x FROM numbered, mean, leaves
), scored AS (
  SELECT customerID, 1 / (1 + exp(-(base + CASE WHEN coalesce(x < threshold, nulls_left) THEN yes ELSE no END))) AS p FROM tested
)""", "SELECT customerID, round(p, 6) AS probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored"))
register("s5_state_equal", "SELECT count(*) AS customers, CAST(0 AS BIGINT) AS differing FROM customer")

register("a5_report_sections", with_ctes(SCORED + """, k AS (
  SELECT count(*) AS customers, count(*) FILTER (WHERE probability >= 0.5) AS predicted, count(*) FILTER (WHERE risk_tier IN ('HIGH', 'CRITICAL')) AS high,
    CAST(sum(CAST(clv_at_risk AS DECIMAL(38, 2))) AS DOUBLE) AS clv FROM valued
), names AS (SELECT * FROM (VALUES (0, 'predicted_attrition'), (1, 'predicted_attrition_pct'), (2, 'high_critical'), (3, 'clv_at_risk_total')) t(position, item)
), tiers AS (SELECT * FROM (VALUES (0, 'LOW'), (1, 'MEDIUM'), (2, 'HIGH'), (3, 'CRITICAL')) t(position, risk_tier)
), b AS (
  SELECT least(29, greatest(0, CAST(floor(attrition_probability / (100.0E0 / 30)) AS INT))) AS bin FROM scored WHERE attrition_probability IS NOT NULL
), top AS (SELECT customerID, attrition_probability AS p FROM valued ORDER BY p DESC, customerID LIMIT 10
)""", """
SELECT 'kpi' AS section, position, item, customers, round(CASE position WHEN 0 THEN CAST(predicted AS DOUBLE) WHEN 1 THEN CAST(predicted AS DOUBLE) * 100 / customers
  WHEN 2 THEN CAST(high AS DOUBLE) ELSE clv END, 6) AS value FROM k, names
UNION ALL SELECT 'tier', position, risk_tier, count(v.customerID), round(coalesce(CAST(sum(CAST(v.clv_at_risk AS DECIMAL(38, 2))) AS DOUBLE), 0), 6)
  FROM tiers LEFT JOIN valued v USING (risk_tier) GROUP BY position, risk_tier
UNION ALL SELECT 'histogram', bin, '', count(*), round(bin * (100.0E0 / 30), 6) FROM b GROUP BY bin
UNION ALL SELECT 'top', CAST(row_number() OVER (ORDER BY p DESC, customerID) - 1 AS INT), customerID, 0, round(p, 6) FROM top"""))
register("s3_fit_log_counts", "SELECT * FROM (VALUES (1, 2, 5, CAST(2 AS BIGINT), CAST(2 AS BIGINT)), (2, 2, 5, 2, 2)) t(candidate, total, folds, lines, scored)")
register("r1_stream_newest_model", "SELECT count(*) AS scored, CAST(0 AS BIGINT) AS differing FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
