"""Fixed values of the telecom subscriber preset.

FIXED VALUES — these must equal the values the reference uses so results agree
(column names, category domains, bin edges, tier cut points, rule texts,
scenario overrides, the worked-example ensemble). They are stated plainly, in
their natural order, and are data for the generic operators, not logic.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: subscriber record
# ---------------------------------------------------------------------------
TARGET = "Departed"
ID_COLUMNS = ["customerID"]

INPUT_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges",
]

CATEGORY_DOMAINS = {
    "gender": ["Male", "Female"],
    "Partner": ["Yes", "No"],
    "Dependents": ["Yes", "No"],
    "PhoneService": ["Yes", "No"],
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ["Yes", "No", "No internet service"],
    "OnlineBackup": ["Yes", "No", "No internet service"],
    "DeviceProtection": ["Yes", "No", "No internet service"],
    "TechSupport": ["Yes", "No", "No internet service"],
    "StreamingTV": ["Yes", "No", "No internet service"],
    "StreamingMovies": ["Yes", "No", "No internet service"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": ["Yes", "No"],
    "PaymentMethod": [
        "Electronic check", "Mailed check",
        "Bank transfer (automatic)", "Credit card (automatic)",
    ],
}

DEFAULT_ROW = {
    "gender": "Male", "SeniorCitizen": 0, "Partner": "No",
    "Dependents": "No", "tenure": 12, "PhoneService": "Yes",
    "MultipleLines": "No", "InternetService": "Fiber optic",
    "OnlineSecurity": "No", "OnlineBackup": "No",
    "DeviceProtection": "No", "TechSupport": "No",
    "StreamingTV": "No", "StreamingMovies": "No",
    "Contract": "Month-to-month", "PaperlessBilling": "Yes",
    "PaymentMethod": "Electronic check",
    "MonthlyCharges": 70.0, "TotalCharges": 840.0,
}

# ---------------------------------------------------------------------------
# FIXED VALUES: feature engineering
# ---------------------------------------------------------------------------
TENURE_EDGES = [0, 12, 24, 36, 48, 60, 72]          # right-closed bins -> 0..5
CHARGE_EDGES = [0, 30, 60, 90, 120]                  # right-closed bins -> 0..3
TENURE_MAX = 72.0
BIN_OUTSIDE = -1

SERVICE_COLUMNS = [
    "PhoneService", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
]
INACTIVE_SERVICE_VALUES = ["No", "No internet service"]
INTERNET_VALUES = ["DSL", "Fiber optic"]
AUTOMATIC_MARKER = "automatic"

# attrition_risk_score parts: (column, value)
RISK_SCORE_PARTS = [
    ("Contract", "Month-to-month"),
    ("PaymentMethod", "Electronic check"),
    ("InternetService", "Fiber optic"),
]

# Order of engineered features after the inputs (trained feature order)
ENGINEERED_FEATURES = [
    "tenure_group", "tenure_to_max", "tenure_monthly_ratio", "charge_group",
    "total_services", "has_internet", "has_phone", "is_month_to_month",
    "is_automatic_payment", "is_senior", "has_dependents", "attrition_risk_score",
]

# Signed (+1/-1/0) encoding variant
SIGNED_MAPS = {
    "gender": {"Male": 1, "Female": -1},
    "SeniorCitizen": {0: -1, 1: 1},
    "Partner": {"No": -1, "Yes": 1},
    "Dependents": {"No": -1, "Yes": 1},
    "PaperlessBilling": {"No": 1, "Yes": -1},
    "MultipleLines": {"No": -1, "Yes": 1, "No phone service": 0},
    "OnlineBackup": {"No": -1, "Yes": 1, "No internet service": 0},
    "DeviceProtection": {"No": -1, "Yes": 1, "No internet service": 0},
    "StreamingTV": {"No": -1, "Yes": 1, "No internet service": 0},
    "StreamingMovies": {"No": -1, "Yes": 1, "No internet service": 0},
}
SIGNED_COUNT_TRAIN = ["gender", "SeniorCitizen", "Partner", "Dependents", "PaperlessBilling"]
SIGNED_COUNT_EVAL = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "PaperlessBilling",
    "MultipleLines", "OnlineBackup", "DeviceProtection", "StreamingTV", "StreamingMovies",
]

# Column order used by the reorder operator (listed first when present)
IMPORTANCE_ORDER = [
    "Contract", "OnlineSecurity", "TechSupport", "InternetService", "tenure",
    "MonthlyCharges", "TotalCharges", "PaperlessBilling", "StreamingTV",
    "OnlineBackup", "MultipleLines", "PaymentMethod", "PhoneService",
    "StreamingMovies", "Dependents", "SeniorCitizen", "customerID", "Partner",
    "gender", "DeviceProtection",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: decisions
# ---------------------------------------------------------------------------
# Risk tiers: left-closed upper cut points, last tier open-ended
TIER_CUTS = [(0.30, "LOW"), (0.50, "MEDIUM"), (0.70, "HIGH")]
TIER_TOP = "CRITICAL"
TIER_ORDER = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
TIER_LABELS = {
    "LOW": "Low Risk", "MEDIUM": "Medium Risk",
    "HIGH": "High Risk", "CRITICAL": "Critical Risk",
}
DECISION_THRESHOLD = 0.5
OUTREACH_THRESHOLD = 0.70

# Expected remaining months by contract: (contract, cycle, floor); else FLAT
CONTRACT_MONTHS = [("Two year", 24, 6), ("One year", 12, 3)]
MONTHS_FLAT = 6

# Risk driver labels and the values that stand for a state
DRIVER_LABELS = {
    "contract": "Contract Type", "tenure": "Tenure", "payment": "Payment Method", "internet": "Internet Service",
    "tech": "Tech Support", "security": "Online Security", "charges": "High Charges / Short Tenure",
}
DRIVER_VALUES = {"missing": "Not subscribed", "present": "Active", "no internet": "None"}

# Risk driver notes: (label, level) -> note
DRIVER_NOTES = {
    ("Contract Type", "HIGH"): "No lock-in — easiest to leave",
    ("Contract Type", "MEDIUM"): "Annual commitment moderates risk",
    ("Contract Type", "SAFE"): "2-year commitment — strong retention signal",
    ("Tenure", "HIGH"): "Very new customer — highest attrition window",
    ("Tenure", "MEDIUM"): "Still within the early attrition zone",
    ("Tenure", "SAFE"): "Established customer — lower base risk",
    ("Payment Method", "HIGH"): "Electronic check shows 2× higher attrition vs auto-pay",
    ("Payment Method", "SAFE"): "Automatic payment correlates with retention",
    ("Payment Method", "MEDIUM"): "Manual payment — some friction with service",
    ("Internet Service", "FIBER"): "High-value service — unhappy fiber users leave fast",
    ("Internet Service", "NONE"): "Low engagement — at risk from competitor bundles",
    ("Internet Service", "SAFE"): "DSL — stable middle-tier service",
    ("Tech Support", "MEDIUM"): "Unresolved technical issues are a top attrition trigger",
    ("Tech Support", "SAFE"): "Supported customers retain better",
    ("Online Security", "LOW"): "Missing bundle — vulnerable to competitor offers",
    ("Online Security", "SAFE"): "Security bundle increases switching cost",
    ("High Charges / Short Tenure", "HIGH"): "Paying premium without feeling loyalty yet",
}
HIGH_CHARGE = 80
SHORT_TENURE = 12
TENURE_NEW = 6
TENURE_EARLY = 18

# Retention playbook actions: (key, title, detail, priority)
PLAYBOOK = [
    ("outreach", "Proactive Outreach — within 48 h",
     "Assign a dedicated retention agent. High-risk customers respond best to personal contact.",
     "CRITICAL"),
    ("annual", "Offer Annual Contract Discount",
     "A 15–20 % discount on a 1-year plan eliminates the month-to-month escape hatch.",
     "HIGH"),
    ("autopay", "Enrol in Auto-Pay",
     "Offer a $5/month credit for switching to automatic bank transfer or credit card.",
     "HIGH"),
    ("techsupport", "Bundle Tech Support (3 months free)",
     "Removes friction from service issues — the #1 stated reason for cancellation.",
     "MEDIUM"),
    ("security", "Add Online Security Package",
     "Increases perceived value and switching cost. Offer at $2/month off for 6 months.",
     "MEDIUM"),
    ("loyalty", "Loyalty Reward — Early Milestone",
     "Send a 1-year anniversary offer 30 days early. Early tenure intervention has 3× ROI.",
     "MEDIUM"),
    ("monitor", "Monitor & Maintain",
     "Low risk — include in standard quarterly health check NPS survey.",
     "LOW"),
]

# What-if scenarios: action, overrides (None = keep), charge factor (None = keep)
SCENARIOS = [
    ("Upgrade to 2-year contract", {"Contract": "Two year"}, None),
    ("Upgrade to 1-year contract", {"Contract": "One year"}, None),
    ("Switch to auto bank transfer", {"PaymentMethod": "Bank transfer (automatic)"}, None),
    ("Switch to credit card (auto)", {"PaymentMethod": "Credit card (automatic)"}, None),
    ("Add Tech Support", {"TechSupport": "Yes"}, None),
    ("Add Online Security", {"OnlineSecurity": "Yes"}, None),
    ("Add Online Backup", {"OnlineBackup": "Yes"}, None),
    ("Reduce monthly charges by 10 %", {}, 0.9),
]
SCENARIO_COLUMNS = ["Contract", "PaymentMethod", "TechSupport", "OnlineSecurity", "OnlineBackup"]
SCENARIO_MIN_CHARGE = 1.0
SCENARIO_MIN_DELTA = 0.005

# ---------------------------------------------------------------------------
# FIXED VALUES: worked-example ensemble (3 trees)
# rows: tree, node, feature, op, threshold, yes, no, leaf
# ---------------------------------------------------------------------------
WORKED_EXAMPLE_TREES = [
    (1, 0, "MonthlyCharges", ">", "30", 1, 2, None),
    (1, 1, None, None, None, None, None, 0.8),
    (1, 2, None, None, None, None, None, -0.2),
    (2, 0, "PaperlessBilling", "=", "Yes", 1, 2, None),
    (2, 1, "tenure", "<", "6", 3, 4, None),
    (2, 2, None, None, None, None, None, 0.1),
    (2, 3, None, None, None, None, None, 0.6),
    (2, 4, None, None, None, None, None, -0.3),
    (3, 0, "PaymentMethod", "=", "Electronic check", 1, 2, None),
    (3, 1, None, None, None, None, None, 0.5),
    (3, 2, None, None, None, None, None, -0.1),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: training defaults
# ---------------------------------------------------------------------------
SPLIT_FRACTIONS = {"train": 0.60, "val": 0.20, "test": 0.20}
SPLIT_FRACTIONS_ALT = {"train": 0.64, "val": 0.16, "test": 0.20}
SEED = 42
CV_FOLDS = 5
SEARCH_SPACE = {
    "n_estimators": [500, 750, 1000, 1500],
    "max_depth": [5, 6, 8, 10],
    "learning_rate": [0.01, 0.05, 0.1],
    "subsample": [0.70, 0.80, 0.85, 0.90],
    "colsample_bytree": [0.70, 0.80, 0.85, 0.90],
    "min_child_weight": [1, 2, 3, 5],
    "gamma": [0.0, 0.05, 0.1, 0.2],
    "reg_alpha": [0.0, 0.1, 0.5, 1.0],
    "reg_lambda": [1.0, 1.5, 2.0, 3.0],
    "max_leaves": [32, 64],
    "scale_pos_weight": [1.0, None],      # None: negatives per positive of the train rows
}
# every fit starts from these; a candidate's own values replace them
BASE_PARAMS = {
    "n_estimators": 1000, "max_depth": 8, "learning_rate": 0.05, "min_child_weight": 2,
    "subsample": 0.85, "colsample_bytree": 0.85, "gamma": 0.1, "reg_alpha": 0.1, "reg_lambda": 1.5,
    "grow_policy": "lossguide", "max_leaves": 64,
}
FALLBACK_PARAMS = {
    "n_estimators": 1000, "max_depth": 8, "learning_rate": 0.05,
    "subsample": 0.85, "colsample_bytree": 0.85, "min_child_weight": 2, "gamma": 0.1,
}
SEARCH_CANDIDATES = 30
# the leaf-wise booster variant (64/16/20 split, 20 candidates x 5 folds)
SEARCH_SPACE_LEAFWISE = {
    "num_leaves": [15, 31, 63, 127],
    "max_depth": [3, 5, 7, 10, -1],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "n_estimators": [200, 400, 600, 1000],
    "min_child_samples": [10, 20, 30, 50],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
    "scale_pos_weight": [1.0, None],
}
SEARCH_CANDIDATES_LEAFWISE = 20
BASE_PARAMS_LEAFWISE = {"n_estimators": 400, "max_depth": -1, "num_leaves": 31, "learning_rate": 0.1, "reg_lambda": 0.0, "min_child_weight": 1e-3}
FALLBACK_PARAMS_LEAFWISE = {
    "n_estimators": 400, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
    "colsample_bytree": 0.8, "min_child_samples": 20, "num_leaves": 31,
}
EARLY_STOPPING_ROUNDS = 50
MAX_BINS = 256
