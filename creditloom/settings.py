"""Seeds, limits, bin edges and labels, column lists."""

INF = float("inf")

# Fixed values that results depend on.
SEED = 42
HOLDOUT_SHARE = 0.20
CV_FOLDS = 5
CV_SAMPLE_ROWS = 50_000
MISSING_LIMIT_PCT = 80
BETA = 2.5
DAYS_SENTINEL = 365243
DAYS_PER_YEAR = 365
TOP_CORRELATIONS = 20
TOP_IMPORTANCES = 30
HISTOGRAM_BINS = 40
QUIRK_LIMIT = 5000

# Bin edges, labels and the side on which a bin is closed.
AGE_EDGES = [0, 30, 40, 50, 60, INF]
AGE_LABELS = ["18-29", "30-39", "40-49", "50-59", "60+"]
EMPLOYMENT_EDGES = [-0.001, 0.1, 0.3, 0.6, INF]
EMPLOYMENT_LABELS = ["Unstable", "Short-term", "Moderate", "Stable"]
INCOME_EDGES = [0, 100_000, 200_000, INF]
INCOME_LABELS = ["Low", "Medium", "High"]
LOAN_EDGES = [0, 100_000, 500_000, INF]
LOAN_LABELS = ["Small", "Medium", "Large"]
RISK_EDGES = [-0.001, 0.3, 0.6, INF]
RISK_LABELS = ["High Risk", "Medium Risk", "Low Risk"]

# Thresholds of the decision sweep, 0.05 to 0.90.
SWEEP = [0.05 + i * 0.05 for i in range(18)]

CUSTOMER = "SK_ID_CURR"
CREDIT = "SK_ID_BUREAU"
LOAN = "SK_ID_PREV"
LABEL = "TARGET"
SET = "SET"

# Segment columns, columns that are no features, columns that are capped, features of the histograms.
SEGMENTS = ["income_group", "loan_size", "age_group", "risk_level", "employment_group"]
NOT_FEATURES = [CUSTOMER, CREDIT, LOAN, SET, *SEGMENTS]
CAPPED = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]
BEHAVIOURAL = [
    "inst_late_rate",
    "cc_utilisation",
    "prev_approval_rate",
    "bur_max_overdue",
    "pos_sk_dpd_mean",
    "inst_days_late_mean",
]

# The published table, in its published column order.
SLIM_COLUMNS = [
    "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_GOODS_PRICE", "DAYS_BIRTH", "DAYS_EMPLOYED",
    "income_credit_ratio", "employment_age_ratio", "annuity_income_ratio",
    "bur_total_debt", "bur_num_credits", "bur_max_overdue",
    "prev_num_applications", "prev_approval_rate",
    "inst_late_rate", "inst_days_late_mean",
    "cc_utilisation", "cc_dpd_max", "pos_sk_dpd_max", "pos_completion_rate",
    "TARGET",
]

# Published row counts of the full inputs.
EXPECTED_ROWS = {
    "application_train": 307_511,
    "bureau": 1_716_428,
    "bureau_balance": 27_299_925,
    "previous_application": 1_670_214,
    "POS_CASH_balance": 10_001_358,
    "credit_card_balance": 3_840_312,
    "installments_payments": 13_605_401,
}
