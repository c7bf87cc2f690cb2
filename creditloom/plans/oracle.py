"""The same queries in plain SQL, written from the definitions, for checking results in DuckDB."""

from creditloom import settings as S
from creditloom.sources.roles import VIEWS, view_sql

_DAYS = "date_diff('day', DATE '2001-12-31', CAST({0} AS DATE))"

# Named blocks; {placeholders} in a query pull in the blocks it needs, in this order.
BLOCKS = {name: view_sql(name, _DAYS) for name in VIEWS}
BLOCKS.update({
    "train_set": "SELECT * FROM application_train",
    "test_set": "SELECT * EXCLUDE (TARGET) FROM application_test",
    "apps": """
        SELECT *, CAST('train' AS VARCHAR) AS "SET" FROM
          (SELECT * REPLACE (CAST(TARGET AS DOUBLE) AS TARGET) FROM train_set)
        UNION ALL BY NAME
        SELECT *, CAST('test' AS VARCHAR) AS "SET" FROM test_set""",
    "balance": """
        SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS bb_months_total,
          CAST(sum(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS BIGINT) AS bb_months_bad,
          CAST(max(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS INT) AS bb_max_dpd_band
        FROM bureau_balance WHERE SK_ID_BUREAU IS NOT NULL GROUP BY SK_ID_BUREAU""",
    "credits": "SELECT bureau.*, balance.* EXCLUDE (SK_ID_BUREAU) FROM bureau LEFT JOIN balance USING (SK_ID_BUREAU)",
    "agg_bureau": """
        SELECT *, bur_total_debt / nullif(bur_total_credit, 0) AS bur_debt_credit_ratio,
          bur_total_overdue / nullif(bur_total_credit, 0) AS bur_overdue_credit_ratio,
          CAST(bur_num_active AS DOUBLE) / nullif(bur_num_credits, 0) AS bur_active_ratio
        FROM (SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS bur_num_credits,
            CAST(count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active') AS BIGINT) AS bur_num_active,
            CAST(count(*) FILTER (WHERE CREDIT_ACTIVE = 'Closed') AS BIGINT) AS bur_num_closed,
            coalesce(sum(AMT_CREDIT_SUM), 0) AS bur_total_credit,
            avg(AMT_CREDIT_SUM) AS bur_avg_credit,
            coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS bur_total_debt,
            max(AMT_CREDIT_SUM_OVERDUE) AS bur_max_overdue,
            avg(AMT_CREDIT_SUM_OVERDUE) AS bur_avg_overdue,
            coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS bur_total_overdue,
            avg(DAYS_CREDIT) AS bur_days_credit_mean, min(DAYS_CREDIT) AS bur_days_credit_min,
            avg(DAYS_CREDIT_ENDDATE) AS bur_days_enddate_mean,
            max(DAYS_CREDIT_ENDDATE) AS bur_days_enddate_max,
            CAST(coalesce(sum(CNT_CREDIT_PROLONG), 0) AS BIGINT) AS bur_prolong_sum,
            CAST(coalesce(sum(bb_months_bad), 0) AS BIGINT) AS bur_num_bad_months,
            avg(bb_months_bad) AS bur_avg_bad_months
          FROM credits WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)""",
    "agg_previous": """
        SELECT *, CAST(prev_num_approved AS DOUBLE) / nullif(prev_num_applications, 0) AS prev_approval_rate,
          CAST(prev_num_refused AS DOUBLE) / nullif(prev_num_applications, 0) AS prev_refusal_rate
        FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS prev_num_applications,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS prev_num_approved,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') AS prev_num_refused,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Canceled') AS prev_num_cancelled,
            coalesce(sum(AMT_CREDIT), 0) AS prev_amt_credit_sum, avg(AMT_CREDIT) AS prev_amt_credit_mean,
            avg(AMT_ANNUITY) AS prev_amt_annuity_mean, avg(AMT_DOWN_PAYMENT) AS prev_amt_down_mean,
            avg(DAYS_DECISION) AS prev_days_decision_mean, min(DAYS_DECISION) AS prev_days_decision_min,
            avg(HOUR_APPR_PROCESS_START) AS prev_hour_appr_mean,
            avg(RATE_DOWN_PAYMENT) AS prev_rate_down_mean,
            avg(nullif(DAYS_FIRST_DUE, 365243)) AS prev_days_first_due_mean,
            avg(nullif(DAYS_LAST_DUE, 365243)) AS prev_days_last_due_mean,
            avg(nullif(DAYS_TERMINATION, 365243)) AS prev_days_termination_mean,
            avg(CNT_PAYMENT) AS prev_cnt_payment_mean
          FROM previous_application WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)""",
    "agg_pos": """
        SELECT *, CAST(CASE WHEN pos_sk_dpd_max > 0 THEN 1 ELSE 0 END AS INT) AS pos_dpd_flag,
          CAST(pos_num_completed AS DOUBLE) / nullif(pos_num_records, 0) AS pos_completion_rate
        FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS pos_num_records,
            avg(MONTHS_BALANCE) AS pos_months_balance_mean, max(MONTHS_BALANCE) AS pos_months_balance_max,
            avg(CNT_INSTALMENT) AS pos_cnt_instalment_mean,
            avg(CNT_INSTALMENT_FUTURE) AS pos_cnt_instalment_future,
            avg(SK_DPD) AS pos_sk_dpd_mean, max(SK_DPD) AS pos_sk_dpd_max,
            avg(SK_DPD_DEF) AS pos_sk_dpd_def_mean, max(SK_DPD_DEF) AS pos_sk_dpd_def_max,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Completed') AS pos_num_completed,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Active') AS pos_num_active
          FROM pos_cash WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)""",
    "agg_card": """
        SELECT *, CAST(CASE WHEN cc_dpd_max > 0 THEN 1 ELSE 0 END AS INT) AS cc_dpd_flag,
          CAST(CASE WHEN cc_utilisation > 1 THEN 1 ELSE 0 END AS INT) AS cc_over_limit
        FROM (SELECT *, cc_balance_mean / nullif(cc_credit_limit_mean, 0) AS cc_utilisation
          FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS cc_num_records,
              avg(MONTHS_BALANCE) AS cc_months_balance_mean,
              avg(AMT_BALANCE) AS cc_balance_mean, max(AMT_BALANCE) AS cc_balance_max,
              avg(AMT_CREDIT_LIMIT_ACTUAL) AS cc_credit_limit_mean,
              avg(AMT_DRAWINGS_CURRENT) AS cc_drawings_mean,
              coalesce(sum(AMT_DRAWINGS_CURRENT), 0) AS cc_drawings_total,
              avg(AMT_PAYMENT_CURRENT) AS cc_payment_current_mean,
              avg(AMT_TOTAL_RECEIVABLE) AS cc_payment_total_mean,
              avg(SK_DPD) AS cc_dpd_mean, max(SK_DPD) AS cc_dpd_max, avg(SK_DPD_DEF) AS cc_dpd_def_mean,
              avg(CNT_DRAWINGS_CURRENT) AS cc_cnt_drawings_mean
            FROM credit_card WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR))""",
    "payments": """
        SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS DAYS_LATE,
          AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_RATIO,
          AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF
        FROM installments_payments""",
    "agg_installments": """
        SELECT *, CAST(inst_num_late AS DOUBLE) / nullif(inst_num_records, 0) AS inst_late_rate
        FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS inst_num_records,
            avg(DAYS_LATE) AS inst_days_late_mean, max(DAYS_LATE) AS inst_days_late_max,
            coalesce(sum(DAYS_LATE), 0) AS inst_days_late_sum,
            avg(PAYMENT_RATIO) AS inst_payment_ratio_mean, min(PAYMENT_RATIO) AS inst_payment_ratio_min,
            avg(PAYMENT_DIFF) AS inst_payment_diff_mean, max(PAYMENT_DIFF) AS inst_payment_diff_max,
            count(*) FILTER (WHERE DAYS_LATE > 0) AS inst_num_late,
            count(*) FILTER (WHERE DAYS_LATE < 0) AS inst_num_early,
            coalesce(sum(AMT_PAYMENT), 0) AS inst_amt_payment_sum,
            coalesce(sum(AMT_INSTALMENT), 0) AS inst_amt_instalment_sum
          FROM payments WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)""",
    "customer_view": """
        SELECT * FROM apps LEFT JOIN agg_bureau USING (SK_ID_CURR) LEFT JOIN agg_previous USING (SK_ID_CURR)
          LEFT JOIN agg_pos USING (SK_ID_CURR) LEFT JOIN agg_card USING (SK_ID_CURR)
          LEFT JOIN agg_installments USING (SK_ID_CURR)""",
})


def _cleaned(source):
    return f"""
        SELECT * REPLACE (abs(DAYS_BIRTH) AS DAYS_BIRTH, abs(nullif(DAYS_EMPLOYED, 365243)) AS DAYS_EMPLOYED),
          CAST(CASE WHEN DAYS_EMPLOYED IS NULL OR DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS INT)
            AS DAYS_EMPLOYED_FLAG
        FROM {source}"""


def _or_zero(a, b, fill="0"):
    return f"CASE WHEN {b} = 0 THEN CAST({fill} AS DOUBLE) ELSE CAST({a} AS DOUBLE) / {b} END"


_APP_RATIOS = f"""
    {_or_zero('AMT_INCOME_TOTAL', 'AMT_CREDIT')} AS income_credit_ratio,
    {_or_zero('AMT_ANNUITY', 'AMT_INCOME_TOTAL')} AS annuity_income_ratio,
    {_or_zero('AMT_CREDIT', 'AMT_GOODS_PRICE')} AS credit_goods_ratio,
    {_or_zero('DAYS_EMPLOYED', 'DAYS_BIRTH')} AS employment_age_ratio,
    CAST(abs(DAYS_BIRTH) AS DOUBLE) / 365 AS age_years,
    CAST(abs(DAYS_EMPLOYED) AS DOUBLE) / 365 AS employed_years,
    {_or_zero('AMT_INCOME_TOTAL', 'coalesce(CNT_FAM_MEMBERS, 1)')} AS income_per_person"""


def _right(x, edges, labels):
    whens = " ".join(
        f"WHEN {x} > {low} AND {x} <= {high} THEN '{label}'" if high else f"WHEN {x} > {low} THEN '{label}'"
        for low, high, label in zip(edges, [*edges[1:], None], labels)
    )
    return f"CASE {whens} END"


def _left(x, edges, labels):
    whens = " ".join(
        f"WHEN {x} >= {low} AND {x} < {high} THEN '{label}'" if high else f"WHEN {x} >= {low} THEN '{label}'"
        for low, high, label in zip(edges, [*edges[1:], None], labels)
    )
    return f"CASE {whens} END"


_AGE = ["18-29", "30-39", "40-49", "50-59", "60+"]
_EMPLOYMENT = ["Unstable", "Short-term", "Moderate", "Stable"]
_INCOME_GROUP = _left("AMT_INCOME_TOTAL", [0, 100000, 200000], ["Low", "Medium", "High"])
_LOAN_SIZE = _left("AMT_CREDIT", [0, 100000, 500000], ["Small", "Medium", "Large"])
_AGE_GROUP = _right("age_years", [0, 30, 40, 50, 60], _AGE)
_RISK = _right("income_credit_ratio", [-0.001, 0.3, 0.6], ["High Risk", "Medium Risk", "Low Risk"])
_EMPLOYMENT_GROUP = _right("employment_age_ratio", [-0.001, 0.1, 0.3, 0.6], _EMPLOYMENT)


def _under(x, bounds, labels):
    """The first label whose bound lies above the value, the last label for all the rest."""
    whens = " ".join(f"WHEN {x} < {bound} THEN '{label}'" for bound, label in zip(bounds, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


_AGE_BAND = _under("CAST(days_birth AS DOUBLE) / 365", [30, 40, 50, 60], _AGE)
_EMPLOYMENT_BAND = _under("coalesce(employment_age_ratio, 0)", [0.1, 0.3, 0.6], _EMPLOYMENT)

BLOCKS["cleaned_apps"] = _cleaned("application")
BLOCKS["app_ratios"] = f"SELECT *, {_APP_RATIOS} FROM cleaned_apps"
BLOCKS["cleaned_view"] = _cleaned("customer_view")
BLOCKS["ratios_view"] = f"""
    SELECT *, {_APP_RATIOS},
      {_or_zero('bur_total_debt', 'AMT_INCOME_TOTAL')} AS bur_debt_income_ratio,
      {_or_zero('inst_num_late', 'prev_num_applications')} AS inst_late_per_credit,
      {_or_zero('cc_utilisation', 'AMT_INCOME_TOTAL')} AS cc_util_income_ratio
    FROM cleaned_view"""
BLOCKS["features"] = f"""
    SELECT *, {_INCOME_GROUP} AS income_group, {_LOAN_SIZE} AS loan_size, {_AGE_GROUP} AS age_group,
      {_RISK} AS risk_level, {_EMPLOYMENT_GROUP} AS employment_group
    FROM ratios_view"""

# Numeric feature columns by origin.
_APP = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS",
        "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_EMPLOYED_FLAG"]
# Feature names in their published order.
_BUREAU = [
    "bur_num_credits", "bur_num_active", "bur_num_closed", "bur_total_credit", "bur_avg_credit",
    "bur_total_debt", "bur_max_overdue", "bur_avg_overdue", "bur_total_overdue", "bur_days_credit_mean",
    "bur_days_credit_min", "bur_days_enddate_mean", "bur_days_enddate_max", "bur_prolong_sum",
    "bur_num_bad_months", "bur_avg_bad_months", "bur_debt_credit_ratio", "bur_overdue_credit_ratio",
    "bur_active_ratio",
]
_PREVIOUS = [
    "prev_num_applications", "prev_num_approved", "prev_num_refused", "prev_num_cancelled",
    "prev_amt_credit_sum", "prev_amt_credit_mean", "prev_amt_annuity_mean", "prev_amt_down_mean",
    "prev_days_decision_mean", "prev_days_decision_min", "prev_hour_appr_mean", "prev_rate_down_mean",
    "prev_days_first_due_mean", "prev_days_last_due_mean", "prev_days_termination_mean",
    "prev_cnt_payment_mean", "prev_approval_rate", "prev_refusal_rate",
]
_POS = [
    "pos_num_records", "pos_months_balance_mean", "pos_months_balance_max", "pos_cnt_instalment_mean",
    "pos_cnt_instalment_future", "pos_sk_dpd_mean", "pos_sk_dpd_max", "pos_sk_dpd_def_mean",
    "pos_sk_dpd_def_max", "pos_num_completed", "pos_num_active", "pos_dpd_flag", "pos_completion_rate",
]
_CARD = [
    "cc_num_records", "cc_months_balance_mean", "cc_balance_mean", "cc_balance_max", "cc_credit_limit_mean",
    "cc_drawings_mean", "cc_drawings_total", "cc_payment_current_mean", "cc_payment_total_mean", "cc_dpd_mean",
    "cc_dpd_max", "cc_dpd_def_mean", "cc_cnt_drawings_mean", "cc_utilisation", "cc_dpd_flag", "cc_over_limit",
]
_INSTALMENTS = [
    "inst_num_records", "inst_days_late_mean", "inst_days_late_max", "inst_days_late_sum",
    "inst_payment_ratio_mean", "inst_payment_ratio_min", "inst_payment_diff_mean", "inst_payment_diff_max",
    "inst_num_late", "inst_num_early", "inst_amt_payment_sum", "inst_amt_instalment_sum", "inst_late_rate",
]
_RATIOS = [
    "income_credit_ratio", "annuity_income_ratio", "credit_goods_ratio", "employment_age_ratio", "age_years",
    "employed_years", "income_per_person", "bur_debt_income_ratio", "inst_late_per_credit",
    "cc_util_income_ratio",
]
NUMERIC = _APP + _BUREAU + _PREVIOUS + _POS + _CARD + _INSTALMENTS + _RATIOS
_SPARSE = set(_POS + _CARD + ["cc_util_income_ratio"])
_CAPPED, _BEHAVIOURAL, _SLIM = S.CAPPED, S.BEHAVIOURAL, S.SLIM_COLUMNS


def _quantile(column, share, source):
    """Linear interpolation between neighbouring ranks, spelled out."""
    return f"""(SELECT l[CAST(floor(h) AS INT) + 1]
        + (l[CAST(ceil(h) AS INT) + 1] - l[CAST(floor(h) AS INT) + 1]) * (h - floor(h))
      FROM (SELECT l, CAST(len(l) - 1 AS DOUBLE) * CAST({share} AS DOUBLE) AS h
        FROM (SELECT list_sort(list(CAST({column} AS DOUBLE))) AS l FROM {source} WHERE {column} IS NOT NULL)))"""


# Whole-number columns without missing values keep their type; imputed ones become doubles.
_NEVER_MISSING = {"DAYS_BIRTH", "DAYS_EMPLOYED_FLAG"}
BLOCKS["filled"] = "SELECT SK_ID_CURR, \"SET\", TARGET, FLAG_YES_NO, NAME_SEGMENT, " + ", ".join(
    c if c in _NEVER_MISSING else f"coalesce(CAST({c} AS DOUBLE), {_quantile(c, 0.5, 'features')}) AS {c}"
    for c in NUMERIC
) + " FROM features"
_FLAG_CODE = """CAST(CASE coalesce(FLAG_YES_NO, 'None') WHEN 'No' THEN 0 WHEN 'None' THEN 1 WHEN 'Yes' THEN 2 END
    AS INT) AS FLAG_YES_NO"""
_SEGMENT_FLAGS = ", ".join(
    f"CAST(CASE WHEN NAME_SEGMENT = '{v}' THEN 1 ELSE 0 END AS INT) AS NAME_SEGMENT_{v}"
    for v in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
)
BLOCKS["text_values"] = """SELECT SK_ID_CURR, 1 AS i, 'NAME_SEGMENT' AS column_name, NAME_SEGMENT AS value FROM apps
    UNION ALL SELECT SK_ID_CURR, 2, 'CREDIT_TEXT', CAST(CAST(floor(AMT_CREDIT) AS BIGINT) AS VARCHAR) FROM apps"""
BLOCKS["text_codes"] = """SELECT i, column_name, value, count(*) AS n,
    row_number() OVER (PARTITION BY i ORDER BY value) - 1 AS code FROM text_values WHERE value IS NOT NULL GROUP BY i, column_name, value"""
BLOCKS["text_categories"] = """SELECT i, column_name, value, n, code, CASE WHEN code > 0 THEN
    count(*) FILTER (code > 0) OVER (ORDER BY i, code) - 1 END AS position FROM text_codes"""
BLOCKS["prepared"] = f"""SELECT SK_ID_CURR, "SET", TARGET, {_FLAG_CODE}, {_SEGMENT_FLAGS}, """ + ", ".join(
    f"least(greatest({c}, {_quantile(c, 0.01, 'filled')}), {_quantile(c, 0.99, 'filled')}) AS {c}"
    if c in _CAPPED else c for c in NUMERIC
) + " FROM filled"
PREPARED_COLUMNS = ["FLAG_YES_NO", *[f"NAME_SEGMENT_{v}" for v in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")]] + NUMERIC
BLOCKS["train_rows"] = "SELECT * FROM prepared WHERE \"SET\" = 'train'"
BLOCKS["slim"] = "SELECT " + ", ".join(f"{c} AS {c.lower()}" for c in _SLIM) + " FROM features WHERE \"SET\" = 'train'"
BLOCKS["published"] = "SELECT " + ", ".join(
    f"CAST({c} AS {'INT' if c == 'DAYS_BIRTH' else 'DOUBLE'}) AS {c.lower()}" for c in _SLIM
) + " FROM train_rows"
BLOCKS["cut_rows"] = f"""
    SELECT TARGET, {_AGE_GROUP} AS age_group, {_EMPLOYMENT_GROUP} AS employment_group, {_INCOME_GROUP} AS income_group
    FROM train_rows"""
BLOCKS["predicted"] = "SELECT *, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INT) AS predicted FROM scored"
BLOCKS["rivals"] = """
    SELECT 'score_a' AS model, label, score, predicted FROM predicted
    UNION ALL
    SELECT 'score_b', label, s, CASE WHEN s >= 0.5 THEN 1 ELSE 0 END
    FROM (SELECT label, CAST(SK_ID_CURR * 91 % 1000 AS DOUBLE) / 1000 AS s FROM scored)"""
BLOCKS["levels"] = """
    SELECT score, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
      CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
      CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
    FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
          FROM scored GROUP BY score)
    WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""
BLOCKS["gain"] = """
    SELECT SK_ID_CURR, score, label, row_number() OVER w AS position, sum(label) OVER w AS caught,
      count(*) OVER () AS n, sum(label) OVER () AS p
    FROM scored WINDOW w AS (ORDER BY score DESC, SK_ID_CURR ROWS UNBOUNDED PRECEDING)"""


def _f(beta):
    b = beta * beta
    return f"""coalesce({1 + b} * CAST(tp AS DOUBLE)
        / nullif({1 + b} * CAST(tp AS DOUBLE) + {b} * CAST(fn AS DOUBLE) + CAST(fp AS DOUBLE), 0), 0)"""


_PRECISION = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)"
_RECALL = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)"
BLOCKS["sweep"] = f"""
    SELECT round_even(t, 2) AS threshold, round_even({_f(2.5)}, 4) AS fbeta,
      round_even({_PRECISION}, 4) AS precision, round_even({_RECALL}, 4) AS recall, round_even({_f(1)}, 4) AS f1
    FROM (SELECT t, count(*) FILTER (WHERE score >= t AND label = 1) AS tp,
            count(*) FILTER (WHERE score >= t AND label = 0) AS fp,
            count(*) FILTER (WHERE score < t AND label = 1) AS fn
          FROM scored, (SELECT CAST(0.05 AS DOUBLE) + i * CAST(0.05 AS DOUBLE) AS t FROM range(18) r(i))
          GROUP BY t)"""
BLOCKS["model_rows"] = f"""
    SELECT model, auc_roc, avg_precision, round_even({_RECALL}, 4) AS recall_default,
      round_even({_PRECISION}, 4) AS precision_default, round_even({_f(1)}, 4) AS f1_default
    FROM (SELECT model, count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp,
            count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp,
            count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn
          FROM rivals GROUP BY model)
    JOIN (SELECT model, round_even(sum(pos * (n - fp + neg / 2)) / (max(p) * max(n)), 4) AS auc_roc,
            round_even(sum(pos * tp / (tp + fp)) / max(p), 4) AS avg_precision
          FROM (SELECT model, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
                  CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
                  CAST(sum(pos) OVER (PARTITION BY model) AS DOUBLE) AS p,
                  CAST(sum(neg) OVER (PARTITION BY model) AS DOUBLE) AS n
                FROM (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos,
                        count(*) FILTER (WHERE label = 0) AS neg FROM rivals GROUP BY model, score)
                WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
          GROUP BY model) USING (model)"""

_HIST_FACTS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high,
      {_quantile(c, 0.99, 'train_rows')} AS p99 FROM train_rows""" for c in _BEHAVIOURAL
)
_HIST_VALUES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(TARGET AS INT) AS label, CAST({c} AS DOUBLE) AS x FROM train_rows" for c in _BEHAVIOURAL
)
BLOCKS["spans"] = f"""
    SELECT feature, low, top, (top - low) / 40 AS width FROM
      (SELECT feature, low, CASE WHEN p99 > low THEN p99 ELSE high END AS top FROM ({_HIST_FACTS}))
    WHERE top > low"""
BLOCKS["binned"] = f"""
    SELECT feature, label, width, CASE WHEN x < low + k * width THEN k - 1
        WHEN k < 39 AND x >= low + (k + 1) * width THEN k + 1 ELSE k END AS bin
    FROM (SELECT *, least(floor((x - low) / width), 39) AS k
          FROM (SELECT feature, label, low, width, least(greatest(x, low), top) AS x
                FROM ({_HIST_VALUES}) JOIN spans USING (feature) WHERE label IN (0, 1)))"""

_VIEW_TABLES = ["agg_bureau", "agg_previous", "agg_pos", "agg_card", "agg_installments"]
_NAMES = {"agg_bureau": "bureau", "agg_previous": "previous", "agg_pos": "pos", "agg_card": "card",
          "agg_installments": "instalments"}


def _profile_of(name, table):
    return f"""SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys,
      count(*) FILTER (WHERE n > 1) AS duplicated_keys
      FROM (SELECT SK_ID_CURR, count(*) AS n FROM {table} WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)"""


def _compact():
    """The type rules over the application view."""
    parts = []
    for name, kind in [("SK_ID_CURR", "bigint"), ("TARGET", "int"), ("DAYS_BIRTH", "int"), ("DAYS_EMPLOYED", "int")]:
        fits = " ".join(
            f"WHEN min({name}) >= {-2 ** (bits - 1)} AND max({name}) < {2 ** (bits - 1)} THEN '{to}'"
            for to, bits in [("tinyint", 8), ("smallint", 16), ("int", 32)]
        )
        parts.append(f"SELECT '{name}' AS column_name, '{kind}' AS from_type, CASE {fits} ELSE '{kind}' END AS to_type FROM application")
    for name in ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS"]:
        parts.append(f"""SELECT '{name}', 'double',
          CASE WHEN max(abs({name} - CAST(CAST({name} AS FLOAT) AS DOUBLE))) <= 0.0005 THEN 'float' ELSE 'double' END
          FROM application""")
    return " UNION ALL ".join(parts)


def _completeness():
    expected = {
        "application_train": (1200, "train_set"), "bureau": (16000, "bureau"),
        "bureau_balance": (70000, "bureau_balance"), "previous_application": (40000, "previous_application"),
        "POS_CASH_balance": (10000, "pos_cash"), "credit_card_balance": (10000, "credit_card"),
        "installments_payments": (60000, "installments_payments"),
    }
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, CAST({n} AS BIGINT) AS expected_rows,
          {f'(SELECT count(*) FROM {table})' if table else 'CAST(NULL AS BIGINT)'} AS actual_rows"""
        for name, (n, table) in expected.items()
    )
    return f"""SELECT *, CASE WHEN actual_rows IS NULL THEN 'absent'
        WHEN CAST(actual_rows AS DOUBLE) / expected_rows < 0.5 THEN 'error'
        WHEN CAST(actual_rows AS DOUBLE) / expected_rows < 0.9 THEN 'warn' ELSE 'ok' END AS status FROM ({rows})"""


def _missing():
    keep = ["SK_ID_CURR", "SET", "TARGET", "FLAG_YES_NO", "NAME_SEGMENT", "income_group", "loan_size", "age_group",
            "risk_level", "employment_group", *NUMERIC]
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS missing_count, count(*) AS n FROM features" for c in keep
    )
    return f"""SELECT column_name, missing_count, round_even(CAST(missing_count AS DOUBLE) / n * 100, 2) AS missing_pct
        FROM ({rows}) WHERE missing_count > 0"""


def _correlations():
    features = [c for c in PREPARED_COLUMNS]
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, covar_samp(CAST({c} AS DOUBLE), TARGET)
          / nullif(stddev_samp(CAST({c} AS DOUBLE)) * stddev_samp(TARGET), 0) AS r FROM train_rows""" for c in features
    )
    return f"""SELECT feature, round(abs(r), 6) AS abs_correlation FROM ({rows}) WHERE r IS NOT NULL
        ORDER BY round_even(abs(r), 10) DESC, feature LIMIT 20"""


_MART = f"""SELECT age_band, employment_band, count(*) AS customers,
      round(sum(target) * 100.0 / count(target), 2) AS default_rate_pct
    FROM (SELECT CAST(target AS DOUBLE) AS target, {_AGE_BAND} AS age_band, {_EMPLOYMENT_BAND} AS employment_band
          FROM {{table}} WHERE target IS NOT NULL) GROUP BY 1, 2"""
_RATE = "round(CAST(sum(target) AS DOUBLE) * 100.0 / count(target), 2)"


def _rate_by(segment):
    return f"SELECT {segment}, avg(TARGET) * 100 AS default_rate_pct FROM cut_rows WHERE {segment} IS NOT NULL GROUP BY 1"


def _check(name, severity, offending):
    return f"""SELECT '{name}' AS check_name, '{severity}' AS severity, count(*) AS failures,
      CASE WHEN count(*) = 0 THEN 'pass' ELSE '{severity}' END AS status FROM ({offending})"""


_ROW_COUNT = "SELECT * FROM (SELECT count(*) AS total_rows FROM slim) WHERE total_rows <> 307511"
_BAND = f"""SELECT * FROM (SELECT {_RATE} AS default_rate FROM slim WHERE target IS NOT NULL)
    WHERE NOT default_rate BETWEEN 7 AND 9"""
_QUIRKS = """SELECT CAST(count_if(bur_total_debt < 0) AS BIGINT) AS neg_debt,
    CAST(count_if(cc_utilisation > 1) AS BIGINT) AS over_limit FROM slim"""


def _nulls(columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM slim HAVING count(*) > count({c})" for c in columns
    )


def _ages(high):
    return f"SELECT days_birth FROM slim WHERE NOT CAST(days_birth AS DOUBLE) / 365 BETWEEN 18 AND {high}"


_EXPORTED = ["SK_ID_CURR", "TARGET", *PREPARED_COLUMNS]

QUERIES = {
    "scan_csv": "SELECT * FROM application",
    "scan_parquet": "SELECT * FROM customer",
    "sink_parquet": "SELECT * FROM bureau",
    "sink_bucketed": """SELECT SK_ID_CURR, prev_num_applications, inst_num_records, inst_late_rate
        FROM agg_previous LEFT JOIN agg_installments USING (SK_ID_CURR)""",
    "checkpoint_agg": "SELECT * FROM agg_installments",
    "export_slim": "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SLIM) + " FROM train_rows",
    "export_full": "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _EXPORTED) + " FROM train_rows",
    "metrics_table": "SELECT * FROM model_rows",
    "load_typed": "SELECT * FROM published",
    "staging_view": "SELECT * FROM published",
    "project_slim": "SELECT " + ", ".join(_SLIM) + " FROM features WHERE \"SET\" = 'train'",
    "tag_union": 'SELECT SK_ID_CURR, "SET", TARGET FROM apps',
    "filter_eq": "SELECT SK_ID_CURR, \"SET\" FROM apps WHERE \"SET\" = 'train' AND TARGET = 1",
    "filter_notnull": "SELECT SK_ID_CURR, TARGET FROM apps WHERE TARGET IS NOT NULL",
    "drop_columns": """SELECT * EXCLUDE (SK_ID_CURR, "SET", income_group, loan_size, age_group, risk_level,
        employment_group) FROM features""",
    "sentinel_null": """SELECT * REPLACE (nullif(DAYS_FIRST_DUE, 365243) AS DAYS_FIRST_DUE,
        nullif(DAYS_LAST_DUE, 365243) AS DAYS_LAST_DUE, nullif(DAYS_TERMINATION, 365243) AS DAYS_TERMINATION)
        FROM previous_application""",
    "missing_flag": "SELECT SK_ID_CURR, DAYS_EMPLOYED_FLAG FROM cleaned_apps",
    "indicator_flags": """SELECT SK_ID_PREV,
        CAST(CASE WHEN NAME_CONTRACT_STATUS = 'Completed' THEN 1 ELSE 0 END AS INT) AS is_completed,
        CAST(CASE WHEN NAME_CONTRACT_STATUS = 'Active' THEN 1 ELSE 0 END AS INT) AS is_active,
        CAST(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END AS INT) AS has_dpd,
        CAST(CASE WHEN CNT_INSTALMENT_FUTURE < 5 THEN 1 ELSE 0 END AS INT) AS ends_soon FROM pos_cash""",
    "isin_flag": """SELECT SK_ID_BUREAU, MONTHS_BALANCE,
        CAST(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END AS INT) AS is_bad FROM bureau_balance""",
    "abs_days": "SELECT SK_ID_CURR, DAYS_BIRTH, DAYS_EMPLOYED FROM cleaned_apps",
    "diff_cols": """SELECT SK_ID_CURR, SK_ID_PREV, DAYS_LATE, PAYMENT_DIFF,
        CAST(CASE WHEN DAYS_LATE > 0 THEN 1 ELSE 0 END AS INT) AS PAID_LATE,
        CAST(CASE WHEN DAYS_LATE < 0 THEN 1 ELSE 0 END AS INT) AS PAID_EARLY FROM payments""",
    "ratio_null": "SELECT SK_ID_CURR, SK_ID_PREV, PAYMENT_RATIO FROM payments",
    "ratio_fill": f"""SELECT SK_ID_CURR, {_or_zero('AMT_INCOME_TOTAL', 'AMT_CREDIT')} AS income_credit_ratio,
        {_or_zero('AMT_ANNUITY', 'AMT_CREDIT', '-1')} AS annuity_credit_ratio FROM application""",
    "years": "SELECT SK_ID_CURR, CAST(abs(DAYS_BIRTH) AS DOUBLE) / 365 AS age_years FROM application",
    "fill_const": "SELECT SK_ID_CURR, coalesce(CNT_FAM_MEMBERS, 1) AS CNT_FAM_MEMBERS FROM application",
    "bin_left": f"SELECT SK_ID_CURR, {_INCOME_GROUP} AS income_group, {_LOAN_SIZE} AS loan_size FROM application",
    "bin_right": f"""SELECT SK_ID_CURR, {_AGE_GROUP} AS age_group, {_EMPLOYMENT_GROUP} AS employment_group,
        {_RISK} AS risk_level FROM app_ratios""",
    "case_bands": f"""SELECT SK_ID_CURR, {_AGE_BAND} AS age_band, {_EMPLOYMENT_BAND} AS employment_band
        FROM app_ratios""",
    "clip": """SELECT SK_ID_CURR, least(greatest(AMT_INCOME_TOTAL, 50000), 200000) AS AMT_INCOME_TOTAL,
        CASE WHEN AMT_ANNUITY IS NOT NULL THEN least(greatest(AMT_ANNUITY, 5000), 40000) END AS AMT_ANNUITY
        FROM application""",
    "cast_label": "SELECT SK_ID_CURR, CAST(TARGET AS INT) AS TARGET FROM apps WHERE \"SET\" = 'train'",
    "compact_types": _compact(),
    "round_modes": """SELECT SK_ID_CURR, round_even(CAST(SK_ID_CURR % 1000 AS DOUBLE) / 8, 2) AS half_even,
        round(CAST(SK_ID_CURR % 1000 AS DOUBLE) / 8, 2) AS half_up FROM application""",
    "features_full": "SELECT * FROM features",
    "join_child_summary": "SELECT * FROM credits",
    "customer_360": "SELECT * FROM customer_view",
    "join_guard": " UNION ALL ".join(
        [_profile_of("application", "apps")] + [_profile_of(_NAMES[t], t) for t in _VIEW_TABLES]
    ),
    "agg_bureau_balance": "SELECT * FROM balance",
    "agg_bureau": "SELECT * FROM agg_bureau",
    "agg_previous": "SELECT * FROM agg_previous",
    "agg_pos": "SELECT * FROM agg_pos",
    "agg_card": "SELECT * FROM agg_card",
    "agg_installments": "SELECT * FROM agg_installments",
    "count_if": """SELECT SK_ID_CURR, count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Completed') AS completed,
        count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Active') AS active FROM pos_cash GROUP BY SK_ID_CURR""",
    "rate_by_age": _rate_by("age_group"),
    "rate_by_employment": _rate_by("employment_group"),
    "rate_by_income": _rate_by("income_group"),
    "cohort_default_rates": _MART.format(table="slim"),
    "cohort_default_rates_published": _MART.format(table="published"),
    "pivot_age_employment": "SELECT age_group, " + ", ".join(
        f"avg(TARGET) FILTER (WHERE employment_group = '{e}') * 100 AS \"{e}\"" for e in _EMPLOYMENT
    ) + " FROM cut_rows WHERE age_group IS NOT NULL AND employment_group IS NOT NULL GROUP BY 1",
    "set_profile": """SELECT count(*) FILTER (WHERE "SET" = 'train') AS train_rows,
        count(*) FILTER (WHERE "SET" = 'test') AS test_rows,
        avg(TARGET) FILTER (WHERE "SET" = 'train') * 100 AS default_rate_pct FROM apps""",
    "filtered_counts": _QUIRKS,
    "missing_profile": _missing(),
    "nunique": """SELECT 'NAME_SEGMENT' AS column_name, count(DISTINCT NAME_SEGMENT) AS distinct_values FROM application
        UNION ALL SELECT 'FLAG_YES_NO', count(DISTINCT FLAG_YES_NO) FROM application""",
    "medians": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_quantile(c, 0.5, 'features')} AS median_value" for c in NUMERIC
    ),
    "boosted_rounds": "SELECT round, true AS falls, true AS within FROM range(1, 601) AS rounds(round)",
    "quantiles": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS share, {_quantile(c, p, 'features')} AS value"
        for c in _CAPPED + _BEHAVIOURAL for p in (0.01, 0.99)
    ),
    "top_correlations": _correlations(),
    "class_histogram": """SELECT f.feature, f.label, CAST(b.bin AS INT) AS bin, coalesce(c.n, 0) AS n,
        CAST(coalesce(c.n, 0) AS DOUBLE) / (CAST(f.size AS DOUBLE) * f.width) AS density
        FROM (SELECT feature, label, width, count(*) AS size FROM binned GROUP BY ALL) f
        CROSS JOIN (SELECT unnest(range(40)) AS bin) b
        LEFT JOIN (SELECT feature, label, bin, count(*) AS n FROM binned GROUP BY ALL) c
          ON c.feature = f.feature AND c.label = f.label AND c.bin = b.bin""",
    "class_weights": """SELECT label, n, CAST(total AS DOUBLE) / (2 * n) AS balanced_weight,
        CASE WHEN label = 1 THEN CAST(total - n AS DOUBLE) / n ELSE 1 END AS positive_weight
        FROM (SELECT CAST(TARGET AS INT) AS label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
              FROM train_rows GROUP BY 1)""",
    "minmax": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM features"
        for c in _BEHAVIOURAL
    ),
    "cumulative_gain": """SELECT SK_ID_CURR, score, label, position,
        CAST(position AS DOUBLE) / n * 100 AS population_pct, CAST(caught AS DOUBLE) / p * 100 AS gain_pct FROM gain""",
    "sort_desc": "SELECT * FROM predicted ORDER BY score DESC, SK_ID_CURR",
    "top_k": "SELECT * FROM predicted ORDER BY score DESC, SK_ID_CURR LIMIT 30",
    "fbeta_sweep": "SELECT * FROM sweep",
    "best_threshold": "SELECT * FROM sweep ORDER BY fbeta DESC, threshold LIMIT 1",
    "roc_auc": "SELECT round_even(sum(pos * (n - fp + neg / 2)) / (max(p) * max(n)), 4) AS auc_roc FROM levels",
    "avg_precision": "SELECT round_even(sum(pos * tp / (tp + fp)) / max(p), 4) AS avg_precision FROM levels",
    "class_report": f"""SELECT round_even({_PRECISION}, 4) AS precision_default,
        round_even({_RECALL}, 4) AS recall_default, round_even({_f(1)}, 4) AS f1_default
        FROM (SELECT count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp,
            count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp,
            count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn FROM predicted)""",
    "roc_curve": """SELECT CAST(NULL AS DOUBLE) AS score, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
        UNION ALL SELECT score, fp / n, tp / p FROM levels""",
    "pr_curve": """SELECT score, tp / (tp + fp) AS precision, tp / p AS recall, p / (p + n) AS base_rate FROM levels
        UNION ALL SELECT NULL, 1, 0, avg(label) FROM scored""",
    "confusion": """SELECT label, count(*) FILTER (WHERE predicted = 0) AS predicted_0,
        count(*) FILTER (WHERE predicted = 1) AS predicted_1 FROM predicted GROUP BY label""",
    "top20_capture": """SELECT pct AS capture_pct, pct / 20 AS lift FROM (
        SELECT CAST(sum(label) FILTER (WHERE position <= floor(n * 0.2)) AS DOUBLE) / max(p) * 100 AS pct FROM gain)""",
    "leaderboard": "SELECT * FROM model_rows ORDER BY auc_roc DESC, model LIMIT 1",
    "union_by_name": "SELECT * FROM apps",
    "union_all": "SELECT SK_ID_CURR, TARGET, AMT_CREDIT FROM apps WHERE TARGET IN (0, 1)",
    "encode_binary": f"SELECT SK_ID_CURR, {_FLAG_CODE} FROM application",
    "encode_onehot": f"SELECT SK_ID_CURR, {_SEGMENT_FLAGS} FROM application",
    "category_table": "SELECT column_name, value, n, code, position FROM text_categories",
    "encode_sparse": """SELECT SK_ID_CURR, CAST((SELECT max(position) + 1 FROM text_categories) AS INT) AS width,
        coalesce(string_agg(CAST(position AS VARCHAR), ',' ORDER BY position), '') AS positions,
        CAST(count(position) AS DOUBLE) AS total
        FROM text_values JOIN text_categories USING (i, column_name, value) GROUP BY SK_ID_CURR""",
    "compact_table": "SELECT * FROM application",
    "drop_sparse": f"SELECT SK_ID_CURR, {_FLAG_CODE}, {_SEGMENT_FLAGS}, "
                   + ", ".join(c for c in NUMERIC if c not in _SPARSE) + " FROM features",
    "impute_median": f"SELECT SK_ID_CURR, {_FLAG_CODE}, {_SEGMENT_FLAGS}, "
                     + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC) + " FROM filled",
    "winsorise": "SELECT SK_ID_CURR, " + ", ".join(_CAPPED) + " FROM prepared",
    "slice_sets": """SELECT SK_ID_CURR, CAST(TARGET AS INT) AS TARGET, "SET" AS slice FROM apps""",
    "stratified_split": """SELECT SK_ID_CURR, CAST(TARGET AS INT) AS TARGET,
        CASE WHEN row_number() OVER (PARTITION BY TARGET ORDER BY md5('42:' || SK_ID_CURR))
          <= floor(count(*) OVER (PARTITION BY TARGET) * 0.2 + 0.5) THEN 'held_out' ELSE 'train' END AS part FROM train_set""",
    "sample_n": """SELECT SK_ID_CURR FROM application
        QUALIFY row_number() OVER (ORDER BY md5('42:' || SK_ID_CURR)) <= 1000""",
    "model_roundtrip": """SELECT SK_ID_CURR, true AS same FROM train_set
        QUALIFY row_number() OVER (PARTITION BY TARGET ORDER BY md5('42:' || SK_ID_CURR))
          <= floor(count(*) OVER (PARTITION BY TARGET) * 0.2 + 0.5)""",
    "score_batch": """SELECT SK_ID_CURR, true AS in_range, true AS agrees FROM test_set""",
    "stratified_split_shares": """SELECT TARGET, count(*) AS n, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS held_out
        FROM train_set GROUP BY TARGET""",
    "sample_n_size": """SELECT least(count(*), 1000) AS n, least(count(DISTINCT SK_ID_CURR), 1000) AS distinct_keys
        FROM application""",
    "dq_accepted_values": "SELECT target, count(*) AS n FROM slim WHERE target NOT IN (0, 1) GROUP BY target",
    "dq_not_null": _nulls(["amt_income_total", "amt_credit", "days_birth", "days_employed"]),
    "dq_age_range": _ages(100),
    "dq_row_count": _ROW_COUNT,
    "dq_rate_band": _BAND,
    "dq_quirks": f"SELECT * FROM ({_QUIRKS}) WHERE neg_debt > 5000 OR over_limit > 5000",
    "dq_completeness": _completeness(),
    "dq_no_nulls": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM prepared HAVING count(*) > count({c})"
        for c in PREPARED_COLUMNS
    ),
    "dq_report": " UNION ALL ".join([
        _check("accepted_values_target", "error",
               "SELECT target, count(*) AS n FROM slim WHERE target NOT IN (0, 1) GROUP BY target"),
        _check("not_null", "error", _nulls(["amt_income_total", "amt_credit", "days_birth"])),
        _check("age_range", "error", _ages(100)),
        _check("row_count", "error", _ROW_COUNT),
        _check("rate_band", "error", _BAND),
        _check("quirks", "warn", f"SELECT * FROM ({_QUIRKS}) WHERE neg_debt > 5000 OR over_limit > 5000"),
    ]),
}


def _words(text):
    word, found = "", set()
    for ch in text:
        if ch.isalnum() or ch == "_":
            word += ch
        else:
            found.add(word)
            word = ""
    return found | {word}


def full_sql(name):
    """The query with the blocks it uses, each materialised once."""
    text, needed = QUERIES[name], set()
    pending = [text]
    while pending:
        for block in _words(pending.pop()) & set(BLOCKS):
            if block not in needed:
                needed.add(block)
                pending.append(BLOCKS[block])
    parts = [f"{block} AS MATERIALIZED ({BLOCKS[block]})" for block in BLOCKS if block in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + text


def all_sql():
    return {name: full_sql(name) for name in QUERIES}
