"""Secondary tables summarised to one row per credit or per customer.

Each table states its measures as source column -> {statistic: feature}. All
statistics are algebraic, so Spark combines them on the map side before its one
shuffle per table; a customer with a third of the rows costs no more than any other.
"""

from pyspark.sql import functions as F

from creditloom.functions.scalar import flag, ratio, sentinel_to_null
from creditloom.functions.totals import STATISTICS
from creditloom.operators.joins import left_join_unique
from creditloom.settings import CREDIT, CUSTOMER

LATE_STATUSES = ["1", "2", "3", "4", "5"]

BALANCE_MEASURES = {
    "MONTHS_BALANCE": {"count": "bb_months_total"},
    "is_bad": {"sum": "bb_months_bad", "max": "bb_max_dpd_band"},
}
BUREAU_MEASURES = {
    "SK_ID_BUREAU": {"count": "bur_num_credits"},
    "is_active": {"rows": "bur_num_active"},
    "is_closed": {"rows": "bur_num_closed"},
    "AMT_CREDIT_SUM": {"sum": "bur_total_credit", "mean": "bur_avg_credit"},
    "AMT_CREDIT_SUM_DEBT": {"sum": "bur_total_debt"},
    "AMT_CREDIT_SUM_OVERDUE": {
        "max": "bur_max_overdue", "mean": "bur_avg_overdue", "sum": "bur_total_overdue",
    },
    "DAYS_CREDIT": {"mean": "bur_days_credit_mean", "min": "bur_days_credit_min"},
    "DAYS_CREDIT_ENDDATE": {"mean": "bur_days_enddate_mean", "max": "bur_days_enddate_max"},
    "CNT_CREDIT_PROLONG": {"sum": "bur_prolong_sum"},
    "bb_months_bad": {"sum": "bur_num_bad_months", "mean": "bur_avg_bad_months"},
}
PREVIOUS_MEASURES = {
    "SK_ID_PREV": {"count": "prev_num_applications"},
    "is_approved": {"rows": "prev_num_approved"},
    "is_refused": {"rows": "prev_num_refused"},
    "is_cancelled": {"rows": "prev_num_cancelled"},
    "AMT_CREDIT": {"sum": "prev_amt_credit_sum", "mean": "prev_amt_credit_mean"},
    "AMT_ANNUITY": {"mean": "prev_amt_annuity_mean"},
    "AMT_DOWN_PAYMENT": {"mean": "prev_amt_down_mean"},
    "DAYS_DECISION": {"mean": "prev_days_decision_mean", "min": "prev_days_decision_min"},
    "HOUR_APPR_PROCESS_START": {"mean": "prev_hour_appr_mean"},
    "RATE_DOWN_PAYMENT": {"mean": "prev_rate_down_mean"},
    "DAYS_FIRST_DUE": {"mean": "prev_days_first_due_mean"},
    "DAYS_LAST_DUE": {"mean": "prev_days_last_due_mean"},
    "DAYS_TERMINATION": {"mean": "prev_days_termination_mean"},
    "CNT_PAYMENT": {"mean": "prev_cnt_payment_mean"},
}
POS_MEASURES = {
    "SK_ID_PREV": {"count": "pos_num_records"},
    "MONTHS_BALANCE": {"mean": "pos_months_balance_mean", "max": "pos_months_balance_max"},
    "CNT_INSTALMENT": {"mean": "pos_cnt_instalment_mean"},
    "CNT_INSTALMENT_FUTURE": {"mean": "pos_cnt_instalment_future"},
    "SK_DPD": {"mean": "pos_sk_dpd_mean", "max": "pos_sk_dpd_max"},
    "SK_DPD_DEF": {"mean": "pos_sk_dpd_def_mean", "max": "pos_sk_dpd_def_max"},
    "is_completed": {"rows": "pos_num_completed"},
    "is_active": {"rows": "pos_num_active"},
}
# The mean total payment is taken from the receivable column, as published.
CARD_MEASURES = {
    "SK_ID_PREV": {"count": "cc_num_records"},
    "MONTHS_BALANCE": {"mean": "cc_months_balance_mean"},
    "AMT_BALANCE": {"mean": "cc_balance_mean", "max": "cc_balance_max"},
    "AMT_CREDIT_LIMIT_ACTUAL": {"mean": "cc_credit_limit_mean"},
    "AMT_DRAWINGS_CURRENT": {"mean": "cc_drawings_mean", "sum": "cc_drawings_total"},
    "AMT_PAYMENT_CURRENT": {"mean": "cc_payment_current_mean"},
    "AMT_TOTAL_RECEIVABLE": {"mean": "cc_payment_total_mean"},
    "SK_DPD": {"mean": "cc_dpd_mean", "max": "cc_dpd_max"},
    "SK_DPD_DEF": {"mean": "cc_dpd_def_mean"},
    "CNT_DRAWINGS_CURRENT": {"mean": "cc_cnt_drawings_mean"},
}
INSTALMENT_MEASURES = {
    "SK_ID_PREV": {"count": "inst_num_records"},
    "DAYS_LATE": {"mean": "inst_days_late_mean", "max": "inst_days_late_max", "sum": "inst_days_late_sum"},
    "PAYMENT_RATIO": {"mean": "inst_payment_ratio_mean", "min": "inst_payment_ratio_min"},
    "PAYMENT_DIFF": {"mean": "inst_payment_diff_mean", "max": "inst_payment_diff_max"},
    "PAID_LATE": {"rows": "inst_num_late"},
    "PAID_EARLY": {"rows": "inst_num_early"},
    "AMT_PAYMENT": {"sum": "inst_amt_payment_sum"},
    "AMT_INSTALMENT": {"sum": "inst_amt_instalment_sum"},
}


def summarise(df, key, measures):
    """One row per key; rows without a key take no part."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[
            STATISTICS[statistic](F.col(source)).alias(feature)
            for source, features in measures.items()
            for statistic, feature in features.items()
        ])
    )


def _share(part, whole):
    return ratio(F.col(part), F.col(whole))


def is_late_status(status):
    """1 for the five days-past-due bands; 0 for on time, closed, unknown or missing."""
    return flag(status.isin(LATE_STATUSES))


def summarise_balance(bureau_balance):
    """Credit-months to one row per external credit."""
    marked = bureau_balance.select(CREDIT, "MONTHS_BALANCE", is_late_status(F.col("STATUS")).alias("is_bad"))
    return summarise(marked, CREDIT, BALANCE_MEASURES)


def with_balance(bureau, bureau_balance):
    """External credits with their month summary; NULL for credits without months."""
    return left_join_unique(bureau, [summarise_balance(bureau_balance)], CREDIT)


def summarise_bureau(bureau, bureau_balance):
    """19 features per customer from external credits and their months."""
    credits = with_balance(bureau, bureau_balance.select(CREDIT, "MONTHS_BALANCE", "STATUS")).withColumns({
        "is_active": F.col("CREDIT_ACTIVE") == "Active",
        "is_closed": F.col("CREDIT_ACTIVE") == "Closed",
    })
    return summarise(credits, CUSTOMER, BUREAU_MEASURES).withColumns({
        "bur_debt_credit_ratio": _share("bur_total_debt", "bur_total_credit"),
        "bur_overdue_credit_ratio": _share("bur_total_overdue", "bur_total_credit"),
        "bur_active_ratio": _share("bur_num_active", "bur_num_credits"),
    })


def without_sentinels(df):
    """The no-value code of every DAYS_ column to NULL; other columns keep theirs."""
    return df.withColumns({
        name: sentinel_to_null(F.col(name)) for name in df.columns if name.startswith("DAYS_")
    })


def summarise_previous(previous):
    """18 features per customer from previous applications."""
    status = F.col("NAME_CONTRACT_STATUS")
    marked = without_sentinels(previous).withColumns({
        "is_approved": status == "Approved",
        "is_refused": status == "Refused",
        "is_cancelled": status == "Canceled",
    })
    return summarise(marked, CUSTOMER, PREVIOUS_MEASURES).withColumns({
        "prev_approval_rate": _share("prev_num_approved", "prev_num_applications"),
        "prev_refusal_rate": _share("prev_num_refused", "prev_num_applications"),
    })


def summarise_pos(pos):
    """13 features per customer from point-of-sale and cash loan months."""
    status = F.col("NAME_CONTRACT_STATUS")
    marked = pos.withColumns({"is_completed": status == "Completed", "is_active": status == "Active"})
    return summarise(marked, CUSTOMER, POS_MEASURES).withColumns({
        "pos_dpd_flag": flag(F.col("pos_sk_dpd_max") > 0),
        "pos_completion_rate": _share("pos_num_completed", "pos_num_records"),
    })


def summarise_card(card):
    """16 features per customer from credit card months."""
    utilisation = _share("cc_balance_mean", "cc_credit_limit_mean")
    return summarise(card, CUSTOMER, CARD_MEASURES).withColumns({
        "cc_utilisation": utilisation,
        "cc_dpd_flag": flag(F.col("cc_dpd_max") > 0),
        "cc_over_limit": flag(utilisation > 1.0),
    })


def with_payment_measures(instalments):
    """Lateness, payment ratio and difference per instalment; unknown when unpaid."""
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return instalments.withColumns({
        "DAYS_LATE": late,
        "PAYMENT_RATIO": ratio(F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT")),
        "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "PAID_LATE": late > 0,
        "PAID_EARLY": late < 0,
    })


def summarise_instalments(instalments):
    """13 features per customer from instalment payments."""
    return summarise(with_payment_measures(instalments), CUSTOMER, INSTALMENT_MEASURES).withColumn(
        "inst_late_rate", _share("inst_num_late", "inst_num_records")
    )
