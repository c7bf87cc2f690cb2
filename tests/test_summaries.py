"""Customer summaries on small frames with results worked out by hand."""

from creditloom.operators import features, summaries


def by_key(df, key="SK_ID_CURR"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_balance(rows):
    bb = rows("SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string",
              (1, -1, "0"), (1, -2, "3"), (1, -3, "5"), (2, -1, "C"), (2, None, "X"), (2, -2, None), (None, -1, "1"))
    assert by_key(summaries.summarise_balance(bb), "SK_ID_BUREAU") == {
        1: {"SK_ID_BUREAU": 1, "bb_months_total": 3, "bb_months_bad": 2, "bb_max_dpd_band": 1},
        2: {"SK_ID_BUREAU": 2, "bb_months_total": 2, "bb_months_bad": 0, "bb_max_dpd_band": 0},
    }


def test_bureau(rows):
    bureau = rows(
        "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double,"
        "AMT_CREDIT_SUM_OVERDUE double, DAYS_CREDIT int, DAYS_CREDIT_ENDDATE double, CNT_CREDIT_PROLONG int",
        (7, 1, "Active", 100.0, 40.0, 0.0, -10, 5.0, 1),
        (7, 2, "Closed", 300.0, None, 20.0, -30, None, 0),
        (7, 3, None, None, None, None, -20, None, 0),
        (8, 4, "Active", 0.0, None, 0.0, -1, None, 0),
        (None, 5, "Active", 9.0, 9.0, 9.0, -1, 1.0, 0),
    )
    bb = rows("SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string", (1, -1, "2"), (1, -2, "0"), (3, -1, "C"))
    found = by_key(summaries.summarise_bureau(bureau, bb))
    assert set(found) == {7, 8}
    seven = found[7]
    assert len(seven) == 20
    assert (seven["bur_num_credits"], seven["bur_num_active"], seven["bur_num_closed"]) == (3, 1, 1)
    assert (seven["bur_total_credit"], seven["bur_avg_credit"], seven["bur_total_debt"]) == (400.0, 200.0, 40.0)
    assert (seven["bur_max_overdue"], seven["bur_avg_overdue"], seven["bur_total_overdue"]) == (20.0, 10.0, 20.0)
    assert (seven["bur_days_credit_mean"], seven["bur_days_credit_min"]) == (-20.0, -30)
    assert (seven["bur_days_enddate_mean"], seven["bur_days_enddate_max"]) == (5.0, 5.0)
    # credits 1 and 3 have months, credit 2 has none and stays out of the mean
    assert (seven["bur_num_bad_months"], seven["bur_avg_bad_months"]) == (1, 0.5)
    assert (seven["bur_debt_credit_ratio"], seven["bur_overdue_credit_ratio"]) == (0.1, 0.05)
    assert seven["bur_active_ratio"] == 1 / 3
    assert found[8]["bur_debt_credit_ratio"] is None and found[8]["bur_avg_bad_months"] is None
    assert found[8]["bur_num_bad_months"] == 0 and found[8]["bur_total_debt"] == 0.0


def test_previous(rows):
    previous = rows(
        "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, AMT_CREDIT double, AMT_ANNUITY double,"
        "AMT_DOWN_PAYMENT double, RATE_DOWN_PAYMENT double, CNT_PAYMENT double, DAYS_DECISION int,"
        "HOUR_APPR_PROCESS_START int, DAYS_FIRST_DUE double, DAYS_LAST_DUE double, DAYS_TERMINATION double",
        (1, 10, "Approved", 100.0, 10.0, None, None, 12.0, -5, 10, 365243.0, -1.0, 365243.0),
        (1, 11, "Refused", 200.0, 20.0, 4.0, 0.5, 24.0, -9, 12, -7.0, 365243.0, 365243.0),
        (1, 12, "Canceled", 0.0, None, None, None, None, -1, 14, -9.0, -3.0, 365243.0),
        (1, 13, "Unused", 0.0, None, None, None, None, -1, 16, None, None, None),
    )
    row = by_key(summaries.summarise_previous(previous))[1]
    assert len(row) == 19
    assert [row["prev_" + c] for c in ("num_applications", "num_approved", "num_refused", "num_cancelled")] == [4, 1, 1, 1]
    assert (row["prev_days_first_due_mean"], row["prev_days_last_due_mean"]) == (-8.0, -2.0)
    assert row["prev_days_termination_mean"] is None
    assert (row["prev_amt_down_mean"], row["prev_rate_down_mean"], row["prev_cnt_payment_mean"]) == (4.0, 0.5, 18.0)
    assert (row["prev_days_decision_min"], row["prev_hour_appr_mean"]) == (-9, 13.0)
    assert (row["prev_approval_rate"], row["prev_refusal_rate"]) == (0.25, 0.25)


def test_pos(rows):
    pos = rows(
        "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE int, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double,"
        "SK_DPD int, SK_DPD_DEF int, NAME_CONTRACT_STATUS string",
        (1, 5, -1, 10.0, 4.0, 0, 0, "Active"), (1, 5, -3, None, None, 6, 2, "Completed"), (1, 6, -2, 20.0, 0.0, 0, 0, None),
        (2, 7, -1, None, None, 0, 0, "Signed"),
    )
    found = by_key(summaries.summarise_pos(pos))
    assert len(found[1]) == 14
    assert (found[1]["pos_num_completed"], found[1]["pos_num_active"], found[1]["pos_num_records"]) == (1, 1, 3)
    assert (found[1]["pos_sk_dpd_mean"], found[1]["pos_dpd_flag"], found[2]["pos_dpd_flag"]) == (2.0, 1, 0)
    assert (found[1]["pos_cnt_instalment_mean"], found[2]["pos_cnt_instalment_mean"]) == (15.0, None)
    assert found[1]["pos_completion_rate"] == 1 / 3


def test_card(rows):
    card = rows(
        "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE int, SK_DPD int, SK_DPD_DEF int, AMT_BALANCE double,"
        "AMT_CREDIT_LIMIT_ACTUAL double, AMT_DRAWINGS_CURRENT double, AMT_PAYMENT_CURRENT double,"
        "AMT_TOTAL_RECEIVABLE double, CNT_DRAWINGS_CURRENT double",
        (1, 5, -1, 0, 0, 150.0, 100.0, None, None, 30.0, None), (1, 5, -2, 3, 1, 90.0, 100.0, 5.0, 8.0, 50.0, 2.0),
        (2, 6, -1, 0, 0, 10.0, 0.0, None, None, 1.0, None),
    )
    found = by_key(summaries.summarise_card(card))
    assert len(found[1]) == 17
    assert (found[1]["cc_utilisation"], found[1]["cc_over_limit"], found[1]["cc_dpd_flag"]) == (1.2, 1, 1)
    assert (found[2]["cc_utilisation"], found[2]["cc_over_limit"], found[2]["cc_drawings_total"]) == (None, 0, 0.0)
    assert found[1]["cc_payment_total_mean"] == 40.0


def test_instalments(rows):
    paid = rows(
        "SK_ID_CURR long, SK_ID_PREV long, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double,"
        "AMT_INSTALMENT double, AMT_PAYMENT double",
        (1, 5, -10.0, -8.0, 100.0, 50.0), (1, 5, -10.0, -13.0, 0.0, 10.0), (1, 5, -10.0, None, 100.0, None),
        (1, 5, -10.0, -10.0, 100.0, 100.0),
    )
    row = by_key(summaries.summarise_instalments(paid))[1]
    assert len(row) == 14
    assert (row["inst_num_records"], row["inst_num_late"], row["inst_num_early"], row["inst_late_rate"]) == (4, 1, 1, 0.25)
    assert (row["inst_days_late_sum"], row["inst_days_late_max"]) == (-1.0, 2.0)
    assert (row["inst_payment_ratio_mean"], row["inst_payment_ratio_min"]) == (0.75, 0.5)
    assert (row["inst_payment_diff_max"], row["inst_amt_payment_sum"], row["inst_amt_instalment_sum"]) == (50.0, 160.0, 300.0)


def test_engineered_columns(rows):
    df = rows(
        "SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double,"
        "CNT_FAM_MEMBERS double, DAYS_BIRTH int, DAYS_EMPLOYED int, DAYS_REGISTRATION double, inst_num_late long,"
        "prev_num_applications long, DAYS_OF_SUMMARY int",
        (1, 1000.0, 2000.0, 100.0, 0.0, None, -7300, -730, -50.0, 4, 2, -9),
        (2, 0.0, 0.0, None, 10.0, 4.0, -20000, 365243, None, 4, 0, -9),
    )
    own = [c for c in df.columns if c not in ("inst_num_late", "prev_num_applications", "DAYS_OF_SUMMARY")]
    a, b = features.engineer(df, own).orderBy("SK_ID_CURR").collect()
    assert (a.DAYS_BIRTH, a.DAYS_EMPLOYED, a.DAYS_REGISTRATION, a.DAYS_OF_SUMMARY, a.DAYS_EMPLOYED_FLAG) == (7300, 730, 50.0, -9, 0)
    assert (b.DAYS_EMPLOYED, b.DAYS_EMPLOYED_FLAG, b.employment_age_ratio, b.employed_years) == (None, 1, None, None)
    assert (a.income_credit_ratio, a.annuity_income_ratio, a.credit_goods_ratio) == (0.5, 0.1, 0.0)
    assert (a.employment_age_ratio, a.age_years, a.employed_years, a.income_per_person) == (0.1, 20.0, 2.0, 1000.0)
    assert (b.income_credit_ratio, b.annuity_income_ratio, b.income_per_person) == (0.0, 0.0, 0.0)
    assert (a.inst_late_per_credit, b.inst_late_per_credit) == (2.0, 0.0)
    # absent summaries count as nothing, not as missing
    assert (a.bur_debt_income_ratio, a.cc_util_income_ratio) == (0.0, 0.0)
    assert (a.income_group, a.loan_size, a.age_group, a.employment_group, a.risk_level) == (
        "Low", "Small", "18-29", "Unstable", "Medium Risk")
