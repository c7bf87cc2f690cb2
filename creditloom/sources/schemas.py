"""Declared types of the inputs and of the published table."""

from pyspark.sql import types as T

from creditloom.settings import SLIM_COLUMNS


def _table(longs=(), ints=(), doubles=(), strings=()):
    kinds = [(longs, T.LongType()), (ints, T.IntegerType()), (doubles, T.DoubleType()), (strings, T.StringType())]
    return T.StructType([T.StructField(name, kind) for names, kind in kinds for name in names])


APPLICATION = _table(
    longs=["SK_ID_CURR"],
    ints=["TARGET", "DAYS_BIRTH", "DAYS_EMPLOYED"],
    doubles=["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS"],
)
BUREAU = _table(
    longs=["SK_ID_CURR", "SK_ID_BUREAU"],
    ints=["DAYS_CREDIT", "CNT_CREDIT_PROLONG"],
    doubles=["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_ENDDATE"],
    strings=["CREDIT_ACTIVE"],
)
BUREAU_BALANCE = _table(longs=["SK_ID_BUREAU"], ints=["MONTHS_BALANCE"], strings=["STATUS"])
PREVIOUS = _table(
    longs=["SK_ID_CURR", "SK_ID_PREV"],
    ints=["DAYS_DECISION", "HOUR_APPR_PROCESS_START"],
    doubles=[
        "AMT_CREDIT", "AMT_ANNUITY", "AMT_DOWN_PAYMENT", "RATE_DOWN_PAYMENT", "CNT_PAYMENT",
        "DAYS_FIRST_DUE", "DAYS_LAST_DUE", "DAYS_TERMINATION",
    ],
    strings=["NAME_CONTRACT_STATUS"],
)
POS_CASH = _table(
    longs=["SK_ID_CURR", "SK_ID_PREV"],
    ints=["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
    doubles=["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"],
    strings=["NAME_CONTRACT_STATUS"],
)
CREDIT_CARD = _table(
    longs=["SK_ID_CURR", "SK_ID_PREV"],
    ints=["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
    doubles=[
        "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT",
        "AMT_PAYMENT_CURRENT", "AMT_TOTAL_RECEIVABLE", "CNT_DRAWINGS_CURRENT",
    ],
)
INSTALMENTS = _table(
    longs=["SK_ID_CURR", "SK_ID_PREV"],
    doubles=["DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"],
)
INPUTS = {
    "application_train": APPLICATION,
    "application_test": T.StructType([f for f in APPLICATION if f.name != "TARGET"]),
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "previous_application": PREVIOUS,
    "POS_CASH_balance": POS_CASH,
    "credit_card_balance": CREDIT_CARD,
    "installments_payments": INSTALMENTS,
}

# The typed slim table: every column numeric, age in whole days.
SLIM = T.StructType(
    [
        T.StructField(name.lower(), T.IntegerType() if name == "DAYS_BIRTH" else T.DoubleType())
        for name in SLIM_COLUMNS
    ]
)
