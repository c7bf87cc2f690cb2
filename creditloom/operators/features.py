"""Ratios, interactions and segment labels on the customer view."""

from pyspark.sql import functions as F

from creditloom.functions import bands
from creditloom.functions.scalar import col, column_or, flag, ratio_or, sentinel_to_null, years


def cleaned_days(df, application_columns):
    """Application DAYS_ columns as positive day counts, employment without its no-value code.

    DAYS_ columns that came from a summary keep their sign.
    """
    employed = sentinel_to_null(F.col("DAYS_EMPLOYED"))
    own = [c for c in application_columns if c.startswith("DAYS_") and c in df.columns]
    return df.withColumns({
        **{c: F.abs(employed if c == "DAYS_EMPLOYED" else col(c)) for c in own},
        "DAYS_EMPLOYED_FLAG": flag(employed.isNull()),
    })


def with_ratios(df):
    income, credit = F.col("AMT_INCOME_TOTAL"), F.col("AMT_CREDIT")
    return df.withColumns({
        "income_credit_ratio": ratio_or(income, credit),
        "annuity_income_ratio": ratio_or(F.col("AMT_ANNUITY"), income),
        "credit_goods_ratio": ratio_or(credit, F.col("AMT_GOODS_PRICE")),
        "employment_age_ratio": ratio_or(F.col("DAYS_EMPLOYED"), F.col("DAYS_BIRTH")),
        "age_years": years(F.col("DAYS_BIRTH")),
        "employed_years": years(F.col("DAYS_EMPLOYED")),
        "income_per_person": ratio_or(income, F.coalesce(F.col("CNT_FAM_MEMBERS"), F.lit(1))),
        "bur_debt_income_ratio": ratio_or(column_or(df, "bur_total_debt", 0), income),
        "inst_late_per_credit": ratio_or(
            column_or(df, "inst_num_late", 0), column_or(df, "prev_num_applications", 1)
        ),
        "cc_util_income_ratio": ratio_or(column_or(df, "cc_utilisation", 0), income),
    })


def with_segments(df):
    return df.withColumns({
        "income_group": bands.income_group(F.col("AMT_INCOME_TOTAL")),
        "loan_size": bands.loan_size(F.col("AMT_CREDIT")),
        "age_group": bands.age_group(F.col("age_years")),
        "risk_level": bands.risk_level(F.col("income_credit_ratio")),
        "employment_group": bands.employment_group(F.col("employment_age_ratio")),
    })


def engineer(df, application_columns):
    """All engineered columns: a chain of projections that Spark collapses into one."""
    return with_segments(with_ratios(cleaned_days(df, application_columns)))
