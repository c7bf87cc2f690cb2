"""Cohort mart over the published slim table."""

from pyspark.sql import functions as F

from creditloom.functions.bands import mart_age_band, mart_employment_band


def banded(slim):
    return slim.where(F.col("target").isNotNull()).select(
        F.col("target"),
        mart_age_band(F.col("days_birth")).alias("age_band"),
        mart_employment_band(F.col("employment_age_ratio")).alias("employment_band"),
    )


def rate_pct(label):
    """Share of positives in percent, half-up at two digits, from exact counts."""
    return F.round(F.try_divide(F.sum(label) * 100.0, F.count(label)), 2)


def cohort_default_rates(slim):
    """Customers and default rate per age and employment band."""
    return banded(slim).groupBy("age_band", "employment_band").agg(
        F.count("*").alias("customers"), rate_pct("target").alias("default_rate_pct")
    )
