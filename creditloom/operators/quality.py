"""Data-quality checks: each is a query of offending rows, empty when the check passes."""

from collections import namedtuple

from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.operators.marts import rate_pct
from creditloom.session import small_table

Check = namedtuple("Check", "name severity offending")


def accepted_values(df, column="target", values=(0, 1)):
    """Values outside the accepted ones with their counts; a missing value passes."""
    return df.where(~F.col(column).isin(list(values))).groupBy(column).agg(F.count("*").alias("n"))


def not_null(df, columns=("amt_income_total", "amt_credit", "days_birth")):
    """Number of missing values per column that must have none, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls").where(F.col("nulls") > 0)


def age_range(df, low=18, high=100):
    age = F.col("days_birth").cast("double") / F.lit(365.0)
    return df.where((age < low) | (age > high)).select("days_birth")


def row_count(df, expected=S.EXPECTED_ROWS["application_train"]):
    counted = df.agg(F.count("*").alias("total_rows"))
    return counted.where(F.col("total_rows") != expected)


def rate_band(df, low=7.0, high=9.0):
    rate = df.where(F.col("target").isNotNull()).agg(rate_pct("target").alias("default_rate"))
    return rate.where((F.col("default_rate") < low) | (F.col("default_rate") > high))


def quirk_counts(df):
    return df.agg(
        F.count_if(F.col("bur_total_debt") < 0).alias("neg_debt"),
        F.count_if(F.col("cc_utilisation") > 1.0).alias("over_limit"),
    )


def quirks(df, limit=S.QUIRK_LIMIT):
    return quirk_counts(df).where((F.col("neg_debt") > limit) | (F.col("over_limit") > limit))


def slim_checks(slim):
    """The checks on the published table."""
    return [
        Check("accepted_values_target", "error", accepted_values(slim)),
        Check("not_null", "error", not_null(slim)),
        Check("age_range", "error", age_range(slim)),
        Check("row_count", "error", row_count(slim)),
        Check("rate_band", "error", rate_band(slim)),
        Check("quirks", "warn", quirks(slim)),
    ]


def slim_report(df, rows=S.EXPECTED_ROWS["application_train"], limit=S.QUIRK_LIMIT):
    """What ``run_checks`` says of the published table's checks, from one aggregate over it."""
    age = F.col("days_birth").cast("double") / F.lit(365.0)
    needed = ("amt_income_total", "amt_credit", "days_birth")
    found = df.agg(
        F.count_distinct(F.when(~F.col("target").isin(0, 1), F.col("target"))).alias("other_targets"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in needed],
        F.count_if((age < 18) | (age > 100)).alias("odd_ages"),
        F.count("*").alias("total"),
        rate_pct("target").alias("rate"),
        F.count_if(F.col("bur_total_debt") < 0).alias("neg_debt"),
        F.count_if(F.col("cc_utilisation") > 1.0).alias("over_limit"),
    )

    def whether(condition):
        return F.when(condition, 1).otherwise(0)

    checks = [
        ("accepted_values_target", "error", F.col("other_targets")),
        ("not_null", "error", sum((whether(F.col(f"null_{c}") > 0) for c in needed), F.lit(0))),
        ("age_range", "error", F.col("odd_ages")),
        ("row_count", "error", whether(F.col("total") != rows)),
        ("rate_band", "error", whether((F.col("rate") < 7.0) | (F.col("rate") > 9.0))),
        ("quirks", "warn", whether((F.col("neg_debt") > limit) | (F.col("over_limit") > limit))),
    ]
    return found.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), n.cast("bigint").alias("failures"),
            F.when(n == 0, "pass").otherwise(severity).alias("status"),
        ) for name, severity, n in checks
    ])))


def run_checks(checks):
    """One row per check: offending rows and status pass, warn or error."""
    results = None
    for check in checks:
        failures = check.offending.agg(F.count("*").alias("failures")).select(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            "failures",
            F.when(F.col("failures") == 0, "pass").otherwise(check.severity).alias("status"),
        )
        results = failures if results is None else results.unionByName(failures)
    return results


def completeness(tables, expected=None):
    """Row counts of the inputs against expectation: absent or below half is an error, below 90 % a warning.

    ``tables`` maps names to DataFrames; an input that is not there is left out.
    """
    expected = expected or S.EXPECTED_ROWS
    spark = next(iter(tables.values())).sparkSession
    counts = None
    for name in expected:
        if name in tables:
            one = tables[name].agg(F.count("*").alias("actual_rows")).select(
                F.lit(name).alias("table_name"), "actual_rows"
            )
            counts = one if counts is None else counts.unionByName(one)
    wanted = small_table(spark, list(expected.items()), "table_name string, expected_rows long")
    share = F.col("actual_rows") / F.col("expected_rows")
    return wanted.join(F.broadcast(counts), "table_name", "left").select(
        "table_name", "expected_rows", "actual_rows",
        F.when(F.col("actual_rows").isNull(), "absent").when(share < 0.5, "error").when(share < 0.9, "warn")
        .otherwise("ok").alias("status"),
    )


def check_completeness(tables, expected=None):
    """Fail if an input is absent or truncated; return the report otherwise."""
    report = completeness(tables, expected).collect()
    bad = [f"{r.table_name}: {r.actual_rows} of {r.expected_rows} rows" for r in report
           if r.status in ("absent", "error")]
    if bad:
        raise ValueError("incomplete inputs: " + "; ".join(bad))
    return report
