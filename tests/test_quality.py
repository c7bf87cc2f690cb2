"""Checks return the offending rows, marts the cohort table."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import marts, quality
from creditloom.sources import files


def test_checks_find_offenders(rows):
    slim = rows(
        "target double, days_birth int, amt_income_total double, amt_credit double, bur_total_debt double, cc_utilisation double",
        (0.0, 365 * 30, 1.0, 1.0, -1.0, 1.5), (1.0, 365 * 17, None, 1.0, 0.0, 1.0), (2.0, 365 * 101, 1.0, 1.0, None, None),
        (None, None, 1.0, 1.0, 1.0, 2.0),
    )
    assert [tuple(r) for r in quality.accepted_values(slim).collect()] == [(2.0, 1)]
    assert {tuple(r) for r in quality.not_null(slim).collect()} == {("amt_income_total", 1), ("days_birth", 1)}
    assert sorted(r[0] for r in quality.age_range(slim).collect()) == [365 * 17, 365 * 101]
    assert [r[0] for r in quality.row_count(slim, 5).collect()] == [4] and not quality.row_count(slim, 4).collect()
    assert [r[0] for r in quality.rate_band(slim).collect()] == [100.0]
    assert not quality.rate_band(slim, 90, 110).collect()
    assert tuple(quality.quirk_counts(slim).first()) == (1, 2)
    assert quality.quirks(slim, 1).collect() and not quality.quirks(slim, 2).collect()
    status = {r.check_name: r.status for r in quality.run_checks(quality.slim_checks(slim)).collect()}
    assert status == {
        "accepted_values_target": "error", "not_null": "error", "age_range": "error", "row_count": "error",
        "rate_band": "error", "quirks": "pass",
    }


def test_rate_band_of_nothing(rows):
    assert not quality.rate_band(rows("target double", (None,))).collect()


def test_completeness(spark, rows):
    tables = {name: spark.range(n) for name, n in (("a", 100), ("b", 89), ("c", 49), ("d", 90), ("e", 50))}
    expected = dict.fromkeys("abcdef", 100)
    report = {r.table_name: (r.actual_rows, r.status) for r in quality.completeness(tables, expected).collect()}
    assert report == {"a": (100, "ok"), "b": (89, "warn"), "c": (49, "error"), "d": (90, "ok"), "e": (50, "warn"),
                      "f": (None, "absent")}
    with pytest.raises(ValueError, match="c: 49 of 100 rows; f"):
        quality.check_completeness(tables, expected)


def test_mart(rows):
    slim = rows("target double, days_birth int, employment_age_ratio double",
                (1.0, 365 * 30, None), (0.0, 365 * 35, 0.05), (0.0, 365 * 39, 0.0), (1.0, 365 * 65, 0.7), (None, 365 * 65, 0.7))
    found = {(r.age_band, r.employment_band): (r.customers, r.default_rate_pct)
             for r in marts.cohort_default_rates(slim).collect()}
    assert found == {("30-39", "Unstable"): (3, 33.33), ("60+", "Stable"): (1, 100.0)}


def test_slim_contract(rows):
    with pytest.raises(KeyError, match="cc_utilisation"):
        files.slim(rows("AMT_CREDIT double", (1.0,)))


def test_report_in_one_pass_equals_the_checks_one_by_one(spark):
    from creditloom.plans import catalog
    slim = catalog.data(spark, "/root/testdata/sf0.001").slim()
    odd = slim.limit(3).withColumns({
        "target": F.lit(2.0), "days_birth": F.lit(1).cast("int"), "amt_credit": F.lit(None).cast("double")})
    for table in (slim, slim.unionByName(odd), slim.limit(0)):
        report = quality.slim_report(table)
        assert report.collect() == quality.run_checks(quality.slim_checks(table)).collect()
    assert slim.unionByName(odd).count() == slim.count() + 3
