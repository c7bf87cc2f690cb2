"""One test or more per rule on missing values, ratios, bins and rounding."""

import math

import pytest
from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.functions import bands
from creditloom.functions.scalar import clip, flag, nan_to_null, ratio, ratio_or, sentinel_to_null, years
from creditloom.functions.totals import correlation, total
from creditloom.operators import profile, summaries
from creditloom.sources import files
from pyspark.sql import types as T


def one(df):
    return [r[0] for r in df.collect()]


def test_nan_becomes_null(rows):
    df = rows("x double", (1.0,), (math.nan,), (None,))
    assert one(df.select(nan_to_null(F.col("x")))) == [1.0, None, None]


def test_csv_null_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,x,s\n1,2.5,a\n2,,\n3,NA,NA\n4,NaN,None\n5.0,3,b\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()),
                           T.StructField("s", T.StringType())])
    df = files.read_csv(spark, str(tmp_path / "t.csv"), schema)
    assert [tuple(r) for r in df.orderBy("k").collect()] == [
        (1, 2.5, "a"), (2, None, None), (3, None, None), (4, None, None), (5, 3.0, "b")
    ]
    assert files.read_csv(spark, str(tmp_path / "t.csv"), schema, ["x"]).columns == ["x"]


def test_csv_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,x,s\n1,2.5,a\n2,NA,\n3,NaN,b\n")
    df = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(1, 2.5, "a"), (2, None, None), (3, None, "b")]


def test_csv_keeps_large_keys(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k\n9007199254740993\n")
    schema = T.StructType([T.StructField("k", T.LongType())])
    assert one(files.read_csv(spark, str(tmp_path / "t.csv"), schema)) == [9007199254740993]


def test_sum_of_nothing_is_zero_and_null_keys_are_left_out(rows):
    df = rows("k long, x double", (1, None), (1, None), (2, 3.0), (None, 9.0))
    measures = {"x": {"sum": "s", "mean": "m", "count": "n", "min": "lo"}}
    found = {r.k: (r.s, r.m, r.n, r.lo) for r in summaries.summarise(df, "k", measures).collect()}
    assert found == {1: (0.0, None, 0, None), 2: (3.0, 3.0, 1, 3.0)}


def test_total_of_empty_table(rows):
    assert one(rows("x int").agg(total(F.col("x")))) == [0]


def test_flag_of_unknown_is_zero(rows):
    df = rows("s string", ("Active",), ("Closed",), (None,))
    assert one(df.select(flag(F.col("s") == "Active"))) == [1, 0, 0]


@pytest.mark.parametrize("fill,expected", [(0, [5.0, 0.0, None, None, 0.0]), (-1, [5.0, -1.0, None, None, -1.0])])
def test_ratio_with_fill(rows, fill, expected):
    df = rows("a double, b double", (10.0, 2.0), (10.0, 0.0), (None, 2.0), (10.0, None), (None, 0.0))
    assert one(df.select(ratio_or(F.col("a"), F.col("b"), fill))) == expected


def test_ratio_with_fill_over_columns(rows):
    def divided(a, b, fill=0):
        return one(rows("a long, b long", *zip(a, b)).select(ratio_or(F.col("a"), F.col("b"), fill)))
    assert divided([10, 20, 30], [2, 4, 5]) == [5.0, 5.0, 6.0]
    assert divided([10, 20, 30], [2, 0, 5], 999) == [5.0, 999.0, 6.0]
    assert divided([10, 20, 0], [2, 0, 5]) == [5.0, 0.0, 0.0]


def test_ratio_null_on_zero(rows):
    df = rows("a long, b long", (3, 2), (3, 0), (None, 2), (3, None))
    assert one(df.select(ratio(F.col("a"), F.col("b")))) == [1.5, None, None, None]


def test_clip_keeps_missing(rows):
    df = rows("x double", (-5.0,), (5.0,), (50.0,), (None,))
    assert one(df.select(clip(F.col("x"), 0.0, 10.0))) == [0.0, 5.0, 10.0, None]


def test_sentinel_only_where_asked(rows):
    df = rows("DAYS_FIRST_DUE double, AMT double", (365243.0, 365243.0), (-3.0, 1.0))
    assert [tuple(r) for r in summaries.without_sentinels(df).collect()] == [(None, 365243.0), (-3.0, 1.0)]
    assert one(df.select(sentinel_to_null(F.col("AMT")))) == [None, 1.0]


def test_years(rows):
    assert one(rows("d int", (-730,), (365,), (None,)).select(years(F.col("d")))) == [2.0, 1.0, None]


def test_rounding_modes(rows):
    df = rows("x double", (0.125,), (0.375,), (2.675,))
    assert one(df.select(F.bround("x", 2))) == [0.12, 0.38, 2.68]
    assert one(df.select(F.round("x", 2))) == [0.13, 0.38, 2.68]


def test_right_closed_bins(rows):
    df = rows("x double", (0.0,), (30.0,), (30.1,), (40.0,), (60.0,), (math.inf,), (None,), (-1.0,))
    assert one(df.select(bands.age_group(F.col("x")))) == [
        None, "18-29", "30-39", "30-39", "50-59", "60+", None, None
    ]


def test_employment_and_risk_edges(rows):
    df = rows("x double", (-0.001,), (0.0,), (0.1,), (0.3,), (0.6,), (0.61,))
    assert one(df.select(bands.employment_group(F.col("x")))) == [
        None, "Unstable", "Unstable", "Short-term", "Moderate", "Stable"
    ]
    assert one(df.select(bands.risk_level(F.col("x")))) == [
        None, "High Risk", "High Risk", "High Risk", "Medium Risk", "Low Risk"
    ]


def test_left_closed_bins(rows):
    df = rows("x double", (0.0,), (99_999.9,), (100_000.0,), (200_000.0,), (math.inf,), (-1.0,), (None,))
    assert one(df.select(bands.income_group(F.col("x")))) == ["Low", "Low", "Medium", "High", None, None, None]
    assert one(rows("x double", (100_000.0,), (500_000.0,)).select(bands.loan_size(F.col("x")))) == ["Medium", "Large"]


def test_mart_bands_differ_from_bins(rows):
    days = rows("d int", (30 * 365,), (30 * 365 - 1,), (60 * 365,), (None,))
    assert one(days.select(bands.mart_age_band(F.col("d")))) == ["30-39", "18-29", "60+", "60+"]
    ratios = rows("r double", (None,), (0.1,), (0.6,), (-5.0,))
    assert one(ratios.select(bands.mart_employment_band(F.col("r")))) == [
        "Unstable", "Short-term", "Stable", "Unstable"
    ]


def test_correlation_of_constant_is_null(rows):
    df = rows("x double, c double, y double", (1.0, 5.0, 1.0), (2.0, 5.0, 0.0), (4.0, 5.0, 1.0), (None, 5.0, 0.0))
    x, c, y = df.agg(correlation(F.col("x"), F.col("y")), correlation(F.col("c"), F.col("y")),
                     correlation(F.col("y"), F.col("y"))).first()
    assert c is None and y == pytest.approx(1.0) and x == pytest.approx(0.18898, abs=1e-4)


def test_correlation_needs_two_pairs(rows):
    df = rows("x double, y double", (1.0, 1.0), (None, 0.0))
    assert one(df.agg(correlation(F.col("x"), F.col("y")))) == [None]


def test_ties_in_top_correlations_go_by_name(rows):
    df = rows("b double, a double, TARGET int", (1.0, 1.0, 1), (2.0, 2.0, 0), (3.0, 3.0, 1))
    assert one(profile.top_correlations(df, k=1)) == ["a"]


def test_fixed_values():
    assert S.BETA == 2.5 and 0 < S.MISSING_LIMIT_PCT < 100 and isinstance(S.SEED, int)
    assert len(S.SWEEP) == 18 and len(S.SLIM_COLUMNS) == 20
