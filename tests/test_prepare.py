"""Profiles, encoding, imputing and capping."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import prepare, profile


def test_missing_profile(rows):
    def found(*data):
        return [tuple(r) for r in profile.missing_profile(rows("a int, b double, c int", *data)).collect()]
    assert found((1, 4.0, 1), (2, 5.0, 2)) == []
    assert {r[0]: r[1] for r in found((1, None, 1), (2, None, 2), (None, 3.0, 3))} == {"a": 1, "b": 2}
    assert [r[0] for r in found((None, None, None), (2, None, None), (3, None, 3))] == ["b", "c", "a"]
    assert found((1, None, 1), (2, None, 2), (None, 3.0, 3))[0] == ("b", 2, 66.67)


def test_distinct_counts_leave_missing_out(rows):
    df = rows("a string, b string", ("x", None), ("y", None), ("x", None))
    assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df).collect()} == {"a": 2, "b": 0}


def test_encoding(rows):
    df = rows(
        "SK_ID_CURR long, SET string, TARGET double, two string, three string, empty string, `a.b` double",
        (1, "train", 0.0, "Yes", "red", None, 1.0), (2, "train", 1.0, "No", "blue", None, 2.0),
        (3, "test", None, None, None, None, 3.0), (4, "test", None, "Yes", "deep green", None, None),
    )
    fitted = prepare.fit_encoding(df)
    assert fitted.binary == {"two": ["No", "None", "Yes"], "empty": ["None"]}
    assert fitted.one_hot == {"three": ["blue", "deep green", "red"]}
    out = prepare.encode(df, fitted)
    assert out.columns == ["SK_ID_CURR", "SET", "TARGET", "a.b", "two", "empty", "three_deep green", "three_red"]
    assert [tuple(r)[4:] for r in out.orderBy("SK_ID_CURR").collect()] == [
        (2, 0, 0, 1), (0, 0, 0, 0), (1, 0, 0, 0), (2, 0, 1, 0)
    ]
    assert prepare.Preparation.from_json(fitted.to_json()) == fitted


def test_columns_of_many_values_are_wide(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("name"), (F.col("id") % 200).cast("string").alias("kind"),
        (F.col("id") % 201).cast("string").alias("more"))
    fitted = prepare.fit_encoding(df, dense=200)
    assert fitted.wide == ["name", "more"] and len(fitted.one_hot["kind"]) == 200
    assert prepare.encode(df, fitted).columns[-2:] == ["name", "more"] and "name" not in fitted.features()


def test_sparse_limit_is_strict_after_rounding(spark):
    # 80.00 %, 80.004 % and 80.01 % missing of 100,000 rows
    df = spark.range(100_000).select(
        *[F.when(F.col("id") >= n, 1.0).alias(c) for c, n in (("at", 80_000), ("near", 80_004), ("over", 80_010))]
    )
    assert prepare.fit(df).sparse == ["over"]


def test_impute_cap_and_guards(spark):
    df = spark.range(101).select(
        F.col("id").alias("SK_ID_CURR"), F.lit("train").alias("SET"), (F.col("id") % 2).cast("double").alias("TARGET"),
        F.col("id").cast("double").alias("AMT_CREDIT"),
        F.when(F.col("id") < 51, F.col("id").cast("double")).alias("AMT_ANNUITY"),
        F.when(F.col("id") > 90, 1.0).alias("mostly_missing"),
        F.col("id").cast("int").alias("n"),
    )
    fitted = prepare.fit(df)
    assert fitted.sparse == ["mostly_missing"] and fitted.filled == ["AMT_ANNUITY"]
    assert fitted.medians == {"AMT_CREDIT": 50.0, "AMT_ANNUITY": 25.0, "n": 50.0}
    assert fitted.caps == {"AMT_CREDIT": [1.0, 99.0], "AMT_ANNUITY": [1.0, 49.0]}
    out = prepare.apply(df, fitted)
    assert fitted.features() == ["AMT_CREDIT", "AMT_ANNUITY", "n"]
    rows = {r.SK_ID_CURR: r for r in out.collect()}
    assert (rows[0].AMT_CREDIT, rows[100].AMT_CREDIT, rows[100].AMT_ANNUITY, rows[50].AMT_ANNUITY) == (1, 99, 25, 49)
    prepare.check_no_nulls(out, fitted.features())
    with pytest.raises(ValueError, match="AMT_ANNUITY"):
        prepare.check_no_nulls(df, ["AMT_ANNUITY"])
    with pytest.raises(ValueError, match="no value"):
        prepare.fit(df.withColumn("void", F.lit(None).cast("double")), limit_pct=100)


def test_fit_on_training_rows_only(rows):
    df = rows("SK_ID_CURR long, SET string, x double", (1, "train", 1.0), (2, "train", None), (3, "test", 9.0))
    assert prepare.fit(df).medians == {"x": 5.0}
    assert prepare.fit(df.where("SET = 'train'")).medians == {"x": 1.0}


def test_compact_types(rows):
    df = rows(
        "a long, b long, c double, d double, s string, e int, f long, g double",
        (1, 40_000, 1.5, 123456.789, "x", -129, 2**40, None), (2, -5, 2.5, 0.1, "y", 5, 0, None),
        (3, None, 3.5, 16777217.0, None, None, None, None),
    )
    out = prepare.compact(df)
    assert dict(out.dtypes) == {
        "a": "tinyint", "b": "int", "c": "float", "d": "double", "s": "string", "e": "smallint", "f": "bigint", "g": "float"
    }
    assert [r.c for r in out.collect()] == [1.5, 2.5, 3.5] and [r.s for r in out.collect()] == ["x", "y", None]


def test_histogram_density_sums_to_one(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3 == 0).cast("int").alias("TARGET"),
        F.when(F.col("id") % 10 > 0, F.pow(F.col("id"), 2).cast("double")).alias("inst_late_rate"),
        F.lit(5.0).alias("cc_utilisation"), F.lit(None).cast("double").alias("bur_max_overdue"),
    )
    found = profile.class_histogram(df).collect()
    assert {r.feature for r in found} == {"inst_late_rate", "cc_utilisation"} and len(found) == 2 * 2 * 40
    for name in ("inst_late_rate", "cc_utilisation"):
        for label in (0, 1):
            mine = [r for r in found if r.label == label and r.feature == name]
            assert sorted(r.bin for r in mine) == list(range(40))
            size, largest = sum(r.n for r in mine), max(mine, key=lambda r: r.n)
            width = largest.n / (largest.density * size)
            assert sum(r.density * width for r in mine) == pytest.approx(1.0)
    # without spread: a range of one around the value
    assert {r.bin for r in found if r.feature == "cc_utilisation" and r.n} == {20}


def test_class_weights(rows):
    df = rows("TARGET int", *[(0,)] * 6, *[(1,)] * 2)
    found = {r.label: (r.n, r.balanced_weight, r.positive_weight) for r in profile.class_weights(df).collect()}
    assert found == {0: (6, 8 / 12, 1.0), 1: (2, 2.0, 3.0)}


def test_rows_unlike_those_fitted_on(rows):
    """Unseen and first missing categories, numbers missing for the first time, booleans and dates."""
    schema = "SK_ID_CURR long, n int, x double, two string, many string, yes boolean, day date"
    day = __import__("datetime").date(2020, 1, 2)
    seen = rows(schema, *[(i, i, float(i), "ab"[i % 2], "pqr"[i % 3], i % 2 == 0, day) for i in range(9)])
    fitted = prepare.fit(seen)
    assert prepare.Preparation.from_json(fitted.to_json()) == fitted
    new = rows(schema, (1, None, None, "c", "z", None, None), (2, 3, 1.0, None, None, True, day))
    out = {r.SK_ID_CURR: r for r in prepare.apply(new, fitted).collect()}
    assert (out[1].n, out[1].x, out[1].two, out[1].many_q, out[1].many_r) == (4, 4.0, 2, 0, 0)
    assert out[2].two == 2 and out[2].yes == 1 and out[2].day == 0
    prepare.check_no_nulls(prepare.apply(new, fitted), fitted.features())
    with pytest.raises(TypeError, match="odd"):
        prepare.fit(seen.withColumn("odd", F.array("n")))
