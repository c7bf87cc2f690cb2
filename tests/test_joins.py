"""Joins keep every spine row once, also with heavy, missing and duplicated keys."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import joins


@pytest.fixture
def skewed(spark):
    spine = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).cast("long").alias("k"),
        F.col("id").alias("row"),
    )
    table = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return spine, table


def test_left_join_keeps_every_row_once(spark, skewed):
    spine, table = skewed
    second = table.select("k", (F.col("v") + 1).alias("w")).where("k % 2 = 1")
    found = joins.left_join_unique(spine, [table, second], "k")
    assert found.columns == ["k", "row", "v", "w"]
    expected = {}
    for i in range(3000):
        k = 7 if i % 3 == 0 else i if i % 3 == 1 else None
        v = k * 2 if k is not None and k < 2500 else None
        expected[i] = (k, v, v + 1 if v is not None and k % 2 == 1 else None)
    got = found.collect()
    assert len(got) == 3000
    assert {r.row: (r.k, r.v, r.w) for r in got} == expected


def test_union_sets(rows):
    train = rows("SK_ID_CURR long, TARGET int, A string", (1, 0, "x"))
    test = rows("SK_ID_CURR long, A string, B int", (2, "y", 5))
    found = {r.SK_ID_CURR: (r.TARGET, r.A, r.B, r.SET) for r in joins.union_sets(train, test).collect()}
    assert found == {1: (0.0, "x", None, "train"), 2: (None, "y", 5, "test")}


def test_guard_names_the_table_at_fault(rows):
    good = rows("SK_ID_CURR long", (1,), (2,), (None,), (None,))
    bad = rows("SK_ID_CURR long", (1,), (1,))
    joins.check_unique({"good": good})
    with pytest.raises(RuntimeError, match=r"bad \(1\)"):
        joins.check_unique({"good": good, "bad": bad})
    with pytest.raises(RuntimeError, match="expected 3, got 4"):
        joins.check_row_count(3, 4)
