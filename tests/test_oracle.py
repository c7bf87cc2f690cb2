"""Every registered query with a SQL form gives exactly the SQL's result."""

import re

import pytest

import __spark_entry__ as contract
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"

def own(names):
    """Without the training-data queries, which have tests of their own and may be absent."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


SQL = {n: text for n, text in contract.oracle_sql().items() if n in own(contract.oracle_sql())}
# Trainings and stored models have no SQL form.
ROWS_ONLY = {"train_logistic", "train_forest", "train_boosted_a", "train_boosted_b", "cross_validate",
             "feature_importance"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_only_the_known_ones_lack_sql():
    assert own(contract.queries()) - set(SQL) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    assert differences(contract.queries()[name](spark, FOLDER), db, SQL[name]) == ""


@pytest.mark.parametrize("name", ["agg_bureau", "features_full", "cumulative_gain", "medians"])
def test_results_do_not_depend_on_partitioning(spark, db, name):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert differences(contract.queries()[name](spark, FOLDER), db, SQL[name]) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
