"""The physical plans are the intended ones: few shuffles, no Python, pruned scans."""

import re

import pytest

from creditloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(spark, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_view_shuffles_each_input_once(spark):
    text = plan(spark, "customer_360")
    # the joins on the customer key add no shuffle: one for the spine and one per summary
    assert text.count("Exchange hashpartitioning(SK_ID_CURR") == 6
    # credits and their months meet on the credit key; the last two belong to the role view of instalments
    assert text.count("Exchange hashpartitioning") == 10


def test_unused_summaries_are_not_computed(spark):
    text = plan(spark, "cohort_default_rates")
    # applications with a key and those without are read apart
    assert text.count("Exchange") == 1 and text.count("FileScan") == 2
    assert re.search(r"FileScan parquet \[c_custkey#\d+L,c_nationkey#\d+,c_acctbal#\d+\]", text)
    assert "LessThan(c_nationkey,21)" in text


def test_slim_columns_carry_no_other_statistics(spark):
    """The published columns come straight from the features, not from a stage of all of them."""
    text = plan(spark, "project_slim")
    assert text.count("Exchange hashpartitioning(SK_ID_CURR") == 6
    assert "prev_approval_rate" in text and "prev_days_decision_mean" not in text
    assert "LessThan(c_nationkey,21)" in text


@pytest.mark.parametrize("name", ["agg_previous", "agg_pos", "agg_card"])
def test_summaries_combine_before_their_one_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange") == 1 and "partial_" in text


def test_scans_are_pruned(spark):
    text = plan(spark, "agg_bureau_balance")
    assert re.search(r"FileScan parquet \[l_orderkey#\d+L,l_linenumber#\d+,l_returnflag#\d+\]", text)


@pytest.mark.parametrize("name", ["features_full", "cumulative_gain", "fbeta_sweep", "class_histogram", "roc_auc"])
def test_no_python_in_plans(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


@pytest.mark.parametrize("name", ["cumulative_gain", "top20_capture", "roc_curve", "avg_precision"])
def test_rows_never_meet_in_one_partition(spark, name):
    """What is sent to a single partition has been aggregated before."""
    lines = plan(spark, name).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], lines[i + 1]


@pytest.mark.parametrize("name", ["customer_360", "features_full", "dq_report", "cohort_default_rates", "missing_profile",
                                  "nunique", "minmax", "class_weights"])
def test_building_a_query_starts_no_job(spark, name):
    catalog.data(spark, FOLDER).engineered()
    catalog.data(spark, FOLDER).prepared()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", name)
    try:
        catalog.QUERIES[name](spark, FOLDER)
        assert tracker.getJobIdsForGroup("building") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_correlations_unfold_no_rows(spark):
    """Tasks add up whole columns; no row becomes one row per column."""
    assert "Generate" not in plan(spark, "top_correlations")


def test_the_split_is_looked_for_once(spark, rows):
    """Training, scoring and evaluation of one folder share its cuts."""
    d = catalog.Data(spark, "/nowhere")
    d._memo["prepared"] = rows("SK_ID_CURR int, SET string, TARGET double", *[(i, "train", float(i % 2)) for i in range(20)])
    train, held_out = d.split()
    assert d.split() == (train, held_out) and (train.count(), held_out.count()) == (16, 4)
