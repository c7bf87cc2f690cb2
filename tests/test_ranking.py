"""Metrics, curves and thresholds on small scored frames and against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from creditloom.operators import decision, ranking

SCORED = "SK_ID_CURR long, label int, score double"


def frame(spark, n=400, seed=1):
    rnd = random.Random(seed)
    data = [(i, int(rnd.random() < 0.3), round(rnd.random(), 2)) for i in range(n)]
    return spark.createDataFrame(data, SCORED).repartition(5), data


def test_auc_counts_ties_half(spark, rows):
    df, data = frame(spark)
    pos = [s for _, y, s in data if y]
    neg = [s for _, y, s in data if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    auc = ranking.roc_auc(df).first()[0]
    assert auc == pytest.approx(wins / len(pos) / len(neg), abs=5e-5) and 0 <= auc <= 1
    flipped = ranking.roc_auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert auc + flipped == pytest.approx(1.0, abs=1.1e-4)
    assert ranking.roc_auc(rows(SCORED, (1, 1, 0.5), (2, 1, 0.7))).first()[0] is None


def test_average_precision_is_a_step_sum(rows):
    df = rows(SCORED, (1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7), (4, 1, 0.6), (5, 0, 0.1))
    assert ranking.avg_precision(df).first()[0] == round((1 + 2 / 3 + 3 / 4) / 3, 4)
    both = ranking.ranking_summary(df).first()
    assert (both.auc_roc, both.avg_precision) == (ranking.roc_auc(df).first()[0], ranking.avg_precision(df).first()[0])


def test_curves(rows):
    df = rows(SCORED, (1, 1, 0.9), (2, 0, 0.5), (3, 1, 0.5), (4, 0, 0.1))
    roc = {r.score: (r.fpr, r.tpr) for r in ranking.roc_curve(df).collect()}
    assert roc == {None: (0.0, 0.0), 0.9: (0.0, 0.5), 0.5: (0.5, 1.0), 0.1: (1.0, 1.0)}
    pr = {r.score: (r.precision, r.recall, r.base_rate) for r in ranking.pr_curve(df).collect()}
    assert pr == {None: (1.0, 0.0, 0.5), 0.9: (1.0, 0.5, 0.5), 0.5: (2 / 3, 1.0, 0.5), 0.1: (0.5, 1.0, 0.5)}


def test_class_report_and_confusion(rows):
    df = rows("label int, predicted int", (1, 1), (1, 0), (0, 1), (0, 0), (0, 0), (1, 1))
    assert tuple(ranking.class_report(df).first()) == (0.6667, 0.6667, 0.6667)
    assert {r.label: (r.predicted_0, r.predicted_1) for r in ranking.confusion(df).collect()} == {0: (2, 1), 1: (1, 2)}
    nothing = rows("label int, predicted int", (0, 0))
    assert tuple(ranking.class_report(nothing).first()) == (0.0, 0.0, 0.0)


def test_gain_and_capture(spark):
    df, data = frame(spark)
    ordered = sorted(data, key=lambda r: (-r[2], r[0]))
    total, caught, want = sum(y for _, y, _ in data), 0, {}
    for i, (k, y, _) in enumerate(ordered, 1):
        caught += y
        want[k] = (i, caught / total * 100)
    found = {r.SK_ID_CURR: (r.position, r.gain_pct) for r in ranking.cumulative_gain(df).collect()}
    assert found == want
    capture = ranking.top_share_capture(df).first()
    assert capture.capture_pct == pytest.approx(sum(y for _, y, _ in ordered[:80]) / total * 100)
    assert capture.lift == pytest.approx(capture.capture_pct / 20)


def test_sweep_counts_scores_on_the_threshold(spark):
    df, data = frame(spark)
    found = decision.threshold_counts(df).collect()
    assert len(found) == 18
    for r in found:
        assert r.tp == sum(1 for _, y, s in data if y and s >= r.threshold)
        assert r.fp == sum(1 for _, y, s in data if not y and s >= r.threshold)
        assert r.tp + r.fn == sum(y for _, y, _ in data)
    recalls = [r.recall for r in decision.fbeta_sweep(df).orderBy("threshold").collect()]
    assert recalls == sorted(recalls, reverse=True)


def test_best_threshold_takes_the_lowest_of_equals(rows):
    sweep = rows("threshold double, fbeta double", (0.3, 0.5), (0.1, 0.7), (0.2, 0.7))
    assert decision.best_threshold(sweep).first().threshold == 0.1


def test_fbeta(rows):
    df = rows(SCORED, (1, 1, 0.9), (2, 0, 0.9), (3, 1, 0.01), (4, 0, 0.01))
    row = decision.fbeta_sweep(df, beta=2.5).where("threshold = 0.5").first()
    assert row.fbeta == round(7.25 / (7.25 + 6.25 + 1), 4) and (row.precision, row.recall, row.f1) == (0.5, 0.5, 0.5)
